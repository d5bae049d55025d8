"""The entry works without the training-data subpackage, whatever is left of its folder."""

import json
import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
ASK = "import json, __spark_entry__ as E; print(json.dumps([sorted(E.queries()), sorted(E.oracle_sql())]))"


def ask(folder):
    done = subprocess.run([sys.executable, "-c", ASK], cwd=folder, capture_output=True, text=True, env=os.environ | {"PYTHONPATH": "", "PYTHONDONTWRITEBYTECODE": "1"})
    return json.loads(done.stdout) if done.returncode == 0 else done.stderr


@pytest.mark.parametrize("left", [(), ("visitlens/llm",), ("visitlens/llm/__pycache__",)], ids=["nothing", "empty folder", "cache"])
def test_without_the_subpackage(tmp_path, left):
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    shutil.copytree(f"{ROOT}/visitlens", tmp_path / "visitlens", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for folder in left:
        (tmp_path / folder).mkdir(parents=True)
    queries, oracle = ask(tmp_path)
    assert queries == oracle and "session_aggr_stat" in queries and not any(q.startswith("op") or q == "pipeline" for q in queries)


def test_a_broken_operator_is_not_hidden(tmp_path):
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    shutil.copytree(f"{ROOT}/visitlens", tmp_path / "visitlens", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    (tmp_path / "visitlens/llm").mkdir()
    (tmp_path / "visitlens/llm/queries.py").write_text("import no_such_module\n")
    assert "no_such_module" in ask(tmp_path)
