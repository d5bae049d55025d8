"""All five results of a task or none: a run's tables become visible together, by one renamed file.

Layout below ``base``: ``runs/<run>/<table>/`` holds a run's tables, ``commits/task-<id>.json`` names the run that
counts for a task. Readers go through the commit files, so tables of a run that failed, or has not ended, are in no
result. A re-run of a task puts its commit file in the place of the older one, by a rename that the file system does
at once; both runs' folders stay until ``remove_unreferenced``.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitlens.plans.physical import drop_folder
from visitlens.sinks import ResultSink

COMMIT = "task_id bigint, run string, tables map<string, string>"


def _replace_file(spark: SparkSession, folder: str, name: str, text: str) -> None:
    """Write ``text`` under a hidden name and rename it over ``name``, through Spark's file system access."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    hidden = path(f"{folder}/.{name}.{uuid.uuid4().hex}")
    files = hidden.getFileSystem(conf)
    files.mkdirs(path(folder))
    out = files.create(hidden, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), conf)
    context.rename(files.makeQualified(hidden), files.makeQualified(path(f"{folder}/{name}")), how)


@dataclass
class CommittedSink(ResultSink):
    """A file sink whose tables are visible only after ``commit``. One sink serves one run at a time."""

    _spark: SparkSession | None = field(default=None, repr=False)
    _task_id: int | None = None
    _run: str | None = None
    _tables: dict[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.base is None or self.fmt == "jdbc":
            raise ValueError("a committed sink needs a file format and a base path")
        self.base = self.base.rstrip("/")

    def begin(self, spark: SparkSession, task_id: int) -> None:
        self._spark, self._task_id, self._tables = spark, task_id, {}
        self._run = f"task-{task_id}-{uuid.uuid4().hex}"

    def write(self, df: DataFrame, name: str) -> None:
        if self._run is None:
            raise RuntimeError("begin() comes first")
        df.write.format(self.fmt).options(**self.options).save(f"{self.base}/runs/{self._run}/{name}")
        self._tables[name] = df.schema.json()

    def commit(self) -> None:
        text = json.dumps({"task_id": self._task_id, "run": self._run, "tables": self._tables})
        _replace_file(self._spark, f"{self.base}/commits", f"task-{self._task_id}.json", text)
        self._run = None

    def abort(self) -> None:
        if self._run is not None:
            drop_folder(self._spark, f"{self.base}/runs/{self._run}")
            self._run = None


def commits(spark: SparkSession, base: str) -> DataFrame:
    """(task_id, run, tables): the run that counts for each task; ``tables`` holds each table's schema."""
    folder = f"{base.rstrip('/')}/commits"
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], COMMIT)
    return spark.read.schema(COMMIT).json(folder)


def read_committed(spark: SparkSession, base: str, name: str, task_id: int | None = None, fmt: str = "parquet") -> DataFrame:
    """The rows of table ``name`` of all committed tasks, or of one. Without any, LookupError."""
    found = commits(spark, base).where(F.col("tables").getItem(name).isNotNull())
    if task_id is not None:
        found = found.where(F.col("task_id") == task_id)
    rows = found.select("run", F.col("tables").getItem(name).alias("schema")).orderBy("run").collect()
    if not rows:
        raise LookupError(f"no committed run has {name}" + ("" if task_id is None else f" of task {task_id}"))
    paths = {}
    for r in rows:  # usually one schema: one read
        paths.setdefault(r["schema"], []).append(f"{base.rstrip('/')}/runs/{r['run']}/{name}")
    parts = [spark.read.format(fmt).schema(T.StructType.fromJson(json.loads(s))).load(p) for s, p in paths.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def remove_unreferenced(spark: SparkSession, base: str, older_than_hours: float = 24.0) -> list[str]:
    """Delete run folders that no commit names and whose last change is ``older_than_hours`` ago or longer (a younger
    one may be of a run under way, or still be read). Returns their names."""
    base = base.rstrip("/")
    kept = {r["run"] for r in commits(spark, base).select("run").collect()}
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/runs")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    last = spark._jvm.System.currentTimeMillis() - older_than_hours * 3_600_000
    gone = [s.getPath().getName() for s in files.listStatus(folder) if s.getModificationTime() <= last]
    gone = sorted(set(gone) - kept)
    for run in gone:
        drop_folder(spark, f"{base}/runs/{run}")
    return gone
