"""Word count (A10) against a brute-force model of line reading and single-space splitting."""

import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from visitlens.operators.wordcount import text_lines, word_count


def model_lines(text):
    """Lines of a text file: CR LF, LF or CR end a line; no empty line after a final terminator."""
    if text == "":
        return []
    lines = re.split(r"\r\n|\n|\r", text)
    if re.search(r"(\r\n|\n|\r)\Z", text):
        lines.pop()
    return lines


def model_tokens(line):
    """Split on one space; trailing empty tokens dropped; an empty line is one empty token."""
    if line == "":
        return [""]
    parts = line.split(" ")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def model_count(texts):
    return Counter(t for text in texts if text is not None for line in model_lines(text) for t in model_tokens(line))


def spark_count(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    return {r["word"]: r["count"] for r in word_count(text_lines(df)).collect()}


EDGE_TEXTS = [
    "a b  c",
    "  lead trail  ",
    "",
    "\n",
    "x\n\ny\n",
    "   \n \t \nz",
    "crlf\r\nline\r\n",
    "cr\rline",
    "mixed\r\n\rend\r",
    None,
]


def test_edge_texts(spark):
    assert spark_count(spark, EDGE_TEXTS) == model_count(EDGE_TEXTS)


def test_empty_and_space_lines(spark):
    got = spark_count(spark, ["a\n\n   \nb"])
    assert got == {"a": 1, "": 1, "b": 1}


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab \n\r\t"), max_size=30), min_size=1, max_size=6))
def test_random_texts(spark, texts):
    assert spark_count(spark, texts) == model_count(texts)
