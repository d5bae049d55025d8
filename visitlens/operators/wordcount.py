"""Word count over text (A10): lines, then tokens split on one space, then counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Line terminators of a text file (CR LF, LF, CR) and the token separator.
LINE_BREAK = "\r\n|\n|\r"
FINAL_LINE_BREAK = "(\r\n|\n|\r)\\z"
TOKEN_SEPARATOR = " "


def _empty() -> Column:
    return F.array().cast("array<string>")


def lines_of(text: Column) -> Column:
    """Lines of a whole text: a final terminator ends the last line (no empty line after it);
    an empty text has no lines.

    Texts without a carriage return (the usual case) take the fast path: a literal one-character
    split and an ``endswith`` check, no regular expression.
    """
    lf_body = F.when(text.endswith("\n"), F.substr(text, F.lit(1), F.length(text) - 1)).otherwise(text)
    lf_lines = F.split(lf_body, "\n")
    any_lines = F.split(F.regexp_replace(text, FINAL_LINE_BREAK, ""), LINE_BREAK)
    return (
        F.when(text == "", _empty())
        .when(F.contains(text, F.lit("\r")), any_lines)
        .otherwise(lf_lines)
    )


def tokens_of(line: Column) -> Column:
    """Tokens of a line split on single spaces: trailing empty tokens are dropped, inner and
    leading ones kept; an empty line is one empty token, a line of only spaces has none."""
    trimmed = F.rtrim(line)
    return F.when((line != "") & (trimmed == ""), _empty()).otherwise(F.split(trimmed, TOKEN_SEPARATOR))


def text_lines(texts: DataFrame, column: str = "text") -> DataFrame:
    """One row per line of every text in ``column``."""
    return texts.select(F.explode(lines_of(F.col(column))).alias("line"))


def word_count(lines: DataFrame, column: str = "line") -> DataFrame:
    """(word, count) over lines. Map-side partial counts bound the shuffle by distinct words per
    task, so a very frequent word costs one partial row per task."""
    words = lines.select(F.explode(tokens_of(F.col(column))).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("count"))
