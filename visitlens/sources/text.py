"""Text sources: plain lines (S12) and tab-separated rows with a literal ``null``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from visitlens.schemas import INFO


def read_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line of the text files under ``path`` (column ``line``)."""
    return spark.read.text(path).withColumnRenamed("value", "line")


def read_tsv(spark: SparkSession, path: str, schema: StructType = INFO, null_text: str = "null") -> DataFrame:
    """Tab-separated rows with a declared schema; the text ``null`` reads as NULL."""
    return spark.read.csv(path, sep="\t", schema=schema, nullValue=null_text, header=False, mode="PERMISSIVE")


def _field_error(fields: Column, k: int, name: str, kind: str, null_text: str) -> Column:
    value = F.get(fields, F.lit(k))
    bad = (value != null_text) & value.try_cast(kind).isNull()
    return F.when(bad, F.lit(f"{name}: no valid {kind}"))


def parse_tsv(lines: DataFrame, schema: StructType = INFO, null_text: str = "null", line: str = "line") -> DataFrame:
    """S14 over a column of lines: the declared columns, the line itself where it is malformed, and why.

    A line must have exactly the declared number of tab-separated fields; the text ``null`` is NULL, every other field
    must read as its column's type (blanks around a number are allowed, an empty number is not). A malformed line keeps
    the fields that do read, all others are NULL; ``malformed_line`` holds the text and ``error`` the first fault, both
    NULL for a good line. A null line gives no row. No quoting. Only text and splits: generated code, no parser.
    """
    n = len(schema.fields)
    split = lines.where(F.col(line).isNotNull()).select(F.col(line).alias("line"), F.split(line, "\t", -1).alias("fields"))
    fields, size = F.col("fields"), F.size("fields")
    wrong = F.when(size != n, F.concat(size.cast("string"), F.lit(f" of {n} fields")))
    typed = [(k, f) for k, f in enumerate(schema.fields) if not isinstance(f.dataType, StringType)]
    faults = [_field_error(fields, k, f.name, f.dataType.simpleString(), null_text) for k, f in typed]
    error = reduce(lambda a, b: F.coalesce(a, b), [wrong, *faults])
    values = [F.nullif(F.get(fields, F.lit(k)), F.lit(null_text)).try_cast(f.dataType).alias(f.name) for k, f in enumerate(schema.fields)]
    return split.select(*values, F.when(error.isNotNull(), F.col("line")).alias("malformed_line"), error.alias("error"))


def read_tsv_checked(spark: SparkSession, path: str, schema: StructType = INFO, null_text: str = "null") -> DataFrame:
    """``parse_tsv`` of the text files under ``path``."""
    return parse_tsv(read_text_lines(spark, path), schema, null_text)


def good_rows(parsed: DataFrame) -> DataFrame:
    """The rows of well-formed lines, without the two columns about faults."""
    return parsed.where(F.col("error").isNull()).drop("malformed_line", "error")


def malformed_counts(parsed: DataFrame) -> DataFrame:
    """(error, n_lines) of the malformed lines; at most a row for each kind of fault."""
    return parsed.where(F.col("error").isNotNull()).groupBy("error").agg(F.count(F.lit(1)).alias("n_lines"))
