"""Malformed tab-separated lines: kept apart, named and counted."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitlens.sources.text import good_rows, malformed_counts, parse_tsv, read_tsv_checked

LINES = {
    "1\ta\t1990": (1, "a", 1990, None), "2\tnull\tnull": (2, None, None, None), "null\t\t3": (None, "", 3, None), " 4 \t x \t+5": (4, " x ", 5, None),
    "5\tb": (5, "b", None, "2 of 3 fields"), "": (None, None, None, "1 of 3 fields"), "6\tb\t7\t": (6, "b", 7, "4 of 3 fields"), "x\tb\t7": (None, "b", 7, "id: no valid int"),
    "7\tb\tseven": (7, "b", None, "year: no valid bigint"), "x\tb\ty": (None, "b", None, "id: no valid int"), "99999999999\tb\t1": (None, "b", 1, "id: no valid int"),
    '8\t"q\t9': (8, '"q', 9, None), "9\tb\t": (9, "b", None, "year: no valid bigint"), "1.5\tb\t1": (None, "b", 1, "id: no valid int"), "10\té\t1": (10, "é", 1, None),
}


def test_lines(spark):
    df = spark.createDataFrame([(t,) for t in LINES] + [(None,)], "line string").withColumn("error", F.lit("mine"))
    got = parse_tsv(df)
    assert got.columns == ["id", "name", "year", "malformed_line", "error"] and dict(got.dtypes)["year"] == "bigint"
    want = {t: v for t, v in LINES.items()}
    # a line without any text is one empty field
    rows = {(r["id"], r["name"], r["year"], r["error"]) for r in got.collect()}
    assert rows == set(want.values()) and got.count() == len(LINES)
    assert {r[0] for r in got.where("error is not null").select("malformed_line").collect()} == {t for t, v in LINES.items() if v[3]}
    assert got.where("error is null and malformed_line is not null").count() == 0
    assert good_rows(got).columns == ["id", "name", "year"] and good_rows(got).count() == sum(v[3] is None for v in LINES.values())
    counts = {r["error"]: r["n_lines"] for r in malformed_counts(got).collect()}
    assert counts == {"2 of 3 fields": 1, "1 of 3 fields": 1, "4 of 3 fields": 1, "id: no valid int": 4, "year: no valid bigint": 2}


def test_files_and_other_schemas(spark, tmp_path):
    (tmp_path / "a.txt").write_text("2024-01-01\t1.5\n2024-13-01\t2\n-\t-\n")
    schema = T.StructType([T.StructField("d", T.DateType()), T.StructField("x", T.DoubleType())])
    got = read_tsv_checked(spark, str(tmp_path), schema, null_text="-")
    assert {(str(r["d"]), r["x"], r["error"]) for r in got.collect()} == {
        ("2024-01-01", 1.5, None), ("None", None, None), ("None", 2.0, "d: no valid date")}
    assert malformed_counts(parse_tsv(spark.createDataFrame([], "line string"))).count() == 0
