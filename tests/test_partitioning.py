"""Results do not depend on the number of shuffle partitions (catches order- or partition-dependent
faults of the kind the original job had in its top-N and statistics)."""

import pytest

import __spark_entry__ as E

DATA = "/root/testdata/sf0.001"
NAMES = ["session_aggr_stat", "top10_category", "top10_session", "random_extract", "category_counts", "word_count"]


def rows(spark, name):
    return sorted(tuple(map(str, r)) for r in E.queries()[name](spark, DATA).collect())


@pytest.mark.parametrize("name", NAMES)
def test_same_result_for_1_and_200_partitions(spark, name):
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        one = rows(spark, name)
        spark.conf.set("spark.sql.shuffle.partitions", "200")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        many = rows(spark, name)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert one == many and len(one) > 0
