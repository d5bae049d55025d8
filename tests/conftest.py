import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from visitlens.schemas import USER_INFO, USER_VISIT_ACTION  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[*]")
        .appName("visitlens-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def action(session_id, user_id=1, time="2024-01-01 10:00:00", keyword=None, click=None, orders=None, pays=None,
           date="2024-01-01", page=0, city=0):
    """One user_visit_action row in schema order."""
    return (date, user_id, session_id, page, time, keyword, click, None if click is None else 7,
            orders, None if orders is None else "5", pays, None if pays is None else "6", city)


@pytest.fixture
def make_actions(spark):
    def make(rows):
        return spark.createDataFrame(rows, USER_VISIT_ACTION)
    return make


@pytest.fixture
def make_users(spark):
    def make(rows):
        return spark.createDataFrame(rows, USER_INFO)
    return make


def user(user_id, age=30, professional="BUILDING", city="NATION_1", sex="male"):
    return (user_id, f"u{user_id}", f"name{user_id}", age, professional, city, sex)
