from __future__ import annotations

import os

import pytest

from tarnhouse.session import get_session

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="4g",
        spark__ui__enabled="false",
        spark__sql__maxMetadataStringLength="10000",
        spark__sql__debug__maxToStringFields="1000",
        spark__ui__showConsoleProgress="false",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoints")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return DATA


@pytest.fixture(params=["10MB", "-1"])
def broadcast_limit(spark, request):
    """Both ways through joins and aggregates: with a small side and with a large one."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, request.param)
    yield request.param
    spark.conf.set(name, before)


def rows(df, *order):
    """Collected rows as tuples, sorted by text so that blanks sort too."""
    got = [tuple(r) for r in df.collect()]
    return got if order else sorted(got, key=repr)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
