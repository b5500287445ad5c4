"""Every query of the driver contract runs on the smallest tables; what has SQL agrees with it at sf0.01 in the driver's check."""

import os

import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
CORE = sorted(k for k in entry.queries() if not (k[0] == "p" and k[1].isdigit()))


def test_entry(spark):
    if os.path.isdir(FOLDER):
        assert entry.entry(spark).count() > 0


def test_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", CORE)
def test_runs(spark, name):
    if not os.path.isdir(FOLDER):
        pytest.skip("no test tables here")
    entry.queries()[name](spark, FOLDER).write.format("noop").mode("overwrite").save()


def test_broadcast_and_pushdown(spark):
    if not os.path.isdir(FOLDER):
        pytest.skip("no test tables here")
    plan = entry.queries()["review_progress"](spark, FOLDER)._jdf.queryExecution().toString()
    assert "ReadSchema: struct<question_id:string>" in plan
