"""Every registered query against its SQL twin on the smallest data set."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from pairforge.plans.queries import QUERIES as package_queries
from tests.compare import connect, difference, spark_rows, sql_rows

QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_of_the_package_has_sql():
    assert set(package_queries) <= set(ORACLE)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLE])
def test_query_equals_sql(spark, sf_dir, con, name):
    ours = spark_rows(QUERIES[name](spark, sf_dir))
    assert difference(ours, sql_rows(con, ORACLE[name])) is None


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 1


WHOLE = [
    "length_report",
    "long_side_stats",
    "retention",
    "length_filter",
    "long_examples",
    "sample_long",
    "exceeds_by",
    "job_length_curation",
]


def test_many_short_turns_are_long(spark, tmp_path):
    """Short turns that together exceed the limit count, in Spark and in SQL."""
    talk = [(1, i, "user" if i % 2 == 0 else "assistant", "uno dos tres") for i in range(200)]
    talk += [(2, 0, "system", "s"), (2, 1, "user", None), (2, 2, "assistant", "x"), (3, 5, "user", "y")]
    frame = spark.createDataFrame(talk, "conv_id long, turn long, role string, text string")
    frame.toPandas().to_parquet(f"{tmp_path}/conversations.parquet")
    con = connect(str(tmp_path))
    for name in WHOLE:
        ours = spark_rows(QUERIES[name](spark, str(tmp_path)))
        assert difference(ours, sql_rows(con, ORACLE[name])) is None
    # a turn has 5 tokens, so the conversation of pair i has 4 or 5 + 10 * (i + 1)
    assert 80 <= QUERIES["length_report"](spark, str(tmp_path)).first()["exceeding"] <= 90
    assert QUERIES["length_filter"](spark, str(tmp_path)).where("conv_id > 1000003 + 100 and conv_id < 2000000").count() == 0
