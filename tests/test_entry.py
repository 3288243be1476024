"""Driver contract: entry() smoke run and DuckDB parity of every registered query."""

import os
import sys

import pytest

from stratalake.plans import catalog

from .conftest import ROOT, SF_ORACLE

sys.path.insert(0, os.path.join(ROOT, "tools"))


def test_entry(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["country", "state", "kind", "n_entities"]


def test_every_query_has_oracle():
    import __spark_entry__ as E

    assert set(catalog.QUERIES) == set(catalog.ORACLE_SQL)
    assert set(catalog.QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_oracle_parity(spark, name):
    from compare_oracle import compare

    rec = compare(spark, SF_ORACLE, [name])[name]
    assert "error" not in rec, rec.get("error")
    assert rec["match"], rec
    assert rec["type_diff"] == [], rec["types"]


# Queries whose values involve timestamps, dates or snapshot labels.
TIME_SENSITIVE = ["distinct_rollup", "json_schema_read", "bronze_snapshot_roundtrip", "latest_snapshot", "latest_snapshot_subquery", "source_to_bronze"]


@pytest.mark.parametrize("name", TIME_SENSITIVE)
def test_oracle_parity_outside_utc(spark, name):
    """The caller's session time zone does not change any result."""
    from compare_oracle import compare

    key = "spark.sql.session.timeZone"
    before = spark.conf.get(key)
    spark.conf.set(key, "America/Los_Angeles")
    try:
        rec = compare(spark, SF_ORACLE, [name])[name]
    finally:
        spark.conf.set(key, before)
    assert "error" not in rec, rec.get("error")
    assert rec["match"], rec
