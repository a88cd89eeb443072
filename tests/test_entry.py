"""Driver contract: entry runs, every query has a name and most an oracle."""

import __spark_entry__ as entry


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert {"response_id", "tot", "size", "label"} <= set(df.columns)


def test_every_query_has_an_oracle():
    from varloom.plans.catalog import ORACLES, QUERIES

    assert set(ORACLES) == set(QUERIES)
    assert set(entry.oracle_sql()) <= set(entry.queries())
