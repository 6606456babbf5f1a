"""Every registered query against its SQL on another engine, at the smallest scale."""

import pytest

import __spark_entry__ as entry
from compare import connect, differences
from tables import TABLES

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(TABLES)


def test_names_agree():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, duck, name):
    df = QUERIES[name](spark, TABLES)
    assert differences(df, duck, ORACLES[name]) == []


def test_entry(spark):
    assert entry.entry(spark).count() == 5


def test_same_rows_when_no_lookup_may_be_broadcast(spark, duck, monkeypatch):
    from checks import queries as registered
    from checks.fixture import Dataset
    from creatorlens.operators import joins

    for join in (joins.lookup_join, joins.known_keys, joins.unseen, joins.top_with_lookup):
        monkeypatch.setitem(join.__kwdefaults__, "broadcast_bytes", 0)
    separate = Dataset(spark, TABLES)
    monkeypatch.setattr(registered, "dataset", lambda *_: separate)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("fct_video_performance", "agg_channel_metrics", "overview_top_videos",
                     "video_explorer_live", "channel_leaderboard", "incremental_new_videos"):
            df = QUERIES[name](spark, TABLES)
            assert differences(df, duck, ORACLES[name]) == [], name
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
