"""Catalog tables of versions behind a view: replacements that fail, races, readers planned before."""

import uuid

import pytest

from creatorlens.sources import tables
from creatorlens.sources.tables import CatalogStore, VersionedCatalogStore


@pytest.fixture()
def store(spark):
    return VersionedCatalogStore(spark, f"pointer_{uuid.uuid4().hex[:8]}")


def rows(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "n long")


def held(store):
    return sorted(r["n"] for r in store.read("probe").collect())


def test_modes(spark, store):
    assert not store.exists("probe") and store.live("probe") is None and store.versions("probe") == {}
    assert tables.load(rows(spark, 1).limit(0), store, "probe") == 0 and not store.exists("probe")
    assert tables.load(rows(spark, 1, 2), store, "probe", tables.CREATE) == 2
    with pytest.raises(ValueError, match="already exists"):
        tables.load(rows(spark, 3), store, "probe", tables.CREATE)
    with pytest.raises(ValueError, match="already exists"):
        store.write(rows(spark, 3), "probe", tables.CREATE)
    assert tables.load(rows(spark, 2, 3), store, "probe") == 2 and held(store) == [1, 2, 2, 3]
    store.write(rows(spark, 9), "probe", tables.OVERWRITE)
    assert held(store) == [9]
    assert tables.save(rows(spark, 9).limit(0), store, "probe").isEmpty()  # replaced by nothing
    store.drop("probe")
    assert not store.exists("probe") and store.versions("probe") == {}


def test_a_failing_switch_leaves_the_old_rows(spark, store, monkeypatch):
    tables.save(rows(spark, 1, 2), store, "probe")
    live, run = store.live("probe"), spark.sql

    def broken(text, *args, **kwargs):
        if text.startswith("ALTER VIEW"):
            raise OSError("no catalog")
        return run(text, *args, **kwargs)

    monkeypatch.setattr(spark, "sql", broken)
    with pytest.raises(OSError, match="no catalog"):
        tables.save(rows(spark, 3), store, "probe")
    monkeypatch.undo()
    assert held(store) == [1, 2] and store.live("probe") == live
    for n in range(4):  # the version left behind goes with the old ones
        tables.save(rows(spark, n), store, "probe")
    assert held(store) == [3] and sorted(store.versions("probe").values()) == [4, 5]


def test_a_reader_planned_before_and_a_table_made_of_itself(spark, store):
    tables.save(rows(spark, 1, 2), store, "probe")
    before = store.read("probe")
    tables.save(before.selectExpr("n + 10 AS n"), store, "probe")
    assert held(store) == [11, 12] and before.count() == 2


def test_other_columns_and_the_later_of_two_writers(spark, store):
    tables.save(rows(spark, 1), store, "probe")
    one, _ = store.staged(rows(spark, 2), "probe")
    two, _ = store.staged(spark.createDataFrame([(3, "x")], "n long, t string"), "probe")
    store.publish(two, "probe")
    assert [tuple(r) for r in store.read("probe").collect()] == [(3, "x")]
    store.publish(one, "probe")
    assert held(store) == [2] and store.read("probe").columns == ["n"]


def test_names_that_begin_alike_are_kept_apart(spark, store):
    tables.save(rows(spark, 1), store, "probe")
    tables.save(rows(spark, 7), store, "probe_v2")
    for n in range(3):
        tables.save(rows(spark, n), store, "probe")
    assert [r["n"] for r in store.read("probe_v2").collect()] == [7]


def test_a_plain_table_is_refused(spark, store):
    tables.save(rows(spark, 1), CatalogStore(spark, store.prefix), "probe")
    with pytest.raises(ValueError, match="not a view"):
        tables.save(rows(spark, 2), store, "probe")
    assert held(store) == [1]
