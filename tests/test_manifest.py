"""Tables of committed folders: conflicts, failed writers, merged sinks, the id index, newest snapshots."""

import random

import pytest
from pyspark.sql import functions as F

from creatorlens import schemas
from creatorlens.plans import staging
from creatorlens.plans.current import CurrentChannels
from creatorlens.sources import manifest
from creatorlens.sources.id_index import IdIndex
from creatorlens.sources.manifest import Conflict, ManifestTable, swapped
from creatorlens.sources.workspace import create_file, fresh_folder, listed_names
from creatorlens.streaming import discovery


@pytest.fixture()
def root(spark):
    return fresh_folder(spark, "manifest")


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "n long").coalesce(1)


def held(table, parts=None):
    return sorted(r["n"] for r in table.read(parts).collect())


def test_versions_conflicts_and_sweeping(spark, root, monkeypatch):
    schema = numbers(spark, 1).schema
    one, two = ManifestTable(spark, root, schema), ManifestTable(spark, root, schema)
    assert held(one) == [] and one.version().number == 0
    first = one.write(numbers(spark, 1, 2))
    assert first.rows == 2 and held(one) == []  # written, not committed
    one.commit(lambda parts: [*parts, first])
    more = two.write(numbers(spark, 3))
    raced = []

    def late(parts):
        if not raced:  # another writer commits between reading and writing
            raced.append(one.commit(lambda parts: [*parts, one.write(numbers(spark, 4))]))
        return [*parts, more]

    two.commit(late)
    assert held(one) == held(two) == [1, 2, 3, 4]
    merged = one.write(one.read([first, more]))
    one.commit(swapped([first, more], [merged]))
    with pytest.raises(Conflict):
        two.commit(swapped([first], [more]))
    monkeypatch.setattr(manifest, "PATIENCE", 0.3)
    assert create_file(spark, one._commit_file(one.version().number + 1), "[{")  # a writer that died
    assert not create_file(spark, one._commit_file(1), "[]")
    assert held(one) == [1, 2, 3, 4]
    one.commit(lambda parts: [*parts, one.write(numbers(spark, 5))])
    lost = two.write(numbers(spark, 9))
    one.sweep(kept=1)
    names = listed_names(spark, f"{root}/data")
    assert held(two) == [1, 2, 3, 4, 5] and first.folder.split("/")[1] not in names
    assert lost.folder.split("/")[1] in names  # perhaps still being written
    one.sweep(kept=1, orphan_seconds=-1)
    assert lost.folder.split("/")[1] not in listed_names(spark, f"{root}/data") and held(two) == [1, 2, 3, 4, 5]


def test_a_sink_stays_small_and_a_failed_merge_changes_nothing(spark, root, monkeypatch):
    def batch(nth):
        return spark.createDataFrame([("u", "videos", 1, f"v{nth}"), ("u", "videos", 2, f"v{nth - 1}")], discovery.SINK_SCHEMA)

    def stored():
        return sorted(r["video_id"] for r in discovery.read_sink(spark, root).collect())

    for nth in range(5):
        discovery.store_batch(batch(nth), nth, root, "s", fan=2)
    assert len(discovery._table(spark, root).version().parts) <= 4
    want = sorted(f"v{n}" for n in range(-1, 5))
    assert stored() == want
    with monkeypatch.context() as broken:
        commit = ManifestTable.commit

        def fails(self, change):
            if "swapped" in change.__qualname__:
                raise OSError("lost")
            return commit(self, change)

        broken.setattr(ManifestTable, "commit", fails)
        with pytest.raises(OSError):
            discovery.store_batch(batch(5), 5, root, "s", fan=2)
    discovery.store_batch(batch(5), 5, root, "s", fan=2)  # the batch is repeated
    assert stored() == sorted([*want, "v5"])
    with pytest.raises(ValueError):
        discovery.store_batch(batch(3), 3, root, "s")
    discovery.store_batch(batch(5), 0, root, "another")
    assert stored() == sorted([*want, "v5"])


def test_index_reads_only_the_buckets_asked_for(spark, root):
    def ids(*names):
        return spark.createDataFrame([(n,) for n in names], "video_id string")

    index = IdIndex(spark, root, "video_id", buckets=4)
    assert index.known(ids("a")).count() == 0 and index.covered() == 0
    every = [f"v{i}" for i in range(60)]
    for begin in range(0, 60, 6):  # ten loads: folders of a bucket are merged on the way
        index.add(ids(*every[begin : begin + 6], None), 7)
    assert index.covered() == 70 and len(index.table.version().parts) < 4 * 8 + 8
    for asked in (["v3", "x", None, "v3"], every + ["y"]):
        got = sorted(r["video_id"] for r in index.known(ids(*asked)).collect())
        assert got == sorted({a for a in asked if a in set(every)})
    in_groups = index.known(ids(*every, "z"), broadcast_bytes=1000)
    assert sorted(r["video_id"] for r in in_groups.collect()) == sorted(every)
    found = index.known(ids("v3"))
    assert len({f.split("_bucket=")[1].split("/")[0] for f in found.inputFiles()}) == 1
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(video_id" in plan  # reaches the files' Bloom filters
    history = plan[plan.index("BroadcastHashJoin") : plan.index("BroadcastExchange")]
    assert "FileScan" in history and "Exchange" not in history
    index.reset()
    assert index.known(ids("v3")).count() == 0


def test_newest_snapshots_equal_those_of_all_history(spark, root):
    rng = random.Random(11)
    current, history = CurrentChannels(spark, root, buckets=3), []
    sizes = []
    for load in range(5):
        rows = []
        for _ in range(rng.randint(1, 12)):
            channel = rng.choice([None, "a", "b", "c", "d", "é", ""])
            when = f"2024-01-0{rng.randint(1, 9)}T00:00:00+00:00" if rng.random() < 0.9 else None
            rows.append((channel, rng.choice([None, "", "n1", "n2"]), "u", rng.choice([None, 5, 9]), "d", when, "tech", "ID", rng.choice(["c1", None])))
        if load == 3:
            rows = history[:4] + rows[:1] * 2  # late and repeated
        history += rows
        for _ in range(2 if load == 2 else 1):  # a merge that is repeated
            sizes.append(len(current.merge(spark.createDataFrame(rows, schemas.RAW_CHANNELS))))
        want = staging.stg_channels(spark.createDataFrame(history, schemas.RAW_CHANNELS))
        assert sorted(map(tuple, staging.stg_channels(current.read()).collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    before = {p.folder for p in current.table.version().parts}
    touched = current.merge(spark.createDataFrame([("a", "new", "u", 1, "d", "2025-01-01", "tech", "ID", "c")], schemas.RAW_CHANNELS))
    after = {p.folder for p in current.table.version().parts}
    assert len(touched) == 1 and len(before - after) == 1  # other buckets stay as they are
    assert current.merge(spark.createDataFrame([], schemas.RAW_CHANNELS)) == []
