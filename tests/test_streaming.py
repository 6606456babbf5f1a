"""Streamed discovery: nothing twice, nothing lost, repeated batches harmless."""

import json

import pytest

from creatorlens.sources.workspace import fresh_folder
from creatorlens.streaming import discovery


def drop(spark, folder, *records):
    text = [(r if isinstance(r, str) else json.dumps(r),) for r in records]
    spark.createDataFrame(text, "value string").coalesce(1).write.mode("append").text(folder)


def entry(video, position=1, url="u", tab="videos"):
    return {"config_url": url, "tab": tab, "position": position, "id": video}


@pytest.fixture()
def folders(spark):
    root = fresh_folder(spark, "stream")
    return f"{root}/drops", f"{root}/sink", f"{root}/checkpoint"


def stored(spark, sink):
    return sorted((r.video_id, r.config_url) for r in discovery.read_sink(spark, sink).collect())


def test_duplicates_in_and_across_batches(spark, folders):
    drops, sink, checkpoint = folders
    assert stored(spark, sink) == []
    drop(spark, drops, entry("a", 2), entry("a", 1, "w"), entry("b"), "{bad", {"id": ""})
    discovery.discover(spark, drops, sink, checkpoint).awaitTermination()
    assert stored(spark, sink) == [("a", "w"), ("b", "u")]
    drop(spark, drops, entry("b", url="later"), entry("c", tab="streams"), entry("c", 9))
    discovery.discover(spark, drops, sink, checkpoint, files_per_batch=1).awaitTermination()
    assert stored(spark, sink) == [("a", "w"), ("b", "u"), ("c", "u")]
    discovery.discover(spark, drops, sink, checkpoint).awaitTermination()
    assert len(stored(spark, sink)) == 3


def test_a_new_checkpoint_keeps_the_sink(spark, folders):
    drops, sink, checkpoint = folders
    drop(spark, drops, entry("a"), entry("b"))
    discovery.discover(spark, drops, sink, checkpoint).awaitTermination()
    drop(spark, drops, entry("c"))
    discovery.discover(spark, drops, sink, checkpoint + "-2").awaitTermination()
    assert [video for video, _ in stored(spark, sink)] == ["a", "b", "c"]


def test_a_repeated_batch_replaces_itself(spark, folders):
    _, sink, _ = folders
    schema = discovery.SINK_SCHEMA
    first = spark.createDataFrame([("u", "videos", 1, "a")], schema)
    second = spark.createDataFrame([("u", "videos", 2, "b"), ("u", "videos", 1, "a")], schema)
    discovery.store_batch(first, 0, sink, "s")
    for _ in range(2):
        discovery.store_batch(second, 1, sink, "s")
    assert stored(spark, sink) == [("a", "u"), ("b", "u")]
