"""How the work of a step is dealt out: what would show only on large tables."""

import re
from datetime import date

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from creatorlens.operators import joins
from creatorlens.plans import marts
from creatorlens.sources import dumps
from creatorlens.sources.id_index import IdIndex
from creatorlens.sources.tables import FolderStore, save


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_lines_are_written_once_a_row(data):
    """The steps that spoil a line don't repeat the JSON writer in each other."""
    assert plan(data.video_lines).count("StructsToJson") + plan(data.video_lines).lower().count("to_json") <= 4


def test_fields_are_found_by_place(spark):
    """A line becomes a struct: no use of a field goes through a map's keys. Absent, null and repeated keys differ as before."""
    lines = spark.createDataFrame(
        [('{"id":"a","title":null,"view_count":"5","view_count":7}',), ('{"id":"b"}',), ("{}",), ("[1]",), ("null",), ("{",), (None,)],
        "value string",
    )
    parsed = dumps.parse_videos(lines, "now")
    assert "map_keys" not in plan(parsed) and "map_contains" not in plan(parsed)
    got = {tuple(r) for r in parsed.select("video_id", "title", "view_count", "tags").collect()}
    assert got == {("a", None, 7, "[]"), ("b", "", 0, "[]"), (None, "", 0, "[]")}


def test_videos_are_stored_in_pieces_that_tasks_can_share(spark, tmp_path):
    rows = spark.range(0, 400_000, 1, 1).select(
        F.sha2(F.col("id").cast("string"), 256).alias("video_id"), F.md5(F.col("id").cast("string")).alias("title")
    )
    store = FolderStore(spark, str(tmp_path))
    assert save(rows, store, "raw_videos").count() == 400_000
    [file] = (tmp_path / "raw" / "raw_videos").glob("*.parquet")
    assert pq.ParquetFile(file).num_row_groups >= 5


def test_channel_join_has_tasks_by_rows(spark, monkeypatch):
    """Lines that compress well are no reason for few tasks; texts are cut before they are sorted."""
    monkeypatch.setattr(joins, "TASK_ROWS", 4)
    lines = spark.range(200).select(
        F.concat(F.lit("u"), F.col("id")).alias("config_url"),
        F.to_json(F.struct(F.lit("c").alias("channel"), F.lit("w").alias("url"), F.repeat(F.lit("d"), F.lit(3000)).alias("description"))).alias("value"),
    )
    extracts = lines.filter("config_url <> 'u7'").withColumn("value", F.replace("value", F.lit('"description"'), F.lit('"channel_description"')))
    found = dumps.parse_channels(lines, extracts, "now")
    assert {tuple(r) for r in found.select("channel_name", F.length("description")).distinct().collect()} == {("c", 500)}
    assert found.count() == 200 and found.rdd.getNumPartitions() == 50
    below = plan(found).split("Join LeftOuter")[1]
    assert below.count("substring(coalesce(") == 2


def test_rates_are_not_shuffled(spark, data, tmp_path, monkeypatch):
    """The shuffle that clusters the fact carries what rates are made of, not the rates."""
    plans = []

    def kept(df, store, name):
        plans.append((name, plan(df)))
        return save(df, store, name)

    monkeypatch.setattr(marts, "save", kept)
    marts.build(data.raw_channels.limit(50), data.raw_videos.limit(200), FolderStore(spark, str(tmp_path)), date(2001, 8, 2))
    fact = dict(plans)["fct_video_performance"]
    below = re.split(r"RepartitionByExpression", fact)[1]
    assert "try_divide" not in below.lower() and " / " not in below and "views_per_day" not in below


def test_ids_out_of_parsed_lines_are_not_broadcast_unmeasured(spark):
    """Spark takes ids beside a wide record for few bytes; where many were measured, they are shuffled."""
    lines = spark.range(300).select(F.to_json(F.struct(F.concat(F.lit("v"), F.col("id")).alias("id"))).alias("value"))
    videos = dumps.parse_videos(lines, "now")
    ids = spark.range(200, 400).select(F.concat(F.lit("v"), F.col("id")).alias("video_id"))
    found = joins.found_in(ids, "video_id", {"has_video": videos}, broadcast_bytes=0)
    new = joins.unseen(ids, videos, "video_id", broadcast_bytes=0)
    for df in (found, new):
        assert "BroadcastExchange" not in df._jdf.queryExecution().executedPlan().toString()
    assert found.filter("has_video").count() == 100 and found.count() == 200
    assert sorted(r["video_id"] for r in new.collect()) == [f"v{i}" for i in range(300, 400)]


def test_index_takes_a_large_batch_without_the_driver(spark, tmp_path):
    """Groups of buckets, each broadcast, would together be the whole batch on the driver."""
    name = F.concat(F.lit("v"), F.col("id")).alias("video_id")
    index = IdIndex(spark, str(tmp_path), "video_id", buckets=4)
    index.add(spark.range(0, 2000, 2).select(name), 1000)
    index.add(spark.range(0, 400, 4).select(name), 100)  # ids that it has already
    batch = spark.range(1000, 3000).select(name)
    asked = batch.unionByName(batch).unionByName(spark.sql("SELECT CAST(NULL AS STRING) AS video_id"))
    known = index.known(asked, broadcast_bytes=1000)
    assert "BroadcastExchange" not in known._jdf.queryExecution().executedPlan().toString()
    want = sorted(f"v{i}" for i in range(1000, 2000, 2))
    for found in (known, index.known(asked)):
        assert sorted(r["video_id"] for r in found.collect()) == want
