"""Joins, ranking, reshaping and data tests on small and on skewed rows."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from creatorlens.operators.components import components
from creatorlens.operators import joins, quality, ranking, reshape


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows on one key, some on NULL, the rest spread."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(
        F.concat(F.lit("k"), (F.col("id") % 97).cast("string"))
    )
    return spark.range(3000).select(key.alias("k"), F.col("id").alias("v"))


@pytest.fixture(scope="module")
def lookup(spark):
    names = [("hot", "H")] + [(f"k{i}", f"n{i}") for i in range(0, 97, 2)]
    return spark.createDataFrame(names, "k string, name string")


@pytest.mark.parametrize("how", ["left", "inner"])
def test_joins_agree(skewed, lookup, how):
    plain = rows(skewed.join(lookup, "k", how))
    assert rows(joins.lookup_join(skewed, lookup, "k", how=how)) == plain
    assert rows(joins.lookup_join(skewed, lookup, "k", how=how, broadcast_bytes=0)) == plain
    assert rows(joins.spread_join(skewed, lookup, "k", how=how, spread_by=["v"])) == plain
    assert rows(joins.spread_join(skewed, lookup, "k", how=how, hot=[("hot", 5)], slots=5)) == plain
    assert rows(joins.spread_join(skewed, lookup, "k", how=how, hot=[])) == plain


def test_hot_keys_are_found_and_spread(skewed, lookup):
    assert joins.hot_keys(skewed, "k", 8) == [("hot", 6)]
    assert joins.hot_keys(skewed.limit(0), "k", 8) == []
    lookup.sparkSession.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    lookup.sparkSession.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = joins.spread_join(skewed, lookup, "k", how="inner", spread_by=["v"])
        sizes = (
            joined.withColumn("p", F.spark_partition_id()).filter("k = 'hot'").groupBy("p").count()
        )
        largest = max(row["count"] for row in sizes.collect())
        assert largest < 1000 / 2
    finally:
        lookup.sparkSession.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
        lookup.sparkSession.conf.set("spark.sql.adaptive.enabled", "true")


def test_broadcast_follows_the_measured_size(skewed, lookup):
    def plan(df):
        return df._jdf.queryExecution().optimizedPlan().toString()

    assert "_salt" not in plan(joins.lookup_join(skewed, lookup, "k"))
    assert "strategy=broadcast" in plan(joins.lookup_join(skewed, lookup, "k"))
    assert "_salt" in plan(joins.lookup_join(skewed, lookup, "k", broadcast_bytes=10))


def test_nested_and_binary_values_are_measured_by_content(spark):
    text = F.repeat(F.lit("x"), F.lit(100_000))
    ids = spark.range(10)
    for value in (text, F.struct(text), F.array(text), F.create_map(F.lit("k"), text), text.cast("binary"), F.parse_json(F.to_json(F.struct(text)))):
        assert 1_000_000 <= joins.measured_bytes(ids.select("id", value.alias("v"))) < 1_100_000


def test_hot_keys_of_other_types(spark):
    facts = spark.range(900).select(F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("k"), "id")
    lookup = spark.range(0, 900, 7).select(F.col("id").alias("k"), (F.col("id") * 2).alias("twice"))
    for how in ("left", "inner"):
        assert rows(joins.spread_join(facts, lookup, "k", how=how)) == rows(facts.join(lookup, "k", how))


@pytest.mark.parametrize("n", [1, 7, 40, 5000])
def test_top_with_a_large_lookup(skewed, lookup, n):
    facts, order = skewed.filter(F.col("k") != "hot"), [F.desc("v")]
    for df, names in ((facts, lookup), (skewed, lookup), (facts, lookup.filter("k < 'k2'"))):
        expected = rows(df.join(names, "k").orderBy(*order).limit(n))
        assert rows(joins.top_with_lookup(df, names, "k", order, n)) == expected
        got = joins.top_with_lookup(df, names, "k", order, n, broadcast_bytes=0, margin=2)
        assert rows(got) == expected


@pytest.mark.parametrize("limit", [joins.BROADCAST_BYTES, 0])
def test_unseen(spark, skewed, limit):
    history = spark.createDataFrame([("hot",), ("k1",), ("k1",), (None,), ("other",)], "k string")
    new = joins.unseen(skewed, history, "k", broadcast_bytes=limit)
    expected = skewed.filter(F.col("k").isNull() | ~F.col("k").isin("hot", "k1"))
    assert rows(new) == rows(expected)


@pytest.mark.parametrize("n", [1, 3, 1200])
def test_first_per_key(skewed, n):
    order = [F.desc("v")]
    window = Window.partitionBy("k").orderBy(*order)
    expected = skewed.withColumn("r", F.row_number().over(window)).filter(F.col("r") <= n).drop("r")
    assert rows(ranking.first_per_key(skewed, ["k"], order, n)) == rows(expected)


def test_hot_key_is_cut_before_the_shuffle(skewed):
    for n in (1, 1200):
        plan = ranking.first_per_key(skewed, ["k"], [F.desc("v")], n)
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert ("WindowGroupLimit" in text) or ("_slice" in text)


def test_ranked_numbers_all_rows(spark):
    random.seed(3)
    values = [(i, random.choice([None, 1, 2, 5, 9])) for i in range(700)]
    df = spark.createDataFrame(values, "id long, v long").repartition(7)
    order = [F.desc_nulls_last("v"), F.asc("id")]
    expected = df.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    assert rows(ranking.ranked(df, order)) == rows(expected)
    page = ranking.ranked_page(df, order, 20)
    assert rows(page) == rows(expected.filter("rank <= 20"))


def test_radar_and_pivots(spark):
    overview = spark.createDataFrame(
        [("tech", 0.02, 100.0, None, 4.0, 0.01), ("music", 0.01, 33.0, 50.0, None, None)],
        "niche string, avg_engagement_rate double, avg_views_per_video double, "
        "avg_subscribers double, avg_uploads_last_30d double, avg_like_rate double",
    )
    radar = {row["metric"]: (row["tech"], row["music"], row["gaming"]) for row in
             reshape.niche_radar(overview).collect()}
    assert radar == {
        "Engagement": (100, 50, None),
        "Avg Views": (100, 33, None),
        "Avg Subs": (0, 100, None),
        "Upload Freq": (100, 0, None),
        "Like Rate": (100, 0, None),
    }
    days = spark.createDataFrame(
        [("tech", 1, 4), ("music", 7, 2), ("tech", None, 9)],
        "niche string, upload_day_of_week int, count long",
    )
    wide = [tuple(row) for row in reshape.upload_day_pivot(days, ["music", "tech"]).collect()]
    assert wide[0] == ("Sun", None, 4) and wide[6] == ("Sat", 2, None) and len(wide) == 7


def test_quality_finds_failures(spark):
    channels = spark.createDataFrame(
        [("a", "x", "tech", "ID"), ("a", "y", "cooking", "ID"), (None, None, None, "MARS")],
        "channel_id string, channel_name string, niche string, region string",
    )
    videos = spark.createDataFrame([("v", "a"), ("v", None), (None, "zz")], "video_id string, channel_id string")
    found = {
        (r.table_name, r.column_name, r.test): r.failures
        for r in quality.staging_tests(channels, videos).collect()
    }
    assert found == {
        ("stg_channels", "channel_id", "not_null"): 1,
        ("stg_channels", "channel_name", "not_null"): 1,
        ("stg_channels", "niche", "accepted_values"): 1,
        ("stg_channels", "region", "accepted_values"): 1,
        ("stg_channels", "channel_id", "unique"): 1,
        ("stg_videos", "video_id", "not_null"): 1,
        ("stg_videos", "channel_id", "not_null"): 1,
        ("stg_videos", "video_id", "unique"): 1,
    }
    orphans = quality.foreign_key(videos, "fact", "channel_id", channels)
    assert [r.failures for r in orphans.collect()] == [1]


@pytest.mark.parametrize("together", [0, 25, 10_000])
def test_components_in_rounds_and_in_one_task(spark, together):
    rng = random.Random(together)
    links = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (500, 501), (501, 500)]
    links += [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(30)]
    rng.shuffle(links)
    label = {n: n for pair in links if pair[0] != pair[1] for n in pair}
    for _ in label:
        for a, b in links:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    found = components(spark.createDataFrame(links, "a long, b long"), together=together).collect()
    assert dict(map(tuple, found)) == label and len(found) == len(label)
    assert components(spark.createDataFrame([], "a long, b long"), together=together).count() == 0
