"""Staging, metrics, marts and serving on hand-made rows."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from creatorlens import schemas
from creatorlens.plans import marts, metrics, serving, staging
from creatorlens.sources.tables import CatalogStore, FolderStore
from creatorlens.sources.workspace import discard, fresh_folder, path_exists

DAY = date(2024, 3, 1)
NOW = "2024-02-29T10:00:00+00:00"


def frame(spark, schema, rows, **defaults):
    full = [{**{name: None for name in schema.names}, **defaults, **row} for row in rows]
    return spark.createDataFrame([tuple(row[n] for n in schema.names) for row in full], schema)


def channels(spark, *rows):
    base = dict(scraped_at=NOW, niche="tech", region="ID", config_name="cfg")
    return frame(spark, schemas.RAW_CHANNELS, rows, **base)


def videos(spark, *rows):
    base = dict(scraped_at=NOW, niche="tech", region="ID", is_live=False, was_live=False)
    return frame(spark, schemas.RAW_VIDEOS, rows, **base)


def one(df, **where):
    for name, value in where.items():
        df = df.filter(F.col(name) == value)
    found = df.collect()
    assert len(found) == 1
    return found[0]


def test_latest_snapshot_with_a_name(spark):
    raw = channels(
        spark,
        dict(channel_id="a", channel_name="old", subscriber_count=5, scraped_at="2024-01-01T00:00:00+00:00"),
        dict(channel_id="a", channel_name="new", subscriber_count=10_000),
        dict(channel_id="b", channel_name=None),
        dict(channel_id="c", channel_name=None, config_name=""),
        dict(channel_id="d", channel_name="", config_name="kept?"),
        dict(channel_id=None, channel_name="no id"),
        dict(channel_id="", channel_name="blank id"),
    )
    got = {row.channel_id: row for row in staging.stg_channels(raw).collect()}
    assert set(got) == {"a", "b", ""}
    assert (got["a"].channel_name, got["a"].size_tier) == ("new", "small")
    assert got["b"].channel_name == "cfg"
    assert str(got["a"].scraped_at) == "2024-02-29 10:00:00"


def test_equal_snapshots_give_one_stable_row(spark):
    raw = channels(
        spark,
        dict(channel_id="a", channel_name="x", subscriber_count=1),
        dict(channel_id="a", channel_name="y", subscriber_count=2),
        dict(channel_id="a", channel_name="z", subscriber_count=None),
    )
    for parts in (1, 3):
        assert one(staging.stg_channels(raw.repartition(parts))).channel_name == "y"


def test_videos_are_not_deduplicated_unless_asked(spark):
    raw = videos(
        spark,
        dict(video_id="v", upload_date="2024-02-25", scraped_at="2024-02-27T00:00:00+00:00", view_count=1),
        dict(video_id="v", upload_date="2024-02-25", view_count=2),
        dict(video_id=None),
    )
    assert staging.stg_videos(raw).count() == 2
    row = one(staging.stg_videos(raw, dedupe=True))
    assert (row.view_count, row.upload_day_of_week, row.upload_year, row.upload_month) == (2, 1, 2024, 2)


def test_bad_upload_date_is_an_error(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        staging.stg_videos(videos(spark, dict(video_id="v", upload_date="soon"))).collect()


@pytest.fixture(scope="module")
def small(spark):
    raw_channels = channels(
        spark,
        dict(channel_id="a", channel_name="A", subscriber_count=200),
        dict(channel_id="b", channel_name="B", subscriber_count=0, niche="music"),
        dict(channel_id="t", channel_name="\t \n", subscriber_count=7),
    )
    raw_videos = videos(
        spark,
        dict(video_id="1", channel_id="a", channel_name="own", title="a  b ", view_count=100, like_count=10,
             comment_count=5, upload_date="2024-02-28", duration_seconds=30, is_live=True),
        dict(video_id="2", channel_id="a", channel_name="other", title="", view_count=300, like_count=None,
             comment_count=5, upload_date="2024-01-31"),
        dict(video_id="3", channel_id="a", niche="music", title="héé", view_count=50, like_count=5,
             comment_count=0, upload_date="2024-03-01", was_live=None),
        dict(video_id="4", channel_id="b", niche="music", title=None, view_count=0, like_count=1,
             comment_count=1, upload_date=None),
        dict(video_id="5", channel_id="x", channel_name="own only", title="t", view_count=40, like_count=4,
             comment_count=0, upload_date="2024-02-01"),
        dict(video_id="6", channel_id="y", channel_name=" ", title="t", view_count=900, like_count=4,
             comment_count=0, upload_date="2024-02-01"),
        dict(video_id="7", channel_id="t", channel_name="named", title="t", view_count=800, like_count=4,
             comment_count=0, upload_date="2024-02-01", niche=None),
        dict(video_id="8", channel_id=None, channel_name="no id", title="t", view_count=10, like_count=4,
             comment_count=0, upload_date="2024-02-01"),
    )
    return raw_channels, raw_videos


@pytest.fixture(scope="module")
def built(spark, small):
    store = FolderStore(spark, fresh_folder(spark, "small"))
    return marts.build(*small, store, DAY)


def test_video_metrics(spark, small):
    raw_channels, raw_videos = small
    rows = metrics.video_metrics(
        staging.stg_videos(raw_videos), staging.stg_channels(raw_channels), DAY
    )
    got = {row.video_id: row for row in rows.collect()}
    assert len(got) == 8
    first = got["1"]
    assert (first.channel_name, first.engagement_rate, first.views_per_subscriber) == ("A", 0.15, 0.5)
    assert (first.days_since_upload, first.views_per_day) == (2, 50.0)
    assert (first.title_length, first.title_word_count) == (5, 4)
    assert (got["2"].engagement_rate, got["2"].title_word_count) == (None, 1)
    assert (got["3"].days_since_upload, got["3"].views_per_day, got["3"].title_length) == (0, 50.0, 3)
    assert (got["4"].like_rate, got["4"].views_per_day, got["4"].views_per_subscriber) == (None, None, None)
    assert got["4"].title_length is None and got["4"].title_word_count is None
    assert (got["5"].channel_name, got["5"].size_tier) == ("own only", None)


def test_channel_summary(built):
    summary = built.agg_channel_metrics
    tech = one(summary, channel_id="a", niche="tech")
    assert (tech.channel_name, tech.total_videos, tech.total_views, tech.avg_views) == ("A", 2, 400, 200.0)
    assert (tech.videos_last_30d, tech.videos_last_7d, tech.live_video_count) == (2, 1, 1)
    assert (tech.avg_engagement_rate, tech.avg_views_per_sub) == (0.15, 1.0)
    assert (tech.max_views, tech.min_views, tech.avg_duration_seconds) == (300, 100, 30.0)
    assert (str(tech.earliest_video), str(tech.latest_video)) == ("2024-01-31", "2024-02-28")
    assert one(summary, channel_id="a", niche="music").live_video_count == 0
    empty = one(summary, channel_id="b")
    assert (empty.avg_views_per_sub, empty.avg_like_rate, empty.earliest_video) == (None, None, None)
    assert one(summary, channel_id="x").size_tier is None
    assert summary.filter("channel_id = 'y'").isEmpty()
    assert summary.filter("channel_id = 't'").isEmpty()
    assert one(summary, channel_name="no id").channel_id is None


def test_summary_equals_grouping_every_video(data):
    every = metrics.video_metrics(data.stg_videos, data.written_channels, date(2001, 8, 2))
    plain = (
        every.filter(F.col("channel_name").rlike(r"\S"))
        .groupBy("channel_id", "channel_name", "niche", "region", "subscriber_count", "size_tier")
        .agg(
            F.count(F.lit(1)).alias("total_videos"),
            F.count_if(F.col("days_since_upload") <= 30).alias("videos_last_30d"),
            F.round(F.avg("views_per_subscriber"), 9).alias("avg_views_per_sub"),
            F.round(F.avg("views_per_day"), 6).alias("avg_views_per_day"),
            F.round(F.avg("engagement_rate"), 9).alias("avg_engagement_rate"),
        )
    )
    fast = data.channel_summary.select(
        "channel_id", "channel_name", "niche", "region", "subscriber_count", "size_tier",
        "total_videos", "videos_last_30d", F.round("avg_views_per_sub", 9),
        F.round("avg_views_per_day", 6), F.round("avg_engagement_rate", 9),
    )
    order = repr
    assert sorted(map(tuple, fast.collect()), key=order) == sorted(map(tuple, plain.collect()), key=order)


def test_benchmarks_are_means_of_channel_means(built):
    tech = one(built.agg_niche_overview, niche="tech")
    # channels a (200), x (40) and the one without id (10); y has no name
    assert tech.total_channels == 3
    assert tech.avg_views_per_video == pytest.approx((200 + 40 + 10) / 3)
    assert (tech.id_channels, tech.global_channels, tech.median_subscribers) == (3, 0, 200)


def test_fact_keeps_every_video(built):
    fact = built.fct_video_performance
    assert fact.count() == 8
    mean = (200 + 40 + 10) / 3
    assert one(fact, video_id="2").views_vs_benchmark == pytest.approx(300 / mean)
    assert one(fact, video_id="2").performance_tier == "viral"
    assert one(fact, video_id="6").performance_tier == "viral"
    lost = one(fact, video_id="7")
    assert (lost.niche, lost.views_vs_benchmark, lost.performance_tier) == (None, None, "below_average")


def test_clustered_fact_has_the_same_rows(spark, small, built):
    store = FolderStore(spark, fresh_folder(spark, "clustered"))
    again = marts.build(*small, store, DAY, cluster_fact=True)
    same = lambda m: sorted(map(tuple, m.fct_video_performance.collect()), key=repr)
    assert same(again) == same(built)


def test_summary_without_broadcast(spark, small, built):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = metrics.channel_summary(
            staging.stg_videos(small[1]), staging.stg_channels(small[0]), DAY
        )
        expected = sorted(map(tuple, built.agg_channel_metrics.collect()), key=repr)
        assert sorted(map(tuple, rows.collect()), key=repr) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")


def test_video_type_filter_ignores_unknown_flags(built):
    ids = lambda **filters: {r.video_id for r in serving.video_explorer(built, **filters).collect()}
    assert ids(kind="live") == set()
    assert ids(kind="regular") == {"1", "2", "4", "7"}
    assert ids(kind="whatever") == {"1", "2", "3", "4", "7"}
    assert ids(niche="music", region="") == {"3", "4"}


def test_sorts_are_allow_listed(built):
    with pytest.raises(ValueError):
        serving.video_explorer(built, sort="title; DROP TABLE x")
    with pytest.raises(ValueError):
        serving.channel_leaderboard(built, sort="channel_name")


def test_unknown_channel(built):
    assert all(df.isEmpty() for df in serving.channel_detail(built, "nobody").values())
    assert serving.channel_vs_benchmark(built, "nobody").isEmpty()
    assert serving.channel_videos_table(built, "nobody").isEmpty()


def test_known_channel(built):
    detail = serving.channel_detail(built, "a")
    assert detail["metrics"].count() == 1
    assert [row.video_id for row in detail["videos"].collect()] == ["2", "1", "3"]
    assert one(detail["benchmark"]).niche == "tech"
    peers = detail["peers"].collect()
    assert [(row["rank"], row.channel_name, row.is_self) for row in peers][0] == (1, "A", True)
    ratios = {row.metric: row for row in serving.channel_vs_benchmark(built, "a").collect()}
    assert set(ratios) == {"Avg Views", "Engagement"}


def test_empty_page_summary(built):
    page = serving.video_explorer(built, niche="none")
    assert tuple(one(serving.video_page_summary(page))) == (0, 0.0, 0.0, 0)


def test_page_summary_counts_missing_rates(built):
    page = serving.video_explorer(built, niche="tech")
    row = one(serving.video_page_summary(page))
    assert (row.videos_shown, row.avg_views, row.avg_engagement) == (2, 200.0, 0.075)


def test_chart_with_unknown_sort(built):
    board = serving.channel_leaderboard(built)
    assert [r["value"] for r in serving.leaderboard_chart(board, "nonsense").collect()] == [200.0, 200.0, 0.0]


def test_pages_share_a_pass_and_agree(built):
    rollup, content = serving.channel_rollup(built), serving.content_rollup(built)
    overview, niches = serving.overview_page(built), serving.niche_page(built)
    same = lambda a, b: sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)
    assert same(overview["kpis"], serving.overview_kpis(rollup))
    assert same(overview["by_niche"], serving.overview_by_niche(rollup))
    assert same(overview["by_region"], serving.overview_by_region(rollup))
    assert same(overview["tiers"], serving.overview_tiers(built))
    assert same(niches["duration_analysis"], serving.duration_analysis(content))
    assert same(niches["upload_days"], serving.upload_day_analysis(content))
    assert one(overview["kpis"]).total_channels == 5


def test_marts_in_the_catalog(spark, small, built):
    again = marts.build(*small, CatalogStore(spark, "mart_build"), DAY)
    same = lambda m: sorted(map(tuple, m.agg_channel_metrics.collect()), key=repr)
    assert same(again) == same(built)
    assert spark.catalog.tableExists("mart_build_marts.fct_video_performance")


def test_empty_tables(spark):
    store = FolderStore(spark, fresh_folder(spark, "empty"))
    nothing = marts.build(channels(spark), videos(spark), store, DAY)
    assert nothing.fct_video_performance.isEmpty()
    kpis = one(serving.overview_kpis(serving.channel_rollup(nothing)))
    assert tuple(kpis) == (0, 0, None, None, None, None)


def test_scratch_is_removed_on_request(spark):
    path = fresh_folder(spark, "scratch")
    spark.range(1).write.parquet(path)
    assert path_exists(spark, path)
    discard(spark, path)
    assert not path_exists(spark, path)
    with pytest.raises(ValueError):
        discard(spark, "/somewhere/else")
