"""Daily sums against rescans, tables by day and their expiry, merged quantile sketches, borrowed view names."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from creatorlens import schemas
from creatorlens.operators import quantiles
from creatorlens.plans import daily, metrics, staging
from creatorlens.sources import manifest
from creatorlens.sources import tables as stores
from creatorlens.sources.day_table import DayTable
from creatorlens.sources.workspace import fresh_folder, listed_names


def raw_videos(spark, rows):
    """(video, channel, name, day, views) rows; the other columns follow from them."""
    full = [
        dict(video_id=v, channel_id=c, channel_name=n, upload_date=d, view_count=w, title=f"t {v}",
             like_count=None if w is None else w // 3, comment_count=1, duration_seconds=60,
             is_live=w == 7, was_live=False, niche="a", region="ID", scraped_at="2024-01-01T00:00:00+00:00")
        for v, c, n, d, w in rows
    ]
    return stores.coerce(spark.createDataFrame([[r.get(f) for f in schemas.RAW_VIDEOS.names] for r in full], schemas.RAW_VIDEOS), schemas.RAW_VIDEOS)


def raw_channels(spark, rows):
    return spark.createDataFrame([[r.get(f) for f in schemas.RAW_CHANNELS.names] for r in rows], schemas.RAW_CHANNELS)


def summary_rows(df):
    return sorted(
        (tuple(round(v, 9) if isinstance(v, float) else v for v in row) for row in df.select(*sorted(df.columns)).collect()),
        key=repr,
    )


@pytest.fixture(scope="module")
def videos(spark):
    draw = random.Random(5)
    rows = []
    for nth in range(300):
        day = None if nth % 29 == 0 else str(date(2024, 1, 1) + timedelta(days=draw.randrange(90)))
        views = None if nth % 31 == 0 else draw.choice([0, 7, 100, 12345])
        rows.append((f"v{nth}", draw.choice(["c1", "c1", "c1", "c2", None]), draw.choice(["one", None, " "]), day, views))
    return staging.stg_videos(raw_videos(spark, rows))


@pytest.fixture(scope="module")
def channels(spark):
    return staging.stg_channels(
        raw_channels(spark, [dict(channel_id="c1", channel_name="First", subscriber_count=50, scraped_at="2024-01-01T00:00:00+00:00")])
    )


def test_any_reporting_day_equals_the_rescan(spark, videos, channels):
    table = daily.DailySums(spark, fresh_folder(spark, "daily"), videos.schema)
    assert table.loads() == 0 and daily.channel_summary(table.read(), channels, date(2024, 2, 1)).count() == 0
    for load in range(1, 11):  # more than are merged at once
        part = videos.filter(F.pmod(F.xxhash64("video_id"), F.lit(10)) == load - 1)
        assert table.add(part, load)
        assert not table.add(part, load)  # given again
    assert len(table.table.version().parts) < 10
    sums = table.read()
    for as_of in (date(2023, 12, 1), date(2024, 2, 1), date(2024, 2, 29), date(2025, 1, 1)):
        expected = metrics.channel_summary(videos, channels, as_of)
        found = daily.channel_summary(sums, channels, as_of)
        assert found.schema.names == expected.schema.names
        assert summary_rows(found) == summary_rows(expected)


def test_a_load_that_fails_before_its_commit_adds_nothing(spark, videos, channels, monkeypatch):
    table = daily.DailySums(spark, fresh_folder(spark, "daily"), videos.schema)
    commit = table.table.commit
    monkeypatch.setattr(table.table, "commit", lambda change: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        table.add(videos, 1)
    assert table.read().count() == 0
    monkeypatch.setattr(table.table, "commit", commit)
    assert table.add(videos, 1)
    assert table.read().agg(F.sum("n")).first()[0] == videos.count()


def test_rolling_counts_against_a_loop(spark, videos):
    rows = [(r["channel_id"], r["upload_date"]) for r in videos.collect() if r["channel_id"] and r["upload_date"]]
    expected = sorted(
        (c, d, rows.count((c, d)), *[sum(x == c and 0 <= (d - y).days <= w for x, y in rows) for w in (10_000, 30, 7)])
        for c, d in set(rows)
    )
    found = daily.rolling_uploads(daily.daily_sums(videos))
    assert sorted(tuple(r) for r in found.collect()) == expected


SNAPSHOTS = [
    dict(channel_id=f"c{nth}", channel_name="n", scraped_at=stamp)
    for nth, stamp in enumerate(
        ["2024-03-01T00:00:00+00:00", "2024-02-29T23:59:59+00:00", "2024-03-01T01:00:00+02:00", "2024-04-29T12:00:00+00:00",
         "2024-04-30T00:00:00+00:00", None, "no time"]
    )
]


def test_days_expire_whole_and_only_their_folders_are_read(spark):
    table = DayTable(spark, fresh_folder(spark, "days"), schemas.RAW_CHANNELS)
    assert table.append(raw_channels(spark, [])) == 0 and table.read().count() == 0
    assert table.append(raw_channels(spark, SNAPSHOTS)) == 7
    assert table.append(raw_channels(spark, SNAPSHOTS[:1])) == 1
    as_of = date(2024, 4, 30)  # 60 days before: 1 March
    expected = ["c0", "c0", "c3", "c4"]
    timed = [s for s in SNAPSHOTS if s["scraped_at"] != "no time"]
    plain = stores.within_retention(raw_channels(spark, timed + SNAPSHOTS[:1]), as_of)
    kept = table.retained(as_of)
    assert sorted(r["channel_id"] for r in kept.collect()) == sorted(r["channel_id"] for r in plain.collect()) == expected
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(scraped_day" in plan
    under_way = table.read()  # planned before
    assert table.expire(as_of) == 2 and table.expire(as_of) == 0
    assert sorted(r["channel_id"] for r in table.read().collect()) == sorted([*expected, "c5", "c6"])
    assert under_way.count() == 8


def test_files_of_expired_days_go_with_their_versions(spark, monkeypatch):
    table = DayTable(spark, fresh_folder(spark, "days"), schemas.RAW_CHANNELS)
    table.append(raw_channels(spark, SNAPSHOTS))
    (write,) = [n for n in listed_names(spark, f"{table.table.root}/data")]
    with monkeypatch.context() as failing:  # nothing has changed if the commit fails
        failing.setattr(manifest, "create_file", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            table.expire(date(2024, 4, 30))
    assert table.read().count() == 7
    assert table.expire(date(2024, 4, 30), kept=1) == 2
    left = {n for n in listed_names(spark, f"{table.table.root}/data/{write}") if n.startswith("scraped_day")}
    assert left == {f"scraped_day={d}" for d in (0, 20240301, 20240429, 20240430)}


@pytest.mark.parametrize("size", [64, 256])
def test_merged_sketches_keep_their_rank_error(spark, size):
    draw = random.Random(size)
    rows = [(nth % 37, int(draw.paretovariate(0.4) * 100) if nth % 50 else None) for nth in range(20_000)]
    df = spark.createDataFrame(rows, "g int, m long")
    whole = quantiles.merged(quantiles.sketches(df, "m", "g", size=size), size=size)
    fractions = [0.01, 0.25, 0.5, 0.9, 0.999]
    found = whole.select(quantiles.sketched_rows().alias("n"), *[quantiles.quantile(q).alias(str(q)) for q in fractions]).first()
    values = [m for _, m in rows if m is not None]
    assert found["n"] == len(values)
    for q in fractions:
        low, high = sum(v < found[str(q)] for v in values), sum(v <= found[str(q)] for v in values)
        slack = 2 * quantiles.rank_error(size) * len(values)
        assert low - slack <= q * len(values) <= high + slack


def test_small_groups_are_exact_and_empty_ones_null(spark):
    df = spark.createDataFrame([("a", 1), ("a", 5), ("a", 9), ("a", 9), ("b", None)], "g string, m long")
    merged = quantiles.merged(quantiles.sketches(df, "m", "g"), "g")
    assert {r["g"]: r["q"] for r in merged.select("g", quantiles.quantile(0.5).alias("q")).collect()} == {"a": 5, "b": None}
    nothing = quantiles.merged(quantiles.sketches(df.limit(0), "m", "g"))
    assert [r["q"] for r in nothing.select(quantiles.quantile(0.5).alias("q")).collect()] == [None]


def test_a_query_gives_borrowed_names_back(spark):
    spark.range(3).createOrReplaceTempView("mine")
    other = spark.range(10)
    found = stores.query(spark, "SELECT count(*) AS n FROM mine JOIN theirs USING (id) WHERE id > :least", {"mine": other, "theirs": other}, least=4)
    assert found.first()["n"] == 5
    assert spark.table("mine").count() == 3 and not spark.catalog.tableExists("theirs")
    with pytest.raises(Exception, match="no_such_column"):
        stores.query(spark, "SELECT no_such_column FROM mine", {"mine": other})
    assert spark.table("mine").count() == 3
    spark.catalog.dropTempView("mine")
