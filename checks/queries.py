"""Every registered query: a function of (spark, table folder) returning a DataFrame.

Results are made comparable with SQL engines here, not in the library: doubles are
rounded, whole numbers widened to bigint, timestamps shown as text.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from creatorlens import schemas
from creatorlens.functions import fixed_values as fixed
from creatorlens.operators import quality, quantiles, reshape
from creatorlens.plans import daily, ingest, marts, metrics, reports, serving, staging
from creatorlens.plans.current import CurrentChannels
from creatorlens.sources import dumps, quarantine, registry
from creatorlens.sources import tables as stores
from creatorlens.sources.day_table import DayTable
from creatorlens.sources.id_index import IdIndex
from creatorlens.sources.workspace import fresh_folder, materialize, read_parquet
from creatorlens.streaming import discovery

from .fixture import AS_OF, CHANNEL, EARLIER, NICHES, SCRAPED_AT, Dataset, dataset, new_store

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def comparable(df: DataFrame) -> DataFrame:
    columns = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, DoubleType):
            column = F.round(column, 6)
        elif isinstance(field.dataType, IntegerType):
            column = column.cast("bigint")
        elif isinstance(field.dataType, TimestampType):
            utc = F.to_utc_timestamp(column, F.current_timezone())
            column = F.date_format(utc, "yyyy-MM-dd HH:mm:ss")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def _registered(function: Callable[[Dataset], DataFrame]) -> Callable[[Dataset], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(function(dataset(spark, sf_dir)))

    _QUERIES[function.__name__] = run
    return function


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


# models


@_registered
def stg_channels_latest(d: Dataset) -> DataFrame:
    return d.stg_channels


@_registered
def stg_videos_clean(d: Dataset) -> DataFrame:
    return d.stg_videos


@_registered
def video_metrics(d: Dataset) -> DataFrame:
    return d.video_metrics


@_registered
def channel_summary(d: Dataset) -> DataFrame:
    return d.channel_summary


@_registered
def niche_benchmarks(d: Dataset) -> DataFrame:
    return metrics.niche_benchmarks(d.channel_summary)


@_registered
def dim_channels(d: Dataset) -> DataFrame:
    return marts.dim_channels(d.stg_channels)


@_registered
def fct_video_performance(d: Dataset) -> DataFrame:
    return d.marts.fct_video_performance


@_registered
def agg_channel_metrics(d: Dataset) -> DataFrame:
    return d.marts.agg_channel_metrics


@_registered
def agg_niche_overview(d: Dataset) -> DataFrame:
    return d.marts.agg_niche_overview


# overview


@_registered
def overview_kpis(d: Dataset) -> DataFrame:
    return serving.overview_kpis(serving.channel_rollup(d.marts))


@_registered
def overview_cards(d: Dataset) -> DataFrame:
    return serving.overview_cards(serving.overview_kpis(serving.channel_rollup(d.marts)))


@_registered
def overview_by_niche(d: Dataset) -> DataFrame:
    return serving.overview_by_niche(serving.channel_rollup(d.marts))


@_registered
def overview_top_videos(d: Dataset) -> DataFrame:
    return serving.overview_top_videos(d.marts)


@_registered
def overview_top_videos_table(d: Dataset) -> DataFrame:
    return serving.top_videos_table(serving.overview_top_videos(d.marts))


@_registered
def overview_by_region(d: Dataset) -> DataFrame:
    return serving.overview_by_region(serving.channel_rollup(d.marts))


@_registered
def overview_tiers(d: Dataset) -> DataFrame:
    return serving.overview_tiers(d.marts)


@_registered
def sql_tier_query(d: Dataset) -> DataFrame:
    """SQL text with bound parameters over the marts."""
    text = """
        SELECT f.performance_tier, count(*) AS videos, sum(f.view_count) AS total_views
        FROM fct_video_performance f JOIN dim_channels d ON f.channel_id = d.channel_id
        WHERE f.niche = :niche AND f.region = :region
        GROUP BY f.performance_tier
    """
    named = {
        "fct_video_performance": d.marts.fct_video_performance,
        "dim_channels": d.marts.dim_channels,
    }
    return stores.query(d.spark, text, named, niche="building", region="GLOBAL")


@_registered
def sql_over_views(d: Dataset) -> DataFrame:
    """SQL text over the staging and intermediate models published as views."""
    text = """
        SELECT c.size_tier, b.niche, count(*) AS videos, max(m.views_per_day) AS best_per_day,
               min(s.total_views) AS least_total_views
        FROM int_video_metrics m
        JOIN stg_channels c ON m.channel_id = c.channel_id
        JOIN int_channel_summary s ON s.channel_id = m.channel_id AND s.niche = m.niche
        JOIN int_niche_benchmarks b ON b.niche = m.niche
        WHERE m.view_count > b.avg_views_per_video
        GROUP BY c.size_tier, b.niche
    """
    views = marts.layer_views(d.raw_channels, d.raw_videos, AS_OF)
    return stores.query(d.spark, text, views)


# channels


@_registered
def channel_leaderboard(d: Dataset) -> DataFrame:
    return serving.channel_leaderboard(d.marts)


@_registered
def channel_leaderboard_filtered(d: Dataset) -> DataFrame:
    return serving.channel_leaderboard(
        d.marts, niche="furniture", region="GLOBAL", sort="avg_views", limit=fixed.PAGE_LIMIT
    )


@_registered
def leaderboard_top15(d: Dataset) -> DataFrame:
    page = serving.channel_leaderboard(d.marts, sort="total_views", limit=fixed.PAGE_LIMIT)
    return serving.leaderboard_chart(page, "total_views")


@_registered
def leaderboard_table(d: Dataset) -> DataFrame:
    page = serving.channel_leaderboard(d.marts, sort="avg_engagement_rate", limit=fixed.PAGE_LIMIT)
    return serving.leaderboard_table(page, "avg_engagement_rate")


@_registered
def channel_info(d: Dataset) -> DataFrame:
    return serving.channel_info(d.marts, CHANNEL)


@_registered
def channel_metrics(d: Dataset) -> DataFrame:
    return serving.channel_metrics(d.marts, CHANNEL)


@_registered
def channel_videos(d: Dataset) -> DataFrame:
    return serving.channel_videos(d.marts, CHANNEL)


@_registered
def channel_videos_table(d: Dataset) -> DataFrame:
    return serving.channel_videos_table(d.marts, CHANNEL)


@_registered
def channel_benchmark(d: Dataset) -> DataFrame:
    return serving.channel_benchmark(d.marts, CHANNEL)


@_registered
def channel_peers(d: Dataset) -> DataFrame:
    return serving.channel_peers(d.marts, CHANNEL)


@_registered
def channel_peers_table(d: Dataset) -> DataFrame:
    return serving.channel_peers_table(serving.channel_peers(d.marts, CHANNEL))


@_registered
def channel_cards(d: Dataset) -> DataFrame:
    return serving.channel_cards(d.marts, CHANNEL)


@_registered
def channel_vs_benchmark(d: Dataset) -> DataFrame:
    return serving.channel_vs_benchmark(d.marts, CHANNEL)


@_registered
def channel_tier_distribution(d: Dataset) -> DataFrame:
    return serving.channel_tier_distribution(d.marts, CHANNEL)


@_registered
def channel_duration_distribution(d: Dataset) -> DataFrame:
    return serving.channel_duration_distribution(d.marts, CHANNEL)


# videos


@_registered
def video_explorer(d: Dataset) -> DataFrame:
    return serving.video_explorer(d.marts)


@_registered
def video_explorer_live(d: Dataset) -> DataFrame:
    return serving.video_explorer(
        d.marts, niche="machinery", kind="live", sort="views_per_day", limit=fixed.PAGE_LIMIT
    )


@_registered
def video_explorer_regular(d: Dataset) -> DataFrame:
    return serving.video_explorer(
        d.marts, region="ID", kind="regular", sort="upload_date", limit=fixed.PAGE_LIMIT
    )


@_registered
def video_explorer_by_tier(d: Dataset) -> DataFrame:
    return serving.video_explorer(
        d.marts, tier="above_average", sort="engagement_rate", limit=fixed.PAGE_LIMIT
    )


@_registered
def video_page_summary(d: Dataset) -> DataFrame:
    page = serving.video_explorer(d.marts, kind="any", sort="like_count", limit=fixed.PAGE_LIMIT)
    return serving.video_page_summary(page)


@_registered
def video_page_summary_text(d: Dataset) -> DataFrame:
    page = serving.video_explorer(d.marts, niche="building", limit=fixed.PAGE_LIMIT)
    return serving.video_page_summary_text(serving.video_page_summary(page))


@_registered
def display_video_table(d: Dataset) -> DataFrame:
    page = serving.video_explorer(d.marts, sort="views_per_day", limit=fixed.PAGE_LIMIT)
    return serving.video_table(page, "views_per_day")


@_registered
def video_ranking(d: Dataset) -> DataFrame:
    """Every video with its place by views, numbered without one big window."""
    from creatorlens.operators.ranking import ranked

    fact = d.marts.fct_video_performance.select("video_id", "view_count")
    return ranked(fact, [F.desc_nulls_last("view_count"), F.asc("video_id")])


# niches


@_registered
def niche_overview(d: Dataset) -> DataFrame:
    return serving.niche_overview(d.marts)


@_registered
def niche_region(d: Dataset) -> DataFrame:
    return serving.niche_region(serving.channel_rollup(d.marts))


@_registered
def niche_region_table(d: Dataset) -> DataFrame:
    return serving.niche_region_table(serving.niche_region(serving.channel_rollup(d.marts)))


@_registered
def duration_analysis(d: Dataset) -> DataFrame:
    return serving.duration_analysis(serving.content_rollup(d.marts))


@_registered
def upload_day_analysis(d: Dataset) -> DataFrame:
    return serving.upload_day_analysis(serving.content_rollup(d.marts))


@_registered
def niche_radar(d: Dataset) -> DataFrame:
    return reshape.niche_radar(serving.niche_overview(d.marts), NICHES)


@_registered
def duration_pivot(d: Dataset) -> DataFrame:
    return reshape.duration_pivot(serving.duration_analysis(serving.content_rollup(d.marts)), NICHES)


@_registered
def upload_day_pivot(d: Dataset) -> DataFrame:
    return reshape.upload_day_pivot(serving.upload_day_analysis(serving.content_rollup(d.marts)), NICHES)


@_registered
def id_vs_global(d: Dataset) -> DataFrame:
    return reshape.id_vs_global(serving.niche_region(serving.channel_rollup(d.marts)))


@_registered
def niche_cards(d: Dataset) -> DataFrame:
    return reshape.niche_cards(serving.niche_overview(d.marts))


# dumps and registry


@_registered
def listing_parse(d: Dataset) -> DataFrame:
    return dumps.parse_listing_drops(d.listing_lines)


@_registered
def video_dump_parse(d: Dataset) -> DataFrame:
    return d.parsed_videos


@_registered
def video_lines_sorted_out(d: Dataset) -> DataFrame:
    """Each video line with its fate, and the counts of the run beside it; some lines are spoilt here."""
    number = F.expr("cast(substring(requested_id, 2) as bigint)")
    no_day = F.regexp_replace("value", r'"upload_date":"\d{8}"', '"upload_date":"20231345"')
    spoilt = (
        F.when(number % 47 == 0, " ").when(number % 43 == 0, "[1]").when(number % 41 == 0, no_day).otherwise(F.col("value"))
    )
    done = quarantine.sort_videos(d.video_lines.withColumn("value", spoilt), SCRAPED_AT)
    fates = done.rows.select("video_id", F.lit(quarantine.PARSED).alias("fate")).unionByName(
        done.set_aside.select(F.col("requested_id").alias("video_id"), F.col("reason").alias("fate"))
    )
    counts = F.create_map(*[F.lit(x) for pair in done.counts.items() for x in pair])
    return fates.withColumn("lines_of_fate", F.element_at(counts, F.col("fate")).cast("long"))


@_registered
def channel_dump_merge(d: Dataset) -> DataFrame:
    return d.parsed_channels


@_registered
def channel_probe_urls(d: Dataset) -> DataFrame:
    return dumps.channel_probe_urls(d.channel_lines[0])


@_registered
def raw_channel_rows(d: Dataset) -> DataFrame:
    return ingest.raw_channels(d.registry, d.parsed_channels)


@_registered
def staged_channel_rows(d: Dataset) -> DataFrame:
    """Staging of what the dumps give; rows with an empty id are one channel and left out here."""
    rows = staging.stg_channels(ingest.raw_channels(d.registry, d.parsed_channels))
    return rows.filter("channel_id <> ''").select(
        "channel_id", "channel_name", "config_name", "niche", "region"
    )


@_registered
def registry_flatten(d: Dataset) -> DataFrame:
    return registry.flatten(d.registry_documents)


@_registered
def registry_one_niche(d: Dataset) -> DataFrame:
    return registry.only_niche(d.registry, "household")


def _resolved(d: Dataset) -> DataFrame:
    observed = dumps.observed_channels(d.observed_lines)
    return registry.resolve(d.registry, observed, dumps.first_hits(d.search_lines))


@_registered
def registry_resolution(d: Dataset) -> DataFrame:
    return _resolved(d)


@_registered
def registry_status_counts(d: Dataset) -> DataFrame:
    return registry.status_counts(_resolved(d))


# ingest runs


@_registered
def listed_videos(d: Dataset) -> DataFrame:
    return ingest.listed_videos(d.listing).select("config_url", "tab", "video_id")


@_registered
def listing_requests(d: Dataset) -> DataFrame:
    return ingest.listing_requests(d.registry)


@_registered
def video_requests(d: Dataset) -> DataFrame:
    return ingest.video_requests(d.listing)


@_registered
def incremental_new_videos(d: Dataset) -> DataFrame:
    rows = ingest.raw_videos(d.claimed, d.registry, d.parsed)
    return rows.select("video_id", "title", "channel_id", "view_count", "niche", "region")


@_registered
def incremental_claims_chain(d: Dataset) -> DataFrame:
    """Three new videos per entry where every entry's choice depends on the one before."""
    listed = materialize(ingest.listed_videos(d.chained_listing), "chained")
    nothing = d.loaded.limit(0)
    # of the parsed videos only the ids are read, once: no table of all their fields is written for it
    return ingest.claims(listed, nothing, d.registry, d.parsed_videos, 3).select("entry", "video_id", "has_video")


@_registered
def incremental_report(d: Dataset) -> DataFrame:
    return ingest.incremental_outcomes(
        d.registry, d.parsed_channels, d.listed, d.loaded, d.claimed
    )


@_registered
def run_report(d: Dataset) -> DataFrame:
    listed = materialize(ingest.listed_videos(d.listing, fixed.MAX_VIDEOS), "listed")
    return ingest.run_report(
        ingest.full_outcomes(d.registry, d.parsed_channels, listed, d.parsed)
    )


@_registered
def failed_channels(d: Dataset) -> DataFrame:
    return ingest.failed_channels(d.registry, d.parsed_channels).select("url", "name", "niche")


@_registered
def full_reload(d: Dataset) -> DataFrame:
    """A full run written to a store and read back."""
    store = new_store(d.spark, "full")
    ingest.load_full(
        store,
        ingest.raw_channels(d.registry, d.parsed_channels),
        ingest.full_videos(d.listing, d.registry, d.parsed),
    )
    rows = store.read("raw_videos", schemas.RAW_VIDEOS)
    return rows.select("video_id", "channel_id", "upload_date", "view_count", "niche", "region")


@_registered
def incremental_reload(d: Dataset) -> DataFrame:
    """Two incremental runs on top of what was loaded; the second adds no video twice."""
    store = new_store(d.spark, "incremental")
    stores.load(d.loaded_rows, store, "raw_videos")
    for _ in range(2):
        ingest.load_incremental(store, d.registry, d.listing, d.parsed_channels, d.parsed)
    videos = store.read("raw_videos", schemas.RAW_VIDEOS)
    channels = store.read("raw_channels", schemas.RAW_CHANNELS)
    snapshots = channels.groupBy("channel_id").agg(F.count(F.lit(1)).alias("snapshots"))
    copies = videos.groupBy("channel_id").agg(
        F.count(F.lit(1)).alias("videos"), F.count_distinct("video_id").alias("distinct_videos")
    )
    both = copies.join(snapshots, "channel_id", "full")
    return both.fillna(0, ["videos", "distinct_videos", "snapshots"])


@_registered
def incremental_stream(d: Dataset) -> DataFrame:
    """Listing drops as a stream: two drops, then a run without a new file."""
    root = fresh_folder(d.spark, "stream")
    drops, sink, checkpoint = f"{root}/drops", f"{root}/sink", f"{root}/checkpoint"
    lines = d.listing_lines
    is_stream = F.get_json_object("value", "$.tab") == "streams"
    for part in (lines.filter(~is_stream), lines.filter(is_stream), None):
        if part is not None:
            part.write.mode("append").text(drops)
        discovery.discover(d.spark, drops, sink, checkpoint).awaitTermination()
    return discovery.read_sink(d.spark, sink).select("video_id", "tab")


@_registered
def stream_sink_merged(d: Dataset) -> DataFrame:
    """The same drops in eight batches, one of them repeated, into a sink that merges early."""
    sink = fresh_folder(d.spark, "merged-sink")
    listing = d.listing.select(*discovery.SINK_SCHEMA.names)
    slices = [listing.filter(F.col("tab") == t).filter(F.pmod(F.xxhash64("config_url"), F.lit(4)) == n) for t in fixed.TAB_ORDER for n in range(4)]
    for nth, part in enumerate(slices):
        for _ in range(2 if nth == 5 else 1):
            discovery.store_batch(part, nth, sink, "s", fan=3)
    return discovery.read_sink(d.spark, sink).select("video_id", "tab")


@_registered
def loaded_id_index(d: Dataset) -> DataFrame:
    """Which listed videos were loaded before, asked of an index made in three loads."""
    index = IdIndex(d.spark, fresh_folder(d.spark, "index"), "video_id", buckets=8)
    for nth in range(3):
        index.add(d.loaded.filter(F.pmod(F.xxhash64("video_id"), F.lit(3)) >= nth), 1)
    return index.known(d.listed)


@_registered
def incremental_reload_indexed(d: Dataset) -> DataFrame:
    """Two incremental runs as above with an index of loaded ids and a table of newest snapshots."""
    store = new_store(d.spark, "indexed")
    index = IdIndex(d.spark, fresh_folder(d.spark, "index"), "video_id", buckets=8)
    current = CurrentChannels(d.spark, fresh_folder(d.spark, "current"), buckets=8)
    stores.load(d.loaded_rows, store, "raw_videos")
    for _ in range(2):
        ingest.load_incremental(
            store, d.registry, d.listing, d.parsed_channels, d.parsed, index=index, current=current
        )
    videos = store.read("raw_videos", schemas.RAW_VIDEOS)
    newest = current.read().groupBy("channel_id").agg(F.count(F.lit(1)).alias("newest"))
    copies = videos.groupBy("channel_id").agg(
        F.count(F.lit(1)).alias("videos"), F.count_distinct("video_id").alias("distinct_videos")
    )
    return copies.join(newest, "channel_id", "full").fillna(0, ["videos", "distinct_videos", "newest"])


@_registered
def channels_current_merged(d: Dataset) -> DataFrame:
    """The staging model from a table of newest snapshots: loaded newest first, one load twice."""
    current = CurrentChannels(d.spark, fresh_folder(d.spark, "current"), buckets=8)
    times = [r["scraped_at"] for r in d.raw_channels.select("scraped_at").distinct().collect()]  # of a few runs
    for time in sorted(times, key=str, reverse=True) + times[:1]:
        current.merge(d.raw_channels.filter(F.col("scraped_at").eqNullSafe(F.lit(time))))
    return staging.stg_channels(current.read())


@_registered
def channel_summary_daily(d: Dataset) -> DataFrame:
    """The summary from daily sums that were added in three loads, one of them given twice."""
    return daily.channel_summary(d.daily_sums, d.written_channels, AS_OF)


@_registered
def channel_summary_daily_earlier(d: Dataset) -> DataFrame:
    """The same sums, another reporting day: no video is read for it."""
    return daily.channel_summary(d.daily_sums, d.written_channels, EARLIER)


@_registered
def channel_rolling_uploads(d: Dataset) -> DataFrame:
    return daily.rolling_uploads(d.daily_sums)


@_registered
def niche_medians_merged(d: Dataset) -> DataFrame:
    """Median subscribers of niches, from sketches per niche, region and tier."""
    parts = quantiles.sketches(d.marts.agg_channel_metrics, "subscriber_count", "niche", "region", "size_tier")
    return quantiles.merged(parts, "niche").select(
        "niche", quantiles.sketched_rows().alias("channels"), quantiles.quantile(0.5).alias("median_subscribers")
    )


@_registered
def view_quantiles_bounded(d: Dataset) -> DataFrame:
    """Quartiles of views per niche from sketches of 256, and whether their ranks are as near as stated.

    Near: within twice the error of 99 in 100 cases.
    """
    size, views = 256, F.col("view_count")
    fact = d.marts.fct_video_performance
    parts = quantiles.sketches(fact, "view_count", "niche", "region", "duration_category", size=size)
    quartiles = F.array(*[F.struct(F.lit(q).alias("fraction"), quantiles.quantile(q).alias("value")) for q in (0.25, 0.5, 0.75)])
    merged = quantiles.merged(parts, "niche", size=size)
    found = merged.select("niche", quantiles.sketched_rows().alias("videos"), F.inline(quartiles))
    ranked = fact.select("niche", "view_count").join(F.broadcast(found), "niche")  # three rows per niche
    rank, slack = F.col("fraction") * F.col("videos"), 2 * quantiles.rank_error(size) * F.col("videos")
    below, up_to = F.count_if(views < F.col("value")), F.count_if(views <= F.col("value"))
    return ranked.groupBy("niche", "fraction", "videos").agg(((below <= rank + slack) & (up_to >= rank - slack)).alias("near"))


# stores


@_registered
def sink_append_overwrite(d: Dataset) -> DataFrame:
    """Rows reported and rows stored after each kind of write."""
    store = new_store(d.spark, "sinks")
    rows, schema = d.raw_channels, schemas.RAW_CHANNELS

    def step(name: str, df: DataFrame, mode: str) -> tuple[str, int, int]:
        written = stores.load(df, store, "raw_channels", mode)
        return name, written, store.read("raw_channels", schema).count()

    steps = [
        step("create", d.current_channels, stores.CREATE),
        step("append", rows, stores.APPEND),
        step("append_nothing", rows.limit(0), stores.APPEND),
        step("overwrite_nothing", rows.limit(0), stores.OVERWRITE),
        step("overwrite", rows, stores.OVERWRITE),
    ]
    result = StructType(
        [
            StructField("step", StringType()),
            StructField("rows_written", LongType()),
            StructField("rows_stored", LongType()),
        ]
    )
    return d.spark.createDataFrame(steps, result)


@_registered
def sink_typed_table(d: Dataset) -> DataFrame:
    """Videos through a typed table with a required key, written and read back."""
    path = fresh_folder(d.spark, "typed")
    rows = d.raw_videos.withColumn("views", F.col("view_count"))
    stores.required(rows, schemas.PROBE_TABLE).write.parquet(path)
    return read_parquet(d.spark, path, schemas.PROBE_TABLE)


@_registered
def catalog_table_steps(d: Dataset) -> DataFrame:
    """A catalog namespace and table: absent, created, refused, appended to, replaced, dropped."""
    prefix = f"steps_{d.spark.sparkContext.applicationId.replace('-', '_')}"
    store = stores.CatalogStore(d.spark, prefix)
    table = store.locate("raw_channels")
    d.spark.sql(f"DROP TABLE IF EXISTS {table}") if store.exists("raw_channels") else None
    steps: list[tuple[str, bool, int]] = []

    def step(name: str, done: bool = True) -> None:
        there = store.exists("raw_channels")
        steps.append((name, done, d.spark.table(table).count() if there else -1))

    step("absent", not store.exists("raw_channels"))
    stores.load(d.current_channels, store, "raw_channels", stores.CREATE)
    step("created")
    try:
        stores.load(d.current_channels, store, "raw_channels", stores.CREATE)
        step("refused", False)
    except ValueError:
        step("refused")
    stores.load(d.raw_channels, store, "raw_channels", stores.APPEND)
    step("appended")
    stores.load(d.raw_channels, store, "raw_channels", stores.OVERWRITE)
    step("replaced")
    namespace = table.split(".")[0]
    step("namespace", d.spark.catalog.databaseExists(namespace))
    d.spark.sql(f"DROP DATABASE {namespace} CASCADE")
    step("dropped", not d.spark.catalog.databaseExists(namespace))
    return d.spark.createDataFrame(steps, "step string, done boolean, rows_stored long")


@_registered
def catalog_version_steps(d: Dataset) -> DataFrame:
    """A table of versions behind a view: rows after each step, a failed replacement among them."""
    prefix = f"versions_{d.spark.sparkContext.applicationId.replace('-', '_')}"
    store = stores.VersionedCatalogStore(d.spark, prefix)
    store.drop("raw_channels") if store.exists("raw_channels") else None
    steps: list[tuple[str, int]] = []

    def step(name: str, df: DataFrame | None = None) -> None:
        steps.append((name, (df or store.read("raw_channels")).count()))

    stores.load(d.current_channels, store, "raw_channels", stores.CREATE)
    step("created")
    stores.load(d.raw_channels, store, "raw_channels", stores.APPEND)
    step("appended")
    before = store.read("raw_channels")
    try:
        store.publish(f"{store.locate('raw_channels')}_lost", "raw_channels")
    except AnalysisException:
        step("replacement failed")
    stores.load(d.raw_channels, store, "raw_channels", stores.OVERWRITE)
    step("replaced")
    step("planned before", before)
    for _ in range(2):
        stores.save(d.current_channels, store, "raw_channels")
    step("saved twice")
    steps.append(("versions", len(store.versions("raw_channels"))))
    d.spark.sql(f"DROP DATABASE {store.locate('raw_channels').split('.')[0]} CASCADE")
    return d.spark.createDataFrame(steps, "step string, rows_stored long")


@_registered
def channel_rows_stamped_now(d: Dataset) -> DataFrame:
    """Channel rows of a run that takes its own time: ISO text in UTC, the same on every row."""
    rows = dumps.parse_channels(*d.channel_lines, dumps.utc_now())
    stamp = F.col("scraped_at")
    iso = stamp.rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{6}\+00:00$")
    return rows.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(iso).alias("iso_rows"),
        F.count_distinct("scraped_at").alias("times"),
        F.count_if(stamp.cast("timestamp") > F.current_timestamp() - F.expr("INTERVAL 1 DAY")).alias("recent_rows"),
    )


@_registered
def page_bundle_rows(d: Dataset) -> DataFrame:
    """Rows of every part of the overview, niche and channel pages."""
    pages = {
        "overview": serving.overview_page(d.marts),
        "niche": serving.niche_page(d.marts),
        "channel": serving.channel_detail(d.marts, CHANNEL),
    }
    return ingest.table_counts({f"{page}.{part}": df for page, parts in pages.items() for part, df in parts.items()})


@_registered
def batch_union(d: Dataset) -> DataFrame:
    """Batches with different columns in one table, counted per table."""
    narrow = d.current_channels.drop("description", "subscriber_count")
    both = ingest.union_batches([d.raw_channels, narrow])
    described = both.filter(F.col("description").isNotNull())
    return ingest.table_counts({"all": both, "described": described, "videos": d.raw_videos})


@_registered
def retention_60d(d: Dataset) -> DataFrame:
    from datetime import timedelta

    kept = stores.within_retention(d.raw_channels, AS_OF + timedelta(days=45))
    return kept.select("channel_id", "scraped_at", "subscriber_count")


@_registered
def retention_day_table(d: Dataset) -> DataFrame:
    """The same rows from a table by day: what is retained before expiry, and all there is after it."""
    from datetime import timedelta

    as_of = AS_OF + timedelta(days=45)
    table = DayTable(d.spark, fresh_folder(d.spark, "by-day"), schemas.RAW_CHANNELS)
    for nth in range(2):
        table.append(d.raw_channels.filter(F.pmod(F.xxhash64("channel_id"), F.lit(2)) == nth))
    before = table.retained(as_of)
    table.expire(as_of)
    columns = ("channel_id", "scraped_at", "subscriber_count")
    found = {"retained": before, "left": table.read()}
    return reduce(DataFrame.unionByName, [df.select(F.lit(name).alias("rows"), *columns) for name, df in found.items()])


# data tests


@_registered
def dq_staging(d: Dataset) -> DataFrame:
    return quality.staging_tests(d.stg_channels, d.stg_videos, NICHES)


@_registered
def dq_fk(d: Dataset) -> DataFrame:
    m = d.marts
    return quality.foreign_key(
        m.fct_video_performance, "fct_video_performance", "channel_id", m.dim_channels
    )


# reports


@_registered
def report_niche_activity(d: Dataset) -> DataFrame:
    return reports.niche_activity(d.marts)


@_registered
def report_size_mix(d: Dataset) -> DataFrame:
    return reports.size_mix(d.marts)


@_registered
def report_subscriber_view_map(d: Dataset) -> DataFrame:
    return reports.subscriber_view_map(d.marts)


@_registered
def report_efficiency_top(d: Dataset) -> DataFrame:
    return reports.most_efficient(d.marts)


@_registered
def report_underperformers(d: Dataset) -> DataFrame:
    return reports.large_underperformers(d.marts)


@_registered
def report_content_strategy(d: Dataset) -> DataFrame:
    return reports.content_strategy(d.marts)


@_registered
def report_activity(d: Dataset) -> DataFrame:
    return reports.upload_activity(d.marts)


@_registered
def report_coverage_cube(d: Dataset) -> DataFrame:
    return reports.coverage(d.marts)
