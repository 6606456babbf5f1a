"""The given tables seen as channels, videos, listings and dumps.

Customers play channels and orders play videos. Everything is row-wise or an
aggregate, so the work grows with the tables. Raw tables and marts are written
once per application and table folder, as a load and a model build would.
"""

from __future__ import annotations

import threading
from dataclasses import dataclass
from datetime import date
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creatorlens.functions.scalars import first_filled
from creatorlens.operators.joins import lookup_join
from creatorlens.plans import daily, ingest, marts, metrics, staging
from creatorlens.sources import dumps
from creatorlens.sources.tables import FolderStore, save
from creatorlens.sources.workspace import fresh_folder, materialize

AS_OF = date(2001, 8, 2)
#: A reporting day in the middle of the uploads.
EARLIER = date(1996, 3, 5)
NICHES = ("automobile", "building", "furniture", "household", "machinery")
CHANNEL = "UC7"
MIX_URL = "https://example.com/channel/UCMIX"
CHAINED = 200
LAST_POSITION = 10**15
SCRAPED_AT = "2001-08-01T00:00:00+00:00"
LOADED_BEFORE = "2001-01-01"


def _text(number: str | Column) -> Column:
    return (F.col(number) if isinstance(number, str) else number).cast("string")


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def configured(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = _read(spark, sf_dir, "nation"), _read(spark, sf_dir, "region")
    places = nation.join(region, nation.n_regionkey == region.r_regionkey)
    customer = _read(spark, sf_dir, "customer")
    return customer.join(places, customer.c_nationkey == places.n_nationkey).select(
        "c_custkey",
        "c_name",
        "c_acctbal",
        F.lower("c_mktsegment").alias("niche"),
        F.when(F.col("r_name") == "ASIA", "ID").otherwise("GLOBAL").alias("region"),
    )


def make_raw_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    snapshots = configured(spark, sf_dir).withColumn("snap", F.explode(F.array(F.lit(0), F.lit(1))))
    subscribers = F.floor(F.col("c_acctbal") * 2000).cast("bigint") + F.col("snap") * 1000
    return snapshots.select(
        F.concat(F.lit("UC"), _text(key)).alias("channel_id"),
        F.when(key % 11 != 0, F.col("c_name")).alias("channel_name"),
        F.concat(F.lit("https://example.com/channel/UC"), _text(key)).alias("channel_url"),
        F.when(F.col("c_acctbal") >= 0, subscribers).alias("subscriber_count"),
        F.concat(F.lit("About "), F.col("c_name")).alias("description"),
        F.when(F.col("snap") == 0, "2001-07-01T00:00:00+00:00")
        .otherwise(SCRAPED_AT)
        .alias("scraped_at"),
        "niche",
        "region",
        F.when(key % 121 == 0, "")
        .otherwise(F.concat(F.lit("cfg-"), F.col("c_name")))
        .alias("config_name"),
    )


def make_raw_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    lines = (
        _read(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.sum("l_quantity").cast("bigint").alias("q"), F.count(F.lit(1)).alias("n"))
    )
    owners = configured(spark, sf_dir).select(
        F.col("c_custkey").alias("o_custkey"), "c_name", "niche", "region"
    )
    # dealt by key: files of the given table may be few, and what is made of a row is much wider
    orders = _read(spark, sf_dir, "orders").repartition("o_orderkey").join(lines, "o_orderkey", "left")
    level = F.floor(F.col("o_totalprice") / 5000).cast("bigint")
    title = F.concat(
        F.col("o_orderpriority"), F.lit("  "), F.col("o_orderstatus"), F.lit(" "), F.col("c_name")
    )
    return lookup_join(orders, owners, "o_custkey", how="inner").select(
        F.concat(F.lit("v"), _text(key)).alias("video_id"),
        F.when(key % 97 == 0, "").when(key % 89 != 0, title).alias("title"),
        F.concat(F.lit("Description of "), _text(key)).alias("description"),
        F.when(F.col("o_custkey") % 121 == 0, "")
        .otherwise(F.col("c_name"))
        .alias("channel_name"),
        F.concat(F.lit("UC"), _text("o_custkey")).alias("channel_id"),
        F.concat(F.lit("https://example.com/channel/UC"), _text("o_custkey")).alias("channel_url"),
        F.when(key % 83 != 0, _text(F.col("o_orderdate").cast("date"))).alias("upload_date"),
        F.when(key % 50 != 0, (key * 37) % 7200).alias("duration_seconds"),
        (level * level * level).alias("view_count"),
        F.col("q").alias("like_count"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("comment_count"),
        F.concat(
            F.lit('["'), F.lower("o_orderstatus"), F.lit('","'), F.lower("o_orderpriority"),
            F.lit('"]'),
        ).alias("tags"),
        F.concat(F.lit('["'), F.col("niche"), F.lit('"]')).alias("categories"),
        F.concat(F.lit("https://example.com/t/"), _text(key), F.lit(".jpg")).alias("thumbnail_url"),
        F.when(key % 3 != 0, F.when(F.col("region") == "ID", "id").otherwise("en")).alias(
            "language"
        ),
        (F.col("o_orderpriority") == "1-URGENT").alias("is_live"),
        (F.col("o_orderstatus") == "F").alias("was_live"),
        F.lit(SCRAPED_AT).alias("scraped_at"),
        "niche",
        "region",
    )


@dataclass
class Dataset:
    """Raw tables, staging, metrics and marts of one table folder, written on first use."""

    spark: SparkSession
    sf_dir: str

    @cached_property
    def store(self) -> FolderStore:
        return FolderStore(self.spark, fresh_folder(self.spark, "tables"))

    @cached_property
    def raw_channels(self) -> DataFrame:
        return save(make_raw_channels(self.spark, self.sf_dir), self.store, "raw_channels")

    @cached_property
    def raw_videos(self) -> DataFrame:
        return save(make_raw_videos(self.spark, self.sf_dir), self.store, "raw_videos")

    @cached_property
    def marts(self) -> marts.Marts:
        return marts.build(self.raw_channels, self.raw_videos, self.store, AS_OF)

    @property
    def stg_channels(self) -> DataFrame:
        return staging.stg_channels(self.raw_channels)

    @property
    def stg_videos(self) -> DataFrame:
        return staging.stg_videos(self.raw_videos)

    @property
    def written_channels(self) -> DataFrame:
        """Staging channels as the model build wrote them."""
        _ = self.marts
        return self.store.read("stg_channels", self.stg_channels.schema)

    @property
    def video_metrics(self) -> DataFrame:
        return metrics.video_metrics(self.stg_videos, self.written_channels, AS_OF)

    @cached_property
    def daily_sums(self) -> DataFrame:
        table = daily.DailySums(self.spark, fresh_folder(self.spark, "daily"), self.stg_videos.schema)
        for load in (1, 2, 2, 3):
            table.add(self.stg_videos.filter(F.pmod(F.xxhash64("video_id"), F.lit(3)) == load - 1), load)
        return table.read()

    @property
    def channel_summary(self) -> DataFrame:
        return metrics.channel_summary(self.stg_videos, self.written_channels, AS_OF)

    # what an ingest run finds

    @property
    def current_channels(self) -> DataFrame:
        return self.raw_channels.filter(F.col("scraped_at") == SCRAPED_AT)

    @property
    def registry(self) -> DataFrame:
        """One entry per channel in key order, after one that relists streams of all others.

        The last entry has the URL of the first again, with another niche.
        """
        number = F.expr("cast(substring(channel_id, 3) as bigint)")
        own = self.current_channels.select(
            first_filled(F.col("config_name"), F.col("channel_id")).alias("name"),
            F.col("channel_url").alias("url"),
            "channel_id",
            "niche",
            "region",
            (number + 1).alias("position"),
        )
        mix = self.spark.createDataFrame(
            [
                ("mix", MIX_URL, "UCMIX", "household", "GLOBAL", 0),
                ("mix-again", MIX_URL, "UCMIX", "machinery", "ID", LAST_POSITION),
            ],
            own.schema,
        )
        return own.unionByName(mix)

    @property
    def listing(self) -> DataFrame:
        """Newest first in each tab; live streams may stand in both tabs; one hot channel."""
        age = F.datediff(
            F.lit(date(2100, 1, 1)), F.coalesce(F.col("upload_date"), F.lit("1900-01-01")).cast("date")
        ).cast("bigint")
        number = F.expr("cast(substring(video_id, 2) as bigint)")
        live = F.col("was_live")
        own_tab = F.when(live, "streams").otherwise("videos")

        def entry(condition: Column, url: Column, tab: Column) -> Column:
            return F.when(condition, F.struct(url.alias("config_url"), tab.alias("tab")))

        entries = F.array_compact(
            F.array(
                entry(F.lit(True), F.col("channel_url"), own_tab),
                entry(live & F.col("is_live"), F.col("channel_url"), F.lit("videos")),
                entry(live, F.lit(MIX_URL), F.lit("streams")),
            )
        )
        return self.raw_videos.select(
            "video_id",
            (age * 1_000_000_000_000 + number).alias("position"),
            F.inline(entries),
        ).select("config_url", "tab", "position", "video_id")

    @property
    def chained_listing(self) -> DataFrame:
        """Every channel also lists the next one's videos, in chains of up to ``CHAINED`` channels.

        In such a chain what an entry takes decides what the next one has left.
        """
        number = F.expr("cast(substring(channel_id, 3) as bigint)")
        before = F.concat(F.lit("https://example.com/channel/UC"), (number - 1).cast("string"))
        urls = F.array_compact(F.array("channel_url", F.when(number % CHAINED != 0, before)))
        return self.raw_videos.select(
            F.explode(urls).alias("config_url"),
            F.lit("videos").alias("tab"),
            F.expr("cast(substring(video_id, 2) as bigint)").alias("position"),
            "video_id",
        )

    @property
    def loaded(self) -> DataFrame:
        return self.loaded_rows.select("video_id")

    @property
    def loaded_rows(self) -> DataFrame:
        return self.raw_videos.filter(F.col("upload_date") < LOADED_BEFORE)

    @property
    def listing_lines(self) -> DataFrame:
        """Listing entries as JSON lines; ids sometimes only in ``url``; bad lines between."""
        by_url = F.col("tab") == "streams"
        record = F.to_json(
            F.struct(
                "config_url",
                "tab",
                "position",
                F.when(by_url, "").otherwise(F.col("video_id")).alias("id"),
                F.when(by_url, F.col("video_id")).alias("url"),
            )
        )
        broken = F.when(by_url, F.array(F.lit("{bad"), F.lit(""))).otherwise(
            F.array(F.lit('{"id":"","tab":"videos"}'))
        )
        return self.listing.select(
            F.explode(F.concat(F.array(record), broken)).alias("value")
        )

    @property
    def video_lines(self) -> DataFrame:
        """Video dumps by requested id; live ones spell out nulls; without a duration the line is cut off.

        Some hold another id of their own, or a field of another type.
        """
        number = F.expr("cast(substring(video_id, 2) as bigint)")
        record = F.struct(
            F.when(number % 37 == 0, F.concat(F.lit("other-"), F.col("video_id")))
            .otherwise(F.col("video_id"))
            .alias("id"),
            "title",
            F.when(F.col("is_live"), F.repeat("description", F.lit(60)))
            .otherwise(F.col("description"))
            .alias("description"),
            F.col("channel_name").alias("channel"),
            "channel_id",
            "channel_url",
            F.coalesce(F.replace("upload_date", F.lit("-"), F.lit("")), F.lit("")).alias(
                "upload_date"
            ),
            F.col("duration_seconds").alias("duration"),
            "view_count",
            "like_count",
            "comment_count",
            F.from_json("tags", "array<string>").alias("tags"),
            F.from_json("categories", "array<string>").alias("categories"),
            F.col("thumbnail_url").alias("thumbnail"),
            "language",
            F.when(F.col("is_live"), True).alias("is_live"),
            F.when(F.col("was_live"), True).alias("was_live"),
        )
        line = F.when(F.col("is_live"), F.to_json(record, {"ignoreNullFields": "false"})).otherwise(
            F.to_json(record)
        )
        # each step is a projection of its own: nested in each other, the steps would repeat the line 96 times
        lines = self.raw_videos.select(
            F.col("video_id").alias("requested_id"), number.alias("number"), "duration_seconds", line.alias("value")
        )
        for every, pattern, other in (
            (17, r'"duration":(\d+)', '"duration":$1.0'),
            (19, r'"view_count":(\d+)', '"view_count":"$1"'),
            (23, r'"tags":\[[^\]]*\]', '"tags":"x"'),
            (29, '"is_live":true', '"is_live":"true"'),
            (31, r'"like_count":(\d+)', '"like_count":{"n":$1}'),
        ):
            other_type = F.regexp_replace("value", pattern, other)
            lines = lines.withColumn("value", F.when(F.col("number") % every == 0, other_type).otherwise(F.col("value")))
        cut = F.substring("value", F.lit(1), F.length("value") - 1)
        value = F.when(F.col("duration_seconds").isNull(), cut).otherwise(F.col("value"))
        return lines.select("requested_id", value.alias("value"))

    @property
    def parsed_videos(self) -> DataFrame:
        return dumps.parse_videos(self.video_lines, SCRAPED_AT)

    @property
    def channel_lines(self) -> tuple[DataFrame, DataFrame]:
        """Channel listing lines and, for channels with known subscribers, extract lines.

        Every other line spells out nulls; some have no uploader, some extracts no id.
        """
        niche = F.col("niche")
        number = F.expr("cast(substring(channel_id, 3) as bigint)")
        listed = F.struct(
            F.col("channel_name").alias("channel"),
            F.when(F.col("region") == "ID", F.col("channel_id")).alias("channel_id"),
            F.when(niche == "building", "").otherwise(F.col("channel_url")).alias("channel_url"),
            F.when(number % 7 != 0, F.col("config_name")).alias("uploader"),
            F.concat(F.lit("Listing of "), F.col("description")).alias("description"),
            F.when(niche != "machinery", F.concat(F.lit("x"), F.col("channel_id"))).alias("url"),
        )
        listing = F.when(
            number % 2 == 0, F.to_json(listed, {"ignoreNullFields": "false"})
        ).otherwise(F.to_json(listed))
        extract = F.to_json(
            F.struct(
                F.when(F.col("region") == "ID", F.upper("channel_name")).alias("channel"),
                F.when(number % 5 != 0, F.col("channel_id")).alias("channel_id"),
                F.lit("").alias("channel_url"),
                F.when(niche != "furniture", F.repeat("description", F.lit(40))).alias(
                    "channel_description"
                ),
                F.col("subscriber_count").alias("channel_follower_count"),
            )
        )
        url = F.col("channel_url").alias("config_url")
        rows = self.current_channels
        extracts = rows.filter(F.col("subscriber_count").isNotNull())
        return rows.select(url, listing.alias("value")), extracts.select(url, extract.alias("value"))

    @property
    def parsed_channels(self) -> DataFrame:
        return dumps.parse_channels(*self.channel_lines, SCRAPED_AT)

    @property
    def registry_documents(self) -> DataFrame:
        """A registry document per channel with two entries, the second without an id."""
        empty = F.lit(None).cast("string")
        entries = F.array(
            F.struct(
                F.col("config_name").alias("name"),
                F.col("channel_url").alias("url"),
                F.when(F.col("region") == "ID", F.col("channel_id")).alias("channel_id"),
                "region",
            ),
            F.struct(
                F.concat(F.lit("alt-"), F.col("config_name")).alias("name"),
                F.concat(F.col("channel_url"), F.lit("/alt")).alias("url"),
                empty.alias("channel_id"),
                "region",
            ),
        )
        document = F.to_json(F.create_map(F.col("niche"), entries))
        return self.current_channels.select(document.alias("value"))

    @property
    def observed_lines(self) -> DataFrame:
        """Answers of the registry URLs that work: those with known subscribers."""
        answer = F.to_json(
            F.struct(F.col("channel_name").alias("channel"), "channel_id", "channel_url")
        )
        rows = self.current_channels.filter(F.col("subscriber_count").isNotNull())
        return rows.select(F.col("channel_url").alias("url"), answer.alias("value"))

    @property
    def search_lines(self) -> DataFrame:
        """Three answers per search, the first unusable; only some name a channel."""
        found = F.concat(F.lit("https://example.com/found/"), F.col("channel_id"))
        usable = F.when(
            F.col("region") == "ID",
            F.to_json(
                F.struct(
                    F.lit("").alias("channel"),
                    F.col("config_name").alias("uploader"),
                    found.alias("channel_url"),
                )
            ),
        ).otherwise(F.lit('{"channel":"nobody"}'))
        later = F.when(
            F.col("niche") == "building",
            F.to_json(F.struct("channel_id", F.concat(found, F.lit("/b")).alias("channel_url"))),
        ).otherwise(F.lit('{"channel_url":""}'))
        lines = F.array(F.lit("{bad"), usable, later)
        name = first_filled(F.col("config_name"), F.col("channel_id"))
        return self.current_channels.select(
            name.alias("name"), "niche", F.posexplode(lines).alias("position", "value")
        )

    @cached_property
    def listed(self) -> DataFrame:
        return materialize(ingest.listed_videos(self.listing), "listed")

    @cached_property
    def parsed(self) -> DataFrame:
        return materialize(self.parsed_videos, "parsed")

    @cached_property
    def claimed(self) -> DataFrame:
        return ingest.claims(self.listed, self.loaded, self.registry, self.parsed)


_datasets: dict[tuple[str, str], Dataset] = {}
_lock = threading.Lock()


def dataset(spark: SparkSession, sf_dir: str) -> Dataset:
    key = (spark.sparkContext.applicationId, str(sf_dir).rstrip("/"))
    with _lock:
        if key not in _datasets:
            _datasets[key] = Dataset(spark, key[1])
        return _datasets[key]


def new_store(spark: SparkSession, label: str) -> FolderStore:
    return FolderStore(spark, fresh_folder(spark, label))


