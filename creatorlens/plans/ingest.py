"""From listings, dumps and the registry to raw table rows, full or incremental.

Listings have columns (config_url, tab, position, video_id): which registry URL,
which tab and which place in it. Registry rows come from ``sources.registry``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas
from ..functions import fixed_values as fixed
from ..functions.display import absolute_url, tab_url
from ..operators.components import components
from ..operators.joins import found_in, hot_counts, lookup_join, spread_join, unseen
from ..operators.ranking import first_per_key
from ..sources.id_index import IdIndex
from ..sources.tables import APPEND, OVERWRITE, Store, coerce, load, loaded_keys
from ..sources.workspace import materialize
from .current import CurrentChannels

_LISTED_ORDER = ("tab_order", "position")
# listed ids of entries that one task goes through in turn
GROUP_ROWS = 1_000_000
# links between entries that one task joins up, in about 130 bytes each; beyond, rounds go over all of them
GROUP_LINKS = 6_000_000
# parts of the contested entries that a round can read by themselves, and rounds kept apart
_BUCKETS, _BATCHES = 64, 8


def _tab_order() -> Column:
    return F.array_position(F.lit(list(fixed.TAB_ORDER)), F.col("tab")).cast("int")


def listed_videos(listing: DataFrame, per_tab: int = fixed.LISTING_LIMIT) -> DataFrame:
    """What one run sees: the first entries of each tab, streams only if not also videos.

    After the cut a channel has at most two tabs of ``per_tab`` rows.
    """
    capped = first_per_key(listing, ["config_url", "tab"], [F.col("position")], per_tab)
    same_video = Window.partitionBy("config_url", "video_id")
    in_videos = F.max(F.col("tab") == fixed.TAB_ORDER[0]).over(same_video)
    return (
        capped.withColumn("_in_videos", in_videos)
        .filter((F.col("tab") == fixed.TAB_ORDER[0]) | ~F.col("_in_videos"))
        .drop("_in_videos")
        .withColumn("tab_order", _tab_order())
    )


def listing_requests(registry: DataFrame) -> DataFrame:
    """Tabs a fetcher has to list: one row per registered channel and tab."""
    tabs = registry.select(
        F.col("url").alias("config_url"), F.explode(F.lit(list(fixed.TAB_ORDER))).alias("tab")
    )
    return tabs.withColumn("request_url", tab_url(F.col("config_url"), F.col("tab")))


def video_requests(ids: DataFrame) -> DataFrame:
    """Videos a fetcher has to extract: one row per distinct id."""
    distinct = ids.select("video_id").distinct()
    return distinct.withColumn("request_url", absolute_url(F.col("video_id")))


def union_batches(batches: Sequence[DataFrame]) -> DataFrame:
    """All rows of several batches; a column missing in one is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), batches)


def raw_channels(registry: DataFrame, channels: DataFrame) -> DataFrame:
    """Parsed channel rows stamped with niche, region and name from the registry."""
    stamp = registry.select(
        F.col("url").alias("config_url"), "niche", "region", F.col("name").alias("config_name")
    )
    return coerce(channels.join(stamp, "config_url"), schemas.RAW_CHANNELS)


def failed_channels(registry: DataFrame, channels: DataFrame) -> DataFrame:
    """Registry entries for which no channel row could be read."""
    return registry.join(channels.select(F.col("config_url").alias("url")), "url", "left_anti")


def raw_videos(listed: DataFrame, registry: DataFrame, videos: DataFrame) -> DataFrame:
    """Parsed videos of the listed ids, stamped from the registry.

    Rows that name a registry entry get the stamp of that entry, others one row for each
    entry with their URL. Ids without a parsed video drop out. One video may be listed
    by very many channels, so the join spreads such ids.
    """
    key = "entry" if "entry" in listed.columns else "config_url"
    source = "position" if key == "entry" else "url"
    stamp = registry.select(F.col(source).alias(key), "niche", "region")
    stamped = materialize(
        lookup_join(listed.select(key, "video_id"), stamp, key, how="inner"), "stamped"
    )
    joined = spread_join(stamped, videos, "video_id", how="inner", spread_by=[key])
    return coerce(joined, schemas.RAW_VIDEOS)


def full_videos(
    listing: DataFrame,
    registry: DataFrame,
    videos: DataFrame,
    max_videos: int = fixed.MAX_VIDEOS,
) -> DataFrame:
    """Raw video rows of a full run: ``max_videos`` per tab of every registered channel."""
    listed = materialize(listed_videos(listing, max_videos), "listed")
    return raw_videos(listed, registry, videos)


def claims(
    listed: DataFrame,
    loaded: DataFrame,
    registry: DataFrame,
    videos: DataFrame,
    max_new: int = fixed.MAX_NEW_VIDEOS,
    *,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Which registry entry loads which new video: (entry, config_url, video_id, has_video).

    Entries count by their ``position``, two of them with one URL are two. Each takes its
    first ``max_new`` listed ids that are neither loaded before nor taken by an earlier
    entry. An id without a parsed video uses up a place but is not taken from later ones.

    An id that no earlier entry lists is free when its entry's turn comes, and so is one
    without a parsed video. Behind ``max_new`` of these an entry takes nothing, whatever the
    others do, so its list ends there. Entries that are left without a contested id take all
    they have. The others fall into groups linked by shared ids; a group is gone through entry
    by entry in one task, all groups side by side. In a group of more than ``group_rows``
    listed ids all entries offer for their first ids at once; an id goes to the earliest entry
    offering, and those that lost one offer again in the following round. That ends with the
    same outcome, after as many rounds as its longest chain of entries that displace each other.
    """
    entries = registry.select(F.col("position").alias("entry"), F.col("url").alias("config_url"))
    offered = lookup_join(listed, entries, "config_url", how="inner").select(
        "entry", "config_url", "video_id", *_LISTED_ORDER
    )
    offered = materialize(offered, "candidates")
    fresh, often = _fresh_ids(offered, loaded, videos)
    known = lookup_join(offered, fresh, "video_id", hot=often)
    known = known.filter("has_video IS NOT NULL OR video_id IS NULL").fillna(False, ["has_video"])
    reach = materialize(_within_reach(known.filter("entry IS NOT NULL"), max_new), "within-reach")
    taken = _taken(reach, max_new, group_rows)
    if not offered.filter("entry IS NULL").isEmpty():
        taken = materialize(taken, "taken")
        taken = taken.unionByName(_without_place(known, taken, max_new), allowMissingColumns=True)
    return taken.select("entry", "config_url", "video_id", "has_video")


def _fresh_ids(offered: DataFrame, loaded: DataFrame, videos: DataFrame) -> tuple[DataFrame, list[tuple]]:
    """Ids not loaded before: (video_id, has_video, first), and those that very many entries list.

    ``first`` is the first entry that lists the id if it has a parsed video and several list it.
    """
    per_id = offered.groupBy("video_id").agg(
        F.min("entry").alias("first"), F.max("entry").alias("_last"), F.count(F.lit(1)).alias("_rows")
    )
    ids = materialize(per_id.filter("video_id IS NOT NULL"), "ids")
    shared = F.col("has_video") & (F.col("first") < F.col("_last"))
    fresh = materialize(
        found_in(ids, "video_id", {"_loaded": loaded, "has_video": videos})
        .filter("NOT _loaded")
        .select("video_id", "has_video", F.when(shared, F.col("first")).alias("first"), "_rows"),
        "fresh",
    )
    return fresh.drop("_rows"), hot_counts(fresh, "video_id", "_rows")


def _within_reach(rows: DataFrame, max_new: int) -> DataFrame:
    """The rows of each entry up to its ``max_new``-th that nobody can take from it, with their place."""
    rows = rows.repartition("entry")
    rows = first_per_key(rows, ["entry", "video_id"], [F.col(c) for c in (*_LISTED_ORDER, "config_url")])
    in_order = Window.partitionBy("entry").orderBy(*_LISTED_ORDER, "video_id")
    sure = (F.col("first").isNull() | (F.col("first") == F.col("entry"))).cast("int")
    so_far = F.sum(sure).over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        rows.withColumn("place", F.row_number().over(in_order))
        .withColumn("_sure", so_far - sure)
        .filter(F.col("_sure") < max_new)
        .select("entry", "config_url", "video_id", "has_video", "first", "place")
    )


def _taken(reach: DataFrame, max_new: int, group_rows: int) -> DataFrame:
    """The rows of ``reach`` that their entries take."""
    links = reach.filter("first < entry").select(F.col("entry").alias("a"), F.col("first").alias("b"))
    groups = components(links, together=GROUP_LINKS).select(F.col("node").alias("entry"), F.col("label").alias("group"))
    grouped = materialize(lookup_join(reach, groups, "entry", hot=()), "grouped")
    large = grouped.filter("group IS NOT NULL").groupBy("group").agg(F.count(F.lit(1)).alias("_rows"))
    large = large.filter(F.col("_rows") > group_rows).select("group", F.lit(True).alias("large"))
    large = materialize(large, "large-groups")
    alone, contested = grouped.filter("group IS NULL"), grouped.filter("group IS NOT NULL")
    if large.isEmpty():
        return union_batches([alone.drop("group"), _in_turn(contested, max_new)])
    marked = materialize(lookup_join(contested, large, "group"), "marked")
    small = marked.filter("large IS NULL").drop("large")
    rows = marked.filter("large").drop("group", "large").withColumn("shared", F.col("first").isNotNull())
    bucket = F.pmod(F.xxhash64("entry"), F.lit(_BUCKETS)).cast("int")
    rows = rows.withColumn("bucket", bucket).repartition(_BUCKETS, "bucket")
    rows = materialize(rows, "contested", partition_by=["bucket"])
    by_place = [F.col("place")]
    held = materialize(_settled(rows, max_new, by_place), "held")
    free = lookup_join(rows.drop("shared", "bucket"), held, "video_id").filter(_free()).drop("holder")
    in_rounds = first_per_key(free, ["entry"], by_place, max_new)
    return union_batches([alone.drop("group"), _in_turn(small, max_new), in_rounds])


def _free() -> Column:
    """Whether no earlier entry holds the id."""
    return F.col("holder").isNull() | (F.col("holder") >= F.col("entry"))


def _in_turn(grouped: DataFrame, max_new: int) -> DataFrame:
    """Rows that the entries of each group take, entry by entry; a task holds the shared ids of one group."""

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, at, places, held = None, None, 0, set()
        for batch in batches:
            take = []
            columns = (batch.column(name).to_pylist() for name in ("group", "entry", "video_id", "first"))
            for group, entry, video, first in zip(*columns):
                if group != now:
                    now, at, held = group, None, set()
                if entry != at:
                    at, places = entry, 0
                free = places < max_new and video not in held
                take.append(free)
                if free:
                    places += 1
                    if first is not None:
                        held.add(video)
            yield batch.filter(pa.array(take, pa.bool_()))

    by_turn = grouped.repartition("group").sortWithinPartitions("group", "entry", "place")
    return by_turn.mapInArrow(settle, by_turn.schema).drop("group")


def _without_place(known: DataFrame, taken: DataFrame, max_new: int) -> DataFrame:
    """What entries without a place take: together the first ids of theirs that no entry contested and took."""
    by_list = [F.col(name) for name in _LISTED_ORDER]
    rows = first_per_key(known.filter("entry IS NULL"), ["entry", "video_id"], by_list)
    held = taken.filter("first IS NOT NULL").select("video_id", F.lit(True).alias("held")).distinct()
    free = lookup_join(rows, materialize(held, "held"), "video_id").filter("held IS NULL").drop("held")
    return first_per_key(free, ["entry"], by_list, max_new).drop(*_LISTED_ORDER)


def _settled(contested: DataFrame, max_new: int, by_list: Sequence[Column]) -> DataFrame:
    """Who holds each shared video in the end: (video_id, holder)."""
    held: DataFrame | None = None
    losers: DataFrame | None = None
    rounds: list[DataFrame] = []
    while True:
        rows = contested
        if losers is not None:
            buckets = [row["bucket"] for row in losers.select("bucket").distinct().collect()]  # at most _BUCKETS
            rows = lookup_join(
                contested.filter(F.col("bucket").isin(buckets)), losers.select("entry"), "entry", how="inner"
            )
        if held is None:
            rows = rows.withColumn("holder", F.lit(None).cast("bigint"))
        else:
            rows = lookup_join(rows, held, "video_id").filter(_free())
        offers = first_per_key(rows, ["entry"], by_list, max_new).filter("has_video AND shared")
        offers = materialize(offers.select("entry", "video_id", "holder"), "offers")
        best = offers.groupBy("video_id").agg(F.min("entry").alias("best"))
        lost = F.when(F.col("entry") > F.col("best"), F.col("entry"))
        displaced = F.when(F.col("holder") > F.col("best"), F.col("holder"))
        bids = materialize(
            lookup_join(offers, best, "video_id").select(
                "video_id", F.col("best").alias("holder"),
                F.explode(F.array_distinct(F.array(lost, displaced))).alias("entry"),
            ).distinct(),
            "bids",
        )
        rounds.append(bids.select("video_id", "holder"))
        bidders = bids.filter(F.col("entry").isNotNull()).select("entry").distinct()
        if bidders.isEmpty():
            return _holders(rounds)
        if len(rounds) > _BATCHES:
            rounds = [materialize(_holders(rounds), "held")]
        held = _holders(rounds)
        bucket = F.pmod(F.xxhash64("entry"), F.lit(_BUCKETS)).cast("int")
        losers = materialize(bidders.withColumn("bucket", bucket), "losers")


def _holders(rounds: Sequence[DataFrame]) -> DataFrame:
    """An id passes to earlier entries only."""
    return union_batches(rounds).groupBy("video_id").agg(F.min("holder").alias("holder"))


_OUTCOME_KEYS = ("config_url", "name", "niche", "region", "channel_loaded")


def _with_channel(registry: DataFrame, channels: DataFrame) -> DataFrame:
    """Registered channels, flagged by whether their channel row could be read."""
    read = channels.select("config_url").distinct().withColumn("_read", F.lit(True))
    return (
        registry.withColumnRenamed("url", "config_url")
        .join(read, "config_url", "left")
        .withColumn("channel_loaded", F.coalesce("_read", F.lit(False)))
        .select(F.col("position").alias("entry"), *_OUTCOME_KEYS)
    )


def incremental_outcomes(
    registry: DataFrame,
    channels: DataFrame,
    listed: DataFrame,
    loaded: DataFrame,
    claimed: DataFrame,
) -> DataFrame:
    """Per registry entry: ids found, ids loaded before, videos newly loaded."""
    fresh = unseen(listed, loaded, "video_id")
    found = listed.groupBy("config_url").agg(F.count(F.lit(1)).alias("total_found"))
    unloaded = fresh.groupBy("config_url").agg(F.count(F.lit(1)).alias("unloaded"))
    new = claimed.groupBy("entry").agg(F.count_if("has_video").alias("new_videos"))
    counts = (
        _with_channel(registry, channels)
        .join(found, "config_url", "left")
        .join(unloaded, "config_url", "left")
        .join(new, "entry", "left")
        .fillna(0, ["total_found", "unloaded", "new_videos"])
    )
    return counts.select(
        *_OUTCOME_KEYS,
        "total_found",
        (F.col("total_found") - F.col("unloaded")).alias("existing"),
        "new_videos",
        (F.col("new_videos") == 0).alias("skipped"),
    )


def full_outcomes(
    registry: DataFrame, channels: DataFrame, listed: DataFrame, videos: DataFrame
) -> DataFrame:
    """Per registered channel: whether its channel row was read and how many videos."""
    ids = videos.select("video_id").distinct()
    pairs = listed.select("config_url", "video_id")
    read = spread_join(pairs, ids, "video_id", how="inner", spread_by=["config_url"])
    loaded = read.groupBy("config_url").agg(F.count(F.lit(1)).alias("new_videos"))
    return (
        _with_channel(registry, channels)
        .join(loaded, "config_url", "left")
        .select(*_OUTCOME_KEYS, F.coalesce("new_videos", F.lit(0)).alias("new_videos"))
    )


def run_report(outcomes: DataFrame) -> DataFrame:
    """Totals of a run: channels read, failed, skipped, and videos."""
    loaded = F.col("channel_loaded")
    return outcomes.agg(
        F.count(F.lit(1)).alias("channels"),
        F.count_if(loaded).alias("channels_loaded"),
        F.count_if(~loaded).alias("channels_failed"),
        F.count_if(F.col("new_videos") == 0).alias("channels_skipped"),
        F.coalesce(F.sum("new_videos"), F.lit(0)).alias("videos_loaded"),
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table, in one result."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in tables.items()
    ]
    return union_batches(parts)


def load_full(
    store: Store, channel_rows: DataFrame, video_rows: DataFrame, *, index: IdIndex | None = None
) -> dict[str, int]:
    """Replace both raw tables; an empty input leaves its table alone."""
    written = {
        "channels": load(channel_rows, store, "raw_channels", OVERWRITE),
        "videos": load(video_rows, store, "raw_videos", OVERWRITE),
    }
    if index and written["videos"]:
        index.reset()
        index.add(store.read("raw_videos", schemas.RAW_VIDEOS), written["videos"])
    return written


def _loaded(store: Store, listed: DataFrame, index: IdIndex | None) -> DataFrame:
    """Ids of videos loaded before; with an index only those that are listed now.

    The index knows how many rows it stands for. If the table has others, a run ended
    between its load and its note, and all ids are read once.
    """
    if index is None:
        return loaded_keys(store, "raw_videos", schemas.RAW_VIDEOS, "video_id")
    rows = 0
    if store.exists("raw_videos"):
        table = store.read("raw_videos", schemas.RAW_VIDEOS)
        rows = table.count()  # from the footers
    if rows != index.covered():
        index.reset()
        if rows:
            index.add(table, rows)
    return materialize(index.known(listed), "known")


def load_incremental(
    store: Store,
    registry: DataFrame,
    listing: DataFrame,
    channels: DataFrame,
    videos: DataFrame,
    *,
    max_new: int = fixed.MAX_NEW_VIDEOS,
    per_tab: int = fixed.LISTING_LIMIT,
    index: IdIndex | None = None,
    current: CurrentChannels | None = None,
) -> dict[str, int]:
    """Append a snapshot of every channel and the videos not loaded yet.

    The videos are settled before the channels are written, so a repeated run adds
    no video twice. With ``index`` the listed ids are compared with their buckets of it
    instead of all loaded videos; with ``current`` the new snapshots are merged into it.
    """
    listed = materialize(listed_videos(listing, per_tab), "listed")
    loaded = _loaded(store, listed, index)
    claimed = materialize(claims(listed, loaded, registry, videos, max_new), "claimed")
    written = load(raw_videos(claimed, registry, videos), store, "raw_videos", APPEND)
    if index and written:
        index.add(claimed.filter("has_video"), written)
    rows = materialize(raw_channels(registry, channels), "snapshots")
    if current:
        current.merge(rows)
    return {"videos": written, "channels": load(rows, store, "raw_channels", APPEND)}
