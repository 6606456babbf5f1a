"""The curated channel registry: nested ``niche -> [entries]`` documents as rows."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas
from ..functions.scalars import first_filled

_ENTRIES_PER_NICHE = 1_000_000_000
_NICHES_PER_DOCUMENT = 1_000_000


def flatten(documents: DataFrame) -> DataFrame:
    """One row per entry of registry documents (JSON text in ``value``).

    The niche comes from the key; a missing channel_id is NULL. ``position`` keeps
    the order of the document: niches as listed, entries as listed. Of several
    documents, those with a smaller number in column ``document`` come first; without
    that column there must be one only, or positions repeat.
    """
    nested = F.from_json("value", schemas.REGISTRY_DOCUMENT)
    number = F.col("document") if "document" in documents.columns else F.lit(0)
    by_niche = documents.select(
        number.cast("bigint").alias("document"),
        F.posexplode(nested).alias("niche_place", "niche", "entries"),
    )
    entries = by_niche.select(
        "document", "niche_place", "niche", F.posexplode("entries").alias("place", "entry")
    )
    niche_number = F.col("document") * _NICHES_PER_DOCUMENT + F.col("niche_place")
    place = niche_number * _ENTRIES_PER_NICHE + F.col("place")
    return entries.select(
        "entry.name", "entry.url", "entry.channel_id", "niche", "entry.region",
        place.alias("position"),
    )


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """Registry from JSON files, one document per file, in the order of their names."""
    files = spark.read.text(path, wholetext=True).withColumn("_file", F.input_file_name())
    by_name = Window.orderBy("_file")  # a few curated files
    return flatten(files.withColumn("document", F.row_number().over(by_name) - 1))


def read_yaml(spark: SparkSession, path: str) -> DataFrame:
    """Registry from one small YAML file on the driver."""
    import yaml

    with open(path, encoding="utf-8") as file:
        document = json.dumps(yaml.safe_load(file))
    return flatten(spark.createDataFrame([(document,)], "value string"))


def only_niche(registry: DataFrame, niche: str | None) -> DataFrame:
    return registry.filter(F.col("niche") == niche) if niche else registry


def resolve(registry: DataFrame, observed: DataFrame, hits: DataFrame) -> DataFrame:
    """Check registry entries against what was observed and what a search found.

    ``observed``: (url, channel, channel_id, channel_url), one row per working URL.
    ``hits``: first search hits (name, niche, channel, channel_id, channel_url).
    An entry is ``valid`` when its URL was observed, ``found_via_search`` when a
    search hit names a channel, else ``not_found``.
    """
    seen = observed.select("url", F.struct("channel", "channel_id", "channel_url").alias("seen"))
    found = hits.select(
        "name", "niche", F.struct("channel", "channel_id", "channel_url").alias("found")
    )
    joined = registry.join(seen, "url", "left").join(found, ["name", "niche"], "left")
    valid, hit = F.col("seen").isNotNull(), F.col("found").isNotNull()
    best = F.coalesce("seen", "found")
    return joined.select(
        first_filled(best["channel"], F.col("name")).alias("name"),
        first_filled(best["channel_url"], F.col("url")).alias("url"),
        F.when(valid | hit, best["channel_id"]).otherwise("").alias("channel_id"),
        "niche",
        "region",
        F.when(valid, "valid").when(hit, "found_via_search").otherwise("not_found").alias("status"),
        "position",
    )


def status_counts(resolved: DataFrame) -> DataFrame:
    status = F.col("status")
    return resolved.groupBy("niche").agg(
        F.count_if(status == "valid").alias("valid"),
        F.count_if(status == "found_via_search").alias("found_via_search"),
        F.count_if(status == "not_found").alias("not_found"),
    )
