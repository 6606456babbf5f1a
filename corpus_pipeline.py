"""From documents to packed sequences: five stages, each written as Parquet and read again.

Every stage gets (spark, docs, sf_dir), works on all rows of ``docs`` and returns a
DataFrame; all but the last return the columns of documents. Nothing is capped or sampled.
"""

from __future__ import annotations

import functools
import gc
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creatorlens.llm import language_id, mixing, near_dedup, packing, secret_scan
from creatorlens.llm.queries import MIX_SHARE, MIX_WEIGHTS, SEQUENCE_TOKENS, language_samples
from creatorlens.llm.shipping import ship
from creatorlens.llm.tokenizers_by_path import vocabulary
from creatorlens.sources.workspace import discard, gathered, materialize

DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")
SHINGLE_WORDS, SIMILARITY = 5, "0.8"
#: Whole texts go to Python workers in batches of at most so many bytes (or one text), so that
#: a worker's memory doesn't depend on how long 10,000 texts are.
BATCH_BYTES = 4 << 20
_ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def _set_aside(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with other names for columns that are no part of documents, and those names."""
    other = {c: f"__given{nth}" for nth, c in enumerate(docs.columns) if c not in DOCUMENT}
    return docs.withColumnsRenamed(other), other


def _put_back(docs: DataFrame, other: dict[str, str], columns: list[str]) -> DataFrame:
    return docs.select(*[F.col(other.get(c, c)).alias(c) for c in columns])


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter go; a missing language is filled in.

    A text with letters stays even if the model has no name for it, as without any samples;
    its missing language is then ``und``.
    """
    ship(spark)
    columns = docs.columns
    docs, other = _set_aside(docs)
    named = language_id.with_language(docs, language_samples(docs))
    kept = named.filter(F.col("text").rlike(r"\p{L}") | (F.col("lang_pred") != language_id.UNKNOWN))
    return _put_back(kept.withColumn("lang", F.coalesce("lang", "lang_pred")), other, columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest doc_id stays."""
    ship(spark)
    return near_dedup.survivors(docs, width=SHINGLE_WORDS, similarity=SIMILARITY)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets give way to a mark; every document stays, with its new number of characters.

    Beyond ``op1_secret_scan``, whose SQL is fixed, an allowed word clears its own piece of a
    candidate only, and keys in letters of one case are looked for.
    """
    text = secret_scan.redacted(F.col("text"), F.col("secret_spans"))
    columns = docs.columns
    docs, other = _set_aside(docs)
    scanned = secret_scan.scan(docs, classes=secret_scan.CLASSES + secret_scan.ONE_CASE, pieces=True)
    cleaned = scanned.withColumn("__clean", text)
    found = F.size("secret_spans") > 0
    changed = cleaned.withColumns(
        {"text": F.col("__clean"), "n_chars": F.when(found, F.length("__clean")).otherwise(F.col("n_chars"))}
    )
    return _put_back(changed, other, columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per time that the mix takes a document, by shard; the last one of a source may be cut."""
    ship(spark)
    return mixing.mixed_documents(docs, MIX_WEIGHTS, MIX_SHARE)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their sequences and places."""
    ship(spark)
    return packing.pack_documents(docs, vocabulary("byte_bpe_50k.json"), SEQUENCE_TOKENS)


_scratch: dict[str, list[str]] = {}


def _tidy(stage: Callable) -> Callable:
    """``stage`` with intermediate tables in a folder of its own, that a later stage removes.

    When a stage begins, the results of those before it have been written and are its ``docs``;
    what they were made from goes, unless ``docs`` is still to be read from it. Spark removes
    shuffle files and broadcasts once the driver has collected the plans that used them, so
    it is asked to do that before the next stage.
    """

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        # The session keeps it: the stage's result is planned when its caller writes it.
        spark.conf.set(_ARROW_BYTES, str(BATCH_BYTES))
        folders = _scratch.setdefault(spark.sparkContext.applicationId, [])
        if folders:
            read = docs.inputFiles()
            for folder in [f for f in folders if not any(f.rsplit("/", 1)[-1] in file for file in read)]:
                discard(spark, folder)
                folders.remove(folder)
        gc.collect()  # Python's handles on plans first
        spark.sparkContext._jvm.System.gc()
        with gathered(spark, stage.__name__) as folder:
            folders.append(folder)
            return stage(spark, docs, sf_dir)

    return run_stage


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", _tidy(known_language)),
    ("near_dedup", _tidy(one_of_each)),
    ("secret_scan", _tidy(without_secrets)),
    ("mixing", _tidy(mixed)),
    ("packing", _tidy(packed)),
]
#: SQL can't express the language model or the search for fillings.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
