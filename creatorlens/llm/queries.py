"""One registered query per operator, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.workspace import materialize
from . import (
    fingerprints,
    host_reputation,
    language_id,
    lexical,
    mixing,
    near_dedup,
    packing,
    reply_trees,
    secret_scan,
    spelling,
    token_counts,
    top_k,
    toxicity,
)
from .shipping import ship
from .spread import shuffled_order
from .tokenizers_by_path import vocabulary

MIX_WEIGHTS, MIX_SHARE = (3, 1, 2), 1.5
TOKEN_LIMIT = 4096
SEQUENCE_TOKENS = 2048
TOP_K, QUERY_DIVISOR = 5, 50
BEST_DOCUMENTS = 50
RUN, TYPO_DIVISOR, WORD_LETTERS, WORD_TIMES = "[A-Za-z\u00C0-\u00FF]+", 199, 6, 5
URL_RULES = (
    host_reputation.Rule("block", "net"),
    host_reputation.Rule("allow", "example.net", "/en/"),
    host_reputation.Rule("block", "example.com", "/de/"),
    host_reputation.Rule("allow", "org", "/fr/"),
)
#: A page shows the document whose number is in its path.
PAGE_DOCUMENT = r"://[^/?#]*/(?:[^/?#]*/)*([0-9]{1,18})(?:[./?#]|$)"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.scan(_table(spark, folder, "documents").select("doc_id", "text"))

    def number(kind: str):
        return F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(number, ("assign", "access", "hex")),
        F.sha2(secret_scan.joined(F.col("base_spans")), 256).alias("base_sha256"),
        secret_scan.joined(F.col("secret_spans")).alias("spans"),
    )


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    held_out = language_id.in_fold("doc_id", 5, 0)
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    labels = _table(spark, folder, "labels").select("doc_id", "toxic").filter(~held_out)
    model = toxicity.learn(docs.filter(~held_out), labels)
    scored = toxicity.with_toxicity(docs, model)
    return scored.select(
        "doc_id",
        held_out.alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
        "worst_sentence",
    )


def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    sized = _table(spark, folder, "documents").select("doc_id", "source", mixing.n_words("text").alias("size"))
    mixed = mixing.mix(materialize(sized, "sized"), MIX_WEIGHTS, MIX_SHARE)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    counted = token_counts.with_token_counts(docs, vocabulary("piece_bpe_32k.model"))
    return counted.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        "n_tokens",
        token_counts.over(TOKEN_LIMIT).alias("over_limit"),
    )


def language_samples(docs: DataFrame) -> language_id.Samples:
    """From the documents that the language model may learn from."""
    learned = docs.filter(~language_id.in_fold("doc_id", 4, 2))
    return language_id.collect_samples(learned.select("text", "lang", shuffled_order("doc_id").alias("order")))


def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    named = language_id.with_language(docs.select("doc_id", "text"), language_samples(docs))
    return named.select(
        "doc_id",
        language_id.in_fold("doc_id", 4, 2).alias("held_out"),
        "lang_pred",
        F.col("lang_score").alias("score"),
    )


def op6_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.neighbours(_table(spark, folder, "documents").select("doc_id", "text"))


def op7_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """Each conversation is a tree without forks: every row replies to the one before.

    Rows of equal turn follow each other by role and text.
    """
    marks = reply_trees.END + reply_trees.START + "assistant ok"
    given = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame(
        [(-1, 0, "user", marks), (-1, 1, "assistant", marks)], "conv_id long, turn long, role string, text string"
    )
    rows = given.unionByName(added)
    in_turn = F.row_number().over(
        reply_trees.Window.partitionBy("conv_id").orderBy(F.asc_nulls_last("turn"), "role", "text")
    )
    nodes = rows.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("tree"),
        in_turn.cast("long").alias("node"),
        (in_turn - 1).cast("long").alias("parent"),
        F.lit(0.0).alias("score"),
        "role",
        "text",
    )
    chats = reply_trees.conversations(nodes)
    turns = chats.withColumn("_turns", reply_trees.read_back(F.col("formatted"))).withColumn(
        "_loss", reply_trees.read_loss(F.col("formatted"), F.col("loss_spans"))
    )
    digest = F.array_join(F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return turns.select(
        F.when(F.col("tree") != "", F.col("tree")).cast("long").alias("conv_id"),
        F.size("_turns").cast("long").alias("n_turns"),
        F.sha2(digest, 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"),
        F.sha2("_loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op8_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    found = near_dedup.near_duplicates(docs, width=3, similarity="0.85")
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    packed = packing.pack_documents(docs, vocabulary("byte_bpe_50k.json"), SEQUENCE_TOKENS)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op10_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return top_k.search(_table(spark, folder, "embeddings"), TOP_K, query_divisor=QUERY_DIVISOR)


def op11_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return lexical.search(docs, _table(spark, folder, "benchmark").select("item_id", "text"), BEST_DOCUMENTS)


def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of letters, some of them with a letter less, as words and their variants."""
    docs = _table(spark, folder, "documents")
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"),
        F.explode(F.regexp_extract_all(lowered, F.lit(RUN), F.lit(0))).alias("run"),
    ).filter(F.length("run") >= WORD_LETTERS)
    hashed = runs.withColumn("h", F.crc32(F.concat("doc", F.lit(":"), "run")))
    gone = F.pmod(F.col("h"), F.length("run")).cast("int")
    shortened = F.concat(F.substr("run", F.lit(1), gone), F.substr("run", gone + 2))
    word = F.when(F.col("h") % TYPO_DIVISOR == 0, shortened).otherwise(F.col("run"))
    words = hashed.groupBy(word.alias("word")).agg(F.count(F.lit(1)).alias("n"))
    words = words.filter((F.col("n") >= WORD_TIMES) & (F.length("word") >= WORD_LETTERS))
    return spelling.variants(materialize(words, "words"))


def op13_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    number = F.regexp_extract("url", PAGE_DOCUMENT, 1)
    pages = _table(spark, folder, "pages").select(
        "page_id", "url", F.when(number != "", number.cast("long")).alias("document")
    )
    outcomes = _table(spark, folder, "labels").select(
        F.col("doc_id").alias("document"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad")
    )
    return host_reputation.judged(pages, outcomes, URL_RULES)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_secret_scan,
            op2_toxicity,
            op3_mixing,
            op4_token_counts,
            op5_language_id,
            op6_fingerprints,
            op7_chat_format,
            op8_near_dedup,
            op9_packing,
            op10_top_k,
            op11_lexical_search,
            op12_spelling_variants,
            op13_url_filter,
        )
    }
