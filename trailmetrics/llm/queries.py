"""The registered queries of the corpus operators; each takes (spark, sf_dir)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmetrics.llm import (
    centroids,
    decontaminate,
    embeddings,
    host_quality,
    language_id,
    line_dedup,
    lm_score,
    minhash,
    mixing,
    oracle,
    prefix_trie,
    substrings,
    toxicity,
    url_filter,
)
from trailmetrics.runtime import Scratch


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes from each document."""
    mix = mixing.mix(_table(spark, sf_dir, "documents"), Scratch(spark, "mixing"), ("doc_id",))
    return mix.select(
        "doc_id",
        F.col("__llm_size").alias("size"),
        F.col("__llm_source_size").alias("source_size"),
        F.col("__llm_target").alias("target"),
        (F.col("__llm_copies") * F.col("__llm_size")).cast("long").alias("taken"),
        F.col("__llm_rate").alias("rate"),
    )


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each document without the lines that others repeat."""
    left = line_dedup.dedup_lines(
        _table(spark, sf_dir, "documents"),
        Scratch(spark, "line_dedup"),
        counts=("n_lines", "n_dropped"),
    )
    return left.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of near-duplicates of each document."""
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), Scratch(spark, "minhash"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Severity of toxic language in each document."""
    documents = _table(spark, sf_dir, "documents")
    model = toxicity.fit(documents, _table(spark, sf_dir, "labels"), Scratch(spark, "toxicity"))
    return toxicity.score(documents, model)


def op5_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The links and the group of each embedding."""
    return embeddings.near_duplicates(
        _table(spark, sf_dir, "embeddings"), Scratch(spark, "embeddings")
    )


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each document without passages of earlier ones."""
    return substrings.dedup_passages(
        _table(spark, sf_dir, "documents"), Scratch(spark, "substrings")
    ).drop("kept")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each document shares with benchmark items."""
    judged = decontaminate.contamination(
        _table(spark, sf_dir, "documents"),
        _table(spark, sf_dir, "benchmark"),
        Scratch(spark, "decontamination"),
    )
    items = F.col("__llm_items")
    return judged.select(
        "doc_id",
        F.col("__llm_n_words").alias("n_words"),
        F.col("__llm_n_hit").alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        F.col("__llm_contaminated").alias("contaminated"),
    )


# Host, path and verdict of each rule.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on each page's URL."""
    rules = spark.createDataFrame(URL_RULES, "rule_host string, rule_path string, verdict string")
    return url_filter.filter_urls(
        _table(spark, sf_dir, "pages"), rules, Scratch(spark, "url_filter")
    ).select("page_id", "host", "path", "rule", "verdict", "template", "purity")


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How near each document is to those that are labelled good."""
    labels = _table(spark, sf_dir, "labels")
    good = labels.groupBy("doc_id").agg(F.min("quality").alias("quality")).where("quality = 1")
    return lm_score.score(_table(spark, sf_dir, "documents"), good, Scratch(spark, "lm_score"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of each document, learned from three quarters of them."""
    documents = _table(spark, sf_dir, "documents")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    model = language_id.fit(documents.where(~held_out), Scratch(spark, "language_id"))
    return language_id.predict(documents, model).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cluster of each embedding after three rounds around 16 centroids."""
    found = centroids.cluster(_table(spark, sf_dir, "embeddings"), Scratch(spark, "centroids"))
    numbers = F.array_join(F.col("__llm_centroid").cast("array<string>"), ",")
    return found.select(
        "vec_id",
        F.col("__llm_cluster").alias("cluster"),
        F.col("__llm_distance").alias("distance"),
        F.col("__llm_cluster_inertia").alias("cluster_inertia"),
        F.col("__llm_inertia").alias("inertia"),
        F.sha2(numbers, 256).alias("centroid_sha256"),
    )


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefixes that conversations share, once begun with turns of their family."""
    scratch = Scratch(spark, "prefix_trie")
    own = prefix_trie.sequences(_table(spark, sf_dir, "conversations"), scratch)
    nodes = prefix_trie.prefix_trie(prefix_trie.with_common_heads(own), scratch)
    return nodes.withColumnRenamed("saved", "saved_tokens")


def op13_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The measures of each document, and whether it and its source pass the rules."""
    judged = host_quality.judge(_table(spark, sf_dir, "documents"), Scratch(spark, "host_quality"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    flags = ("base_failed", "host_failed", "kept")
    return judged.select("doc_id", *[F.col(f"__llm_{name}").alias(name) for name in names + flags])


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_line_dedup": op2_line_dedup,
    "op3_minhash": op3_minhash,
    "op4_toxicity": op4_toxicity,
    "op5_embeddings": op5_embeddings,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_decontamination": op7_decontamination,
    "op8_url_filter": op8_url_filter,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_language_id": op10_language_id,
    "op11_centroids": op11_centroids,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_host_quality": op13_host_quality,
}

ORACLE_SQL = {
    "op2_line_dedup": oracle.LINE_DEDUP,
    "op3_minhash": oracle.NEAR_DUPLICATES,
    "op5_embeddings": oracle.EMBEDDINGS,
    "op6_substring_dedup": oracle.PASSAGES,
    "op7_decontamination": oracle.DECONTAMINATION,
    "op11_centroids": oracle.CENTROIDS,
    "op12_prefix_trie": oracle.PREFIX_TRIE,
    "op13_host_quality": oracle.HOST_QUALITY,
}
