"""The corpus pipeline: stages that turn `documents` into a training mix.

Each stage keeps intermediate tables, in `tables` if they are given, which the caller
may delete once the stage's result is written; otherwise until the program ends.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trailmetrics.llm import decontaminate, line_dedup, minhash, mixing, toxicity
from trailmetrics.runtime import Scratch, scratch


def drop_toxic(
    spark: SparkSession, docs: DataFrame, sf_dir: str, tables: Scratch | None = None
) -> DataFrame:
    """Keep the documents that the severity model does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.drop_toxic(docs, labels, tables or Scratch(spark, "toxicity"))


def drop_repeated_lines(
    spark: SparkSession, docs: DataFrame, sf_dir: str, tables: Scratch | None = None
) -> DataFrame:
    """Take lines that many documents repeat out of the texts."""
    return line_dedup.dedup_lines(docs, tables or Scratch(spark, "line_dedup"))


def drop_near_duplicates(
    spark: SparkSession, docs: DataFrame, sf_dir: str, tables: Scratch | None = None
) -> DataFrame:
    """Keep one document of each group of near-duplicates."""
    return minhash.drop_near_duplicates(docs, tables or Scratch(spark, "minhash"))


def drop_contaminated(
    spark: SparkSession, docs: DataFrame, sf_dir: str, tables: Scratch | None = None
) -> DataFrame:
    """Keep the documents that are not contaminated by benchmark items."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.decontaminate(docs, benchmark, tables or Scratch(spark, "decontamination"))


def mix_sources(
    spark: SparkSession, docs: DataFrame, sf_dir: str, tables: Scratch | None = None
) -> DataFrame:
    """Repeat or leave out documents until each source has its share."""
    return mixing.mixed(docs, tables or Scratch(spark, "mixing"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("MinHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources", mix_sources),
]

# The severity model, the sketches and Newton's method have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on `documents`, each written before the next one starts.

    What a stage keeps for itself is deleted when its result is written.
    """
    results = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        with scratch(spark, f"stage_{number}") as tables:
            kept = results.write(stage(spark, docs, sf_dir, tables), f"stage_{number}")
        results.drop(f"stage_{number - 1}")
        docs = kept
    return docs
