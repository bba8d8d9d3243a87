"""Parse ad log lines and drop the clicks of blacklisted users.

The transformations take any DataFrame with a ``value`` column: a Kafka stream, a
file stream or a batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trailmetrics.runtime import Scratch
from trailmetrics.sources import tables

# The fields of an ad log line, in order, separated by one space, and
# the micro-batch interval.
AD_FIELDS = [
    ("timestamp", "bigint"),
    ("province", "string"),
    ("city", "string"),
    ("userid", "bigint"),
    ("adid", "bigint"),
]
BATCH_INTERVAL = "5 seconds"
# Batches whose folders lie in one block: half a day of 5-second batches.
BLOCK = 8640


def spread(lines: DataFrame, partitions: int | None) -> DataFrame:
    """Spread the records over more tasks than the source has partitions."""
    return lines if partitions is None else lines.repartition(partitions)


def ad_click_parse(lines: DataFrame) -> DataFrame:
    """The five typed fields of each line.

    Lines with another number of fields, or with text in a number field, are left
    out.
    """
    fields = F.split(F.col("value").cast("string"), " ")
    parsed = (
        lines.select(fields.alias("fields"))
        .where(F.size("fields") == len(AD_FIELDS))
        .select(
            *[
                F.col("fields")[i].try_cast(kind).alias(name)
                for i, (name, kind) in enumerate(AD_FIELDS)
            ]
        )
    )
    return parsed.dropna(subset=[name for name, kind in AD_FIELDS if kind == "bigint"])


def ad_click_blacklist_filter(clicks: DataFrame, blacklist: DataFrame) -> DataFrame:
    """Clicks whose user is not on the blacklist.

    Whether the blacklist is broadcast is left to Spark, which checks its size.
    """
    return clicks.join(blacklist.select("userid"), "userid", "left_anti").select(
        *[name for name, _ in AD_FIELDS]
    )


def ad_click_filter(
    lines: DataFrame, blacklist: DataFrame, partitions: int | None = None
) -> DataFrame:
    return ad_click_blacklist_filter(ad_click_parse(spread(lines, partitions)), blacklist)


def _trigger(available_now: bool) -> dict:
    return {"availableNow": True} if available_now else {"processingTime": BATCH_INTERVAL}


def write_stream(
    clicks: DataFrame, path: str, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Append the stream to parquet files, each row once, also after a restart."""
    return (
        clicks.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**_trigger(available_now))
        .start(path)
    )


def block_path(path: str, block: int) -> str:
    return f"{path}/block-{block:06d}"


def read_written(spark: SparkSession, path: str) -> DataFrame:
    """The rows that `write_filtered_stream` wrote, whether merged or not."""
    schema = ", ".join(f"{name} {kind}" for name, kind in AD_FIELDS)
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(path)


def merge_block(
    spark: SparkSession, path: str, block: int, scratch: Scratch, files: int = 1
) -> None:
    """Replace the batch folders of a finished block by `files` files.

    Run it for blocks before the current one, while nobody reads them. The rows
    are kept in a scratch table until the new files are written.
    """
    kept = scratch.write(read_written(spark, block_path(path, block)), "merged")
    kept.coalesce(files).write.mode("overwrite").parquet(block_path(path, block))


def fresh_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table or parquet path as it stands now.

    Spark keeps the list of a table's files, so files that another writer added
    are only seen after a refresh.
    """
    if "/" not in name:
        spark.catalog.refreshTable(name)
    return tables.read_table(spark, name)


def _write_batches(
    lines: DataFrame,
    blacklist_of: Callable[[int], DataFrame],
    path: str,
    checkpoint: str,
    partitions: int | None,
    available_now: bool,
) -> StreamingQuery:
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        kept = ad_click_filter(batch, blacklist_of(batch_id), partitions)
        kept.write.mode("overwrite").parquet(f"{block_path(path, batch_id // BLOCK)}/{batch_id}")

    return (
        lines.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(available_now))
        .start()
    )


def write_filtered_stream(
    lines: DataFrame,
    load_blacklist: Callable[[], DataFrame],
    path: str,
    checkpoint: str,
    partitions: int | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Filter each micro-batch by the blacklist as it stands at that time.

    Each batch has a folder of its own, which a repeated batch replaces, so rows
    are neither lost nor doubled after a restart. Folders lie in blocks of `BLOCK`
    batches; `merge_block` makes one folder of a block that is done. A repeated
    batch may see another list; see `write_versioned_stream`.
    """
    return _write_batches(
        lines, lambda _: load_blacklist(), path, checkpoint, partitions, available_now
    )


def latest_version(spark: SparkSession, blacklist: str) -> int | None:
    """The last version that was published, or None."""
    try:
        complete = spark.read.schema("version long").parquet(f"{blacklist}/complete/*")
    except AnalysisException:
        # There is no such folder yet.
        return None
    return complete.agg(F.max("version")).first()[0]


def publish_version(users: DataFrame, blacklist: str, version: int) -> None:
    """Add a version of the blacklist: all users that are on it from now on.

    A version counts once its users are written as a whole, and never changes.
    """
    spark = users.sparkSession
    latest = latest_version(spark, blacklist)
    if latest is not None and version <= latest:
        raise ValueError(f"version {latest} is published already")
    users.select(F.col("userid").cast("bigint")).write.mode("overwrite").parquet(
        f"{blacklist}/users/{version}"
    )
    mark = spark.range(1).select(F.lit(version).cast("bigint").alias("version"))
    mark.write.mode("overwrite").parquet(f"{blacklist}/complete/{version}")


def _version_of(spark: SparkSession, blacklist: str, chosen: str, batch_id: int) -> int | None:
    """The version that a batch is filtered by, the same one if the batch is repeated.

    It is written down before the batch is. Only the last batch can be repeated, so
    two folders are used in turn.
    """
    place = f"{chosen}/{batch_id % 2}"
    try:
        before = spark.read.schema("batch_id long, version long").parquet(place)
        found = before.where(F.col("batch_id") == batch_id).first()
    except AnalysisException:
        found = None
    if found:
        return found.version
    version = latest_version(spark, blacklist)
    spark.range(1).select(
        F.lit(batch_id).cast("bigint").alias("batch_id"),
        F.lit(version).cast("bigint").alias("version"),
    ).write.mode("overwrite").parquet(place)
    return version


def write_versioned_stream(
    lines: DataFrame,
    blacklist: str,
    path: str,
    checkpoint: str,
    partitions: int | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Filter each micro-batch by the version of the blacklist that is the last at its start.

    `blacklist` is a folder that `publish_version` writes to while the stream runs.
    A batch that is repeated, also after a restart, is filtered by the version that
    it began with. Before the first version nobody is on the list. Batches are
    written as by `write_filtered_stream`.
    """
    spark = lines.sparkSession

    def blacklist_of(batch_id: int) -> DataFrame:
        version = _version_of(spark, blacklist, f"{checkpoint}-versions", batch_id)
        if version is None:
            return spark.createDataFrame([], "userid long")
        return spark.read.schema("userid long").parquet(f"{blacklist}/users/{version}")

    return _write_batches(lines, blacklist_of, path, checkpoint, partitions, available_now)
