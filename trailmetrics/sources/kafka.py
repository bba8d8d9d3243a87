"""The Kafka stream of ad log lines."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


def kafka_options(
    brokers: str, topics: Sequence[str] | str, group_id: str | None = None
) -> dict[str, str]:
    """Start at the newest records when there is no checkpoint yet.

    Offsets are kept by the query's checkpoint and never committed to the broker,
    so a restart continues where the checkpoint stands.
    """
    options = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topics if isinstance(topics, str) else ",".join(topics),
        "startingOffsets": "latest",
    }
    return options if group_id is None else {**options, "kafka.group.id": group_id}


def read_kafka(
    spark: SparkSession,
    brokers: str,
    topics: Sequence[str] | str,
    group_id: str | None = None,
    extra: Mapping[str, str] | None = None,
) -> DataFrame:
    """Needs the Spark Kafka connector on the class path."""
    options = {**kafka_options(brokers, topics, group_id), **(extra or {})}
    return spark.readStream.format("kafka").options(**options).load()
