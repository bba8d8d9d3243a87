"""Shared storage for results that several later steps read."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession


class Scratch:
    """Intermediate tables of one run, in a database of their own.

    The database lies in the folder that the cluster names in
    ``spark.checkpoint.dir``, or in the session's warehouse where that setting
    is missing; every executor can read either. Later steps start from files
    that outlive any executor, see their true size when a join is planned, and
    read only the columns they need. `close` deletes the whole folder; it runs
    at the end of the program at the latest.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        self._spark = spark
        self._name = f"scratch_{name}_{uuid.uuid4().hex}"
        self._tables: dict[str, str] = {}
        self._written = 0
        shared = spark.conf.get("spark.checkpoint.dir", None)
        place = f" LOCATION '{shared.rstrip('/')}/{self._name}'" if shared else ""
        spark.sql(f"CREATE DATABASE {self._name}{place}")
        atexit.register(self.close)

    @property
    def folder(self) -> str:
        """The folder of the database, for a stream's files."""
        return self._spark.catalog.getDatabase(self._name).locationUri

    def table(self, name: str) -> str:
        """The full name of a table that a caller writes by itself."""
        return f"{self._name}.{name}"

    def write(
        self,
        df: DataFrame,
        name: str,
        buckets: list[str] | None = None,
        partition_by: list[str] | None = None,
    ) -> DataFrame:
        """Write the rows as a table of its own and read them back.

        With `buckets`, the rows lie in as many buckets of these columns as
        shuffles have partitions, and joins on them need not move the table. With
        `partition_by`, a filter on these columns reads only what it needs.
        """
        self._written += 1
        table = f"{self._name}.{name}_{self._written}"
        writer = df.write
        if buckets:
            count = int(self._spark.conf.get("spark.sql.shuffle.partitions"))
            writer = writer.bucketBy(count, *buckets)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.saveAsTable(table)
        self._tables[name] = table
        return self._spark.table(table)

    def drop(self, name: str) -> None:
        """Delete the last table of this name, once no later step reads it."""
        if name in self._tables:
            self._spark.sql(f"DROP TABLE IF EXISTS {self._tables.pop(name)}")

    def close(self) -> None:
        """Delete every table and the folder; a stopped session leaves them."""
        atexit.unregister(self.close)
        try:
            self._spark.sql(f"DROP DATABASE IF EXISTS {self._name} CASCADE")
        except (PySparkException, OSError, AttributeError):
            # The session has ended, and its catalog with it.
            return


@contextmanager
def scratch(spark: SparkSession, name: str) -> Iterator[Scratch]:
    """Intermediate tables that are deleted at the end of the block."""
    tables = Scratch(spark, name)
    try:
        yield tables
    finally:
        tables.close()
