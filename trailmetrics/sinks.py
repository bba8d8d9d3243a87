"""Writers of result tables."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterable, Mapping
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trailmetrics.schemas import RESULT_COLUMNS

Sink = Callable[[DataFrame, str], None]


def result_table(df: DataFrame, name: str, task_id: str) -> DataFrame:
    """The columns of a result table in their order, preceded by the task id."""
    return df.select(F.lit(task_id).alias("taskid"), *RESULT_COLUMNS[name])


def write_result(
    df: DataFrame, table: str, options: Mapping[str, str], fmt: str = "jdbc"
) -> None:
    """Append to a table.

    For ``jdbc`` give ``url``, ``user`` and ``password``; ``numPartitions`` limits
    the connections and ``batchsize`` sets the rows per insert. For ``table`` the
    name is a catalog table; for a file format the rows go to ``path``/``table``.
    """
    writer = df.write.mode("append")
    if fmt == "jdbc":
        writer.format("jdbc").options(**options).option("dbtable", table).save()
    elif fmt == "table":
        writer.options(**options).saveAsTable(table)
    else:
        others = {key: value for key, value in options.items() if key != "path"}
        writer.format(fmt).options(**others).save(f"{options['path'].rstrip('/')}/{table}")


def write_task(
    df: DataFrame, table: str, options: Mapping[str, str], fmt: str, task_id: str
) -> None:
    """Write the result of a task in place of what it wrote before.

    The rows of a task are a partition of their own, ``taskid``, so a job that is
    run again under its id leaves one set of rows, also if it now has none. For
    ``table`` and file formats; a database table has no partition to replace.
    """
    if fmt == "jdbc":
        raise ValueError("a JDBC table can only be appended to")
    if fmt == "table":
        replace_partitions(df, table, "taskid", [task_id])
        return
    others = {key: value for key, value in options.items() if key != "path"}
    folder = f"{options['path'].rstrip('/')}/{table}/taskid={quote(task_id, safe='')}"
    df.drop("taskid").write.mode("overwrite").format(fmt).options(**others).save(folder)


def read_results(
    spark: SparkSession, table: str, options: Mapping[str, str], fmt: str
) -> DataFrame:
    """The rows that `write_task` wrote, with the task id in front, as text."""
    if fmt == "table":
        rows = spark.table(table)
    else:
        others = {key: value for key, value in options.items() if key != "path"}
        reader = spark.read.format(fmt).options(**others)
        path = f"{options['path'].rstrip('/')}/{table}"
        # Ids that look like numbers stay text.
        found = reader.load(path).schema
        fields = [f for f in found.fields if f.name != "taskid"]
        rows = reader.schema(T.StructType([*fields, T.StructField("taskid", T.StringType())])).load(
            path
        )
    return rows.select("taskid", *[name for name in rows.columns if name != "taskid"])


def result_sink(
    options: Mapping[str, str], fmt: str = "jdbc", task_id: str | None = None
) -> Sink:
    """A writer for the jobs: called with a result and the name of its table.

    It appends; with a `task_id` it replaces what the task wrote before.
    """
    if task_id is None:
        return lambda df, table: write_result(df, table, options, fmt)
    return lambda df, table: write_task(df, table, options, fmt, task_id)


def replace_table(df: DataFrame, name: str, *partition_by: str) -> None:
    """Replace a managed table, if there is one, by the rows.

    Partition the actions by ``date``: a job then reads only the days it is for.
    Readers meet no table while it is written; see `publish_table`.
    """
    df.write.mode("overwrite").partitionBy(*partition_by).saveAsTable(name)


def bucket_table(df: DataFrame, name: str, buckets: int, by: str = "session_id") -> None:
    """Store a table in buckets, so that grouping and joining by a column move no row.

    Each bucket is one file, sorted by the column. Take at least as many buckets as
    shuffles have partitions; Spark shuffles a table of fewer. A bucket is read by
    one task: where one value holds a large part of the rows, read the table with
    `tables.read_split` instead, which gives up the buckets and splits the files.
    """
    df.repartition(buckets, by).write.mode("overwrite").bucketBy(buckets, by).sortBy(
        by
    ).saveAsTable(name)


def _described(spark: SparkSession, what: str, trait: str) -> str | None:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {what}").where(F.col("col_name") == trait)
    found = rows.collect()
    # A partition's own location comes before that of its table.
    return found[0]["data_type"] if found else None


def publish_table(df: DataFrame, name: str, *partition_by: str) -> str | None:
    """Replace all rows of a published table at one stroke.

    The rows are written as a table of their own, and then the view `name` is
    pointed to it, which is one change of the catalog: readers see the old rows or
    the new ones. Returns the table of the old rows, which running readers may
    still use; drop it later. `name` must be new or published before.
    """
    spark = df.sparkSession
    before = None
    if spark.catalog.tableExists(name):
        text = _described(spark, name, "View Text") or ""
        found = re.fullmatch(r"SELECT \* FROM (\S+)", text.strip())
        if not found:
            raise ValueError(f"{name} is not a published table")
        before = found.group(1)
    version = f"{name}__{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).saveAsTable(version)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {version}")
    return before


def _literal(value) -> str:
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def replace_partitions(
    df: DataFrame, name: str, by: str, values: Iterable | None = None
) -> list[str]:
    """Replace the partitions of a table whose values of `by` the rows have.

    All other partitions stay as they are. New files are written to a folder of
    their own in the table's folder; then each partition is pointed to its new
    folder, which is one change of the catalog: readers see a partition as it was
    or as it is, and one that has begun keeps its files. If the job fails before,
    nothing has changed. Partitions in `values` are replaced even if no row has
    them. A table that does not exist is made. Rows need a value of `by`.

    Returns the folders that are no longer used; `delete_folders` removes them.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        df.limit(0).write.partitionBy(by).saveAsTable(name)
    fresh = f"{_described(spark, name, 'Location')}/_new/{uuid.uuid4().hex}"
    # Named by hexadecimal digits, a folder's name never depends on how paths are escaped.
    part = F.hex(F.col(by).cast("string"))
    kept = [column for column in spark.table(name).columns if column != by]
    df.select(*kept, part.alias("part")).write.partitionBy("part").parquet(fresh)
    written = spark.read.schema("part string").parquet(fresh).distinct().collect()
    if any(row["part"] is None for row in written):
        raise ValueError(f"rows without {by}")
    parts = {row["part"] for row in written}
    parts |= {str(value).encode().hex().upper() for value in values or []}
    replaced = []
    for code in sorted(parts):
        partition = f"PARTITION ({by} = {_literal(bytes.fromhex(code).decode())})"
        try:
            replaced.append(_described(spark, f"{name} {partition}", "Location"))
        except AnalysisException:
            # There is no such partition yet.
            spark.sql(f"ALTER TABLE {name} ADD {partition} LOCATION '{fresh}/part={code}'")
        else:
            spark.sql(f"ALTER TABLE {name} {partition} SET LOCATION '{fresh}/part={code}'")
    return replaced


def delete_folders(spark: SparkSession, folders: Iterable[str]) -> None:
    """Delete folders that no reader uses any more."""
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df
