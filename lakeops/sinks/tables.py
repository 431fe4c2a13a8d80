"""Parquet tables and exports.

Parquet has no MERGE. A merged table is written to a new version folder and a one-line pointer file is
then swapped, so a failed run leaves the old version and no path is read and written at once.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

POINTER = "_CURRENT"


def _fs(spark: SparkSession, path: str):
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def current_path(spark: SparkSession, root: str) -> str | None:
    """Folder of the current version; None for a table that does not exist."""
    fs, pointer = _fs(spark, f"{root}/{POINTER}")
    if not fs.exists(pointer):
        return None
    stream = fs.open(pointer)
    try:
        name = stream.readUTF()
    finally:
        stream.close()
    return f"{root}/{name}"


def read_table(spark: SparkSession, root: str) -> DataFrame | None:
    path = current_path(spark, root)
    return None if path is None else spark.read.parquet(path)


def clustered(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows of a partition together, so that it gets few files; at run time large partitions are split
    over tasks and small ones combined."""
    return df.hint("rebalance", *by) if by else df


def publish(df: DataFrame, root: str, partition_by: Sequence[str] = ()) -> str:
    """Write a new version and make it current. Old versions stay until the owner removes them."""
    spark = df.sparkSession
    name = f"v-{uuid.uuid4().hex}"
    clustered(df, partition_by).write.partitionBy(*partition_by).parquet(f"{root}/{name}")
    _point(spark, root, name)
    return f"{root}/{name}"


def _point(spark: SparkSession, root: str, name: str) -> None:
    """Make a version folder the current one, in one step."""
    fs, draft = _fs(spark, f"{root}/.{name}.pointer")
    stream = fs.create(draft, True)
    stream.writeUTF(name)
    stream.close()
    jvm = spark.sparkContext._jvm
    pointer = jvm.org.apache.hadoop.fs.Path(f"{root}/{POINTER}")
    # FileContext replaces the pointer in one step, which FileSystem.rename does not.
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        pointer.toUri() if pointer.toUri().getScheme() else fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration()
    )
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(draft, pointer, options)


def publish_bucketed(df: DataFrame, root: str, keys: Sequence[str], buckets: int = 64) -> str:
    """Write a new version whose rows are bucketed and sorted by their keys, one file a bucket, and make it current.

    Merges on the keys then join the table where it lies: only the source is shuffled, to as many partitions.
    """
    spark = df.sparkSession
    name = f"v_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, *keys)
    dealt.write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys).option("path", f"{root}/{name}").saveAsTable(f"lakeops_{name}")
    _point(spark, root, name)
    return f"{root}/{name}"


def read_bucketed(spark: SparkSession, root: str, schema: StructType, keys: Sequence[str], buckets: int = 64) -> DataFrame | None:
    """The current version of a table of ``publish_bucketed``, with its buckets; schema, keys and number of buckets are those it was written with.

    The session's catalog learns of the version on first use; None for a table that does not exist.
    """
    path = current_path(spark, root)
    if path is None:
        return None
    name = f"lakeops_{path.rsplit('/', 1)[-1]}"
    if not spark.catalog.tableExists(name):
        quoted = ", ".join(f"`{k}`" for k in keys)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        location = path.replace("'", "\\'")
        spark.sql(f"create table {name} ({columns}) using parquet clustered by ({quoted}) sorted by ({quoted}) into {int(buckets)} buckets location '{location}'")
    return spark.table(name)


def write_counted(df: DataFrame, path: str) -> int:
    """Write a folder and return its rows, observed while they are written."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    return seen.get["rows"]


def overwrite_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Replace exactly the partitions that occur in the DataFrame (dynamic partition overwrite)."""
    clustered(df, by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with header, quotes only where needed, NULL as nothing."""
    df.write.mode("overwrite").csv(
        path, header=True, quote='"', escape='"', nullValue="", emptyValue="", ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


def export_projection(df: DataFrame, columns: dict[str, str], path: str) -> None:
    """Named projection to a serving store, replacing what was there."""
    df.select(*[F.col(c).alias(n) for n, c in columns.items()]).write.mode("overwrite").parquet(path)


def export_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str]) -> None:
    """The same to a database: the table is emptied, not dropped."""
    df.write.mode("overwrite").option("truncate", True).jdbc(url, table, properties=properties)


def write_chunks(df: DataFrame, path: str, rows: int = 150, by: Sequence[str] = ()) -> None:
    """JSON lines with at most ``rows`` objects per file, optionally one folder per kind."""
    df.write.mode("overwrite").partitionBy(*by).option("maxRecordsPerFile", rows).json(path)


def stage_rows(df: DataFrame, path: str, id_column: str, rows: int = 250) -> None:
    """Batched JSON-lines staging; rows without an id are left out."""
    write_chunks(df.filter(F.col(id_column).isNotNull()), path, rows)


def append_by_type(df: DataFrame, path: str, event_type: str) -> None:
    """Append to one folder per event type."""
    clustered(df, [event_type]).write.mode("append").partitionBy(event_type).parquet(path)
