"""Landed files as DataFrames and as tables loaded file by file."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from fnmatch import fnmatchcase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lakeops.sinks.tables import write_counted

CORRUPT = "_corrupt_record"


def list_files(spark: SparkSession, path: str, limit: int | None = None, pattern: str | None = None) -> list[str]:
    """Data files under a path, through the cluster's file system; stops at the limit."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found: list[str] = []
    if not fs.exists(target):
        return found
    listing = fs.listFiles(target, True)
    while listing.hasNext() and (limit is None or len(found) < limit):
        file = listing.next()
        name = file.getPath().getName()
        if not name.startswith(("_", ".")) and file.getLen() > 0 and fnmatchcase(name, pattern or "*"):
            found.append(file.getPath().toString())
    return found


def read_stage_parquet(
    spark: SparkSession, path: str, pattern: str | None = None, recursive: bool = False, schema: StructType | None = None
) -> DataFrame:
    """Parquet under a path; an empty location gives no rows, of the given or an empty schema.

    Without a schema it is merged from the footers of all files, which tasks read.
    """
    if not list_files(spark, path, 1, pattern):
        return spark.createDataFrame([], schema or StructType([]))
    reader = spark.read.option("mergeSchema", True) if schema is None else spark.read.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    return reader.parquet(path)


def read_stage_json(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    strip_outer_array: bool = False,
    pattern: str | None = None,
    recursive: bool = True,
    on_error: str = "abort",
) -> DataFrame:
    """JSON lines, or with ``strip_outer_array`` one array (or object) per file. Compression is by suffix.

    ``on_error`` 'abort' fails on a malformed record, 'continue' leaves it out.
    """
    if on_error not in ("abort", "continue"):
        raise ValueError(f"unknown error policy {on_error}")
    reader = spark.read.option("multiLine", strip_outer_array).option("recursiveFileLookup", recursive)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if on_error == "abort":
        reader = reader.option("mode", "FAILFAST")
        return (reader.schema(schema) if schema is not None else reader).json(path)
    reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    if schema is None:
        df = reader.json(path)
    else:
        typed = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        df = reader.schema(StructType([*typed.fields, StructField(CORRUPT, StringType())])).json(path)
    return df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT) if CORRUPT in df.columns else df


def relative_path(root: str) -> Column:
    """File path below a root folder; '' for a file elsewhere. File paths are URL-encoded, the root is not."""
    below = "/" + root.rstrip("/").split("://")[-1].removeprefix("file:").lstrip("/") + "/"
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    at = F.instr(path, below)
    return F.when(at > 0, F.substring(path, at + len(below), F.length(path))).otherwise("")


def with_path_columns(df: DataFrame, root: str, parts: Mapping[str, tuple[int | Sequence[int], str]], filename: str | None = None) -> DataFrame:
    """Columns cut from the file path below ``root``: {name: (part number(s) from 1, type)}.

    Several parts are joined with '-' (a date in year/month/day folders). Text that does not convert is
    NULL. A filter on these columns is evaluated on file metadata, so other files are not opened.
    """
    path = relative_path(root)
    columns = []
    for name, (index, dtype) in parts.items():
        numbers = [index] if isinstance(index, int) else list(index)
        text = F.concat_ws("-", *[F.split_part(path, F.lit("/"), F.lit(i)) for i in numbers])
        columns.append(text.try_cast(dtype).alias(name))
    if filename:
        columns.append(path.alias(filename))
    return df.select("*", *columns)


def read_partitioned(spark: SparkSession, root: str, fmt: str = "parquet", text_keys: bool = True) -> DataFrame:
    """Files in key=value folders. Keys stay text, so 'YYYY-MM' is not read as a date."""
    key = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, str(not text_keys).lower())
    try:
        return spark.read.option("basePath", root).format(fmt).load(root)
    finally:
        spark.conf.set(key, before)


def last_partitions(df: DataFrame, column: str, today: Column, days: int = 30) -> DataFrame:
    """Only the last days of a date-partitioned table; the planner drops the other folders."""
    return df.filter((F.col(column) > F.date_sub(today, days)) & (F.col(column) <= today))


def match_columns(df: DataFrame, target: StructType) -> DataFrame:
    """Columns of a target schema by name, any case and order; missing ones are NULL, extra ones dropped."""
    own = {c.lower(): c for c in df.columns}
    return df.select(
        *[
            (F.col(own[f.name.lower()]) if f.name.lower() in own else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target.fields
        ]
    )


def stream_files(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet", pattern: str | None = None, per_batch: int | None = None) -> DataFrame:
    """File-source stream."""
    reader = spark.readStream.schema(schema).format(fmt)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if per_batch:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    return reader.load(path)


AUDIT_SCHEMA = "number long, rows long"


def read_loaded(spark: SparkSession, target: str, schema: StructType) -> DataFrame:
    """The rows of a table of ``load_new_files``."""
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(f"{target}/rows") if list_files(spark, f"{target}/rows", 1) else spark.createDataFrame([], schema)


def load_new_files(
    spark: SparkSession, source: str, target: str, checkpoint: str, schema: StructType, fmt: str = "parquet",
    pattern: str | None = None,
) -> dict[str, int]:
    """Append files not loaded before to a parquet table, each exactly once across runs.

    The stream's checkpoint is the ledger of files, and each of its batches owns a folder of the table and one of its audit, so a retried
    batch replaces both. Rows are observed while they are written: no run counts the table. Returns the files and rows of this run and the
    rows of the table, which are the sum of the audit's rows, one for each batch.
    """
    listed = f"{checkpoint}/sources/0"

    def files() -> int:
        if not list_files(spark, listed, 1):
            return 0
        paths = spark.read.text(listed).select(F.get_json_object("value", "$.path").alias("path"))
        return paths.filter(F.col("path").isNotNull()).distinct().count()

    def audited() -> DataFrame:
        return spark.read.schema(AUDIT_SCHEMA).option("recursiveFileLookup", True).parquet(f"{target}/audit") if list_files(spark, f"{target}/audit", 1) else spark.createDataFrame([], AUDIT_SCHEMA)

    done: list[int] = []

    def write(batch: DataFrame, number: int) -> None:
        rows = write_counted(batch, f"{target}/rows/batch={number}")
        batch.sparkSession.createDataFrame([(number, rows)], AUDIT_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{target}/audit/batch={number}")
        done.append(number)

    before = files()
    stream = stream_files(spark, source, schema, fmt, pattern).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    stream.trigger(availableNow=True).start().awaitTermination()
    own = F.coalesce(F.sum(F.when(F.col("number").isin(done), F.col("rows"))), F.lit(0)) if done else F.lit(0)
    loaded, total = audited().agg(own, F.coalesce(F.sum("rows"), F.lit(0))).first()
    return {"files_loaded": files() - before, "rows_loaded": loaded, "total_rows": total}


def load_audit(df: DataFrame) -> DataFrame:
    """Files and rows of a file-backed table."""
    per_file = df.select(F.col("_metadata.file_path").alias("f")).groupBy("f").agg(F.count(F.lit(1)).alias("n"))
    return per_file.agg(F.count(F.lit(1)).alias("files_loaded"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows_loaded"))


def page_rows(pages: DataFrame, array: str = "data") -> DataFrame:
    """Rows of saved API pages: the objects of each page's array."""
    return pages.select(F.inline(array))
