"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every operator assumes. All can be changed at run time.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

#: Small shuffle partitions are joined up to this many bytes. Of narrow rows of keys and numbers, the default of 64 MB is so many that a task's sort and hash tables take gigabytes.
PARTITION_BYTES = 16 * 1024 * 1024
ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def _bytes(size: str) -> int:
    """A size as Spark writes them, such as 64MB or 8m."""
    number, unit = re.fullmatch(r"\s*(\d+)\s*([kmgtp]?)b?\s*", size.lower()).groups()
    return int(number) * 1024 ** " kmgtp".index(unit or " ")


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to an existing session; a smaller size of shuffle partitions stays."""
    if _bytes(spark.conf.get(ADVISORY)) > PARTITION_BYTES:
        spark.conf.set(ADVISORY, f"{PARTITION_BYTES}b")
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(
    cpus: str | int = "*", shuffle_partitions: int = 8, memory: str = "8g", settings: dict[str, str] | None = None
) -> SparkSession:
    """A single-machine session for tests and benches."""
    spark = (
        SparkSession.builder.config(map=settings or {})
        .master(f"local[{cpus}]")
        .appName("lakeops")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master, where all tasks share
    one disk, falls back to a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        return tempfile.mkdtemp(prefix=f"lakeops-{label}-")
    return f"{root.rstrip('/')}/lakeops/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove what this application has written to the shared scratch folder, once no result is read from it any more."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        own = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/lakeops/{spark.sparkContext.applicationId}")
        own.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(own, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write a result to the shared scratch folder and read it back.

    For results that a plan would otherwise compute several times. The written table also cuts the
    lineage, so a lost executor does not start the work over.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
