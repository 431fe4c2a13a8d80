"""Registered queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.session import configure, scratch_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Test tables as DataFrames, read on first use."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = configure(spark)
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))

    def scratch(self, label: str) -> str:
        return scratch_dir(self.spark, label)

    def stream(self, name: str) -> DataFrame:
        """A table as a file stream, whether it is one file or a folder of files."""
        schema = getattr(self, name).schema
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path(name))
        fs = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if fs.getFileStatus(path).isFile():
            reader = self.spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet")
            return reader.parquet(self.root)
        return self.spark.readStream.schema(schema).parquet(self.path(name))


def query(name: str, sql: str | None = None):
    """Register ``f(tables) -> DataFrame`` under a name, with an optional SQL twin."""

    def register(f: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, root: f(Tables(spark, root))
        if sql:
            ORACLES[name] = sql.strip()
        return f

    return register


def text(column: str, name: str | None = None):
    """A date or timestamp as text, which compares the same in both engines."""
    return F.col(column).cast("string").alias(name or column)
