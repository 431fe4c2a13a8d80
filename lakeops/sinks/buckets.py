"""Tables kept in key buckets: a run reads and rewrites only the buckets that its keys fall in.

A run writes the whole content of its buckets to ``root/v=<version>/_bucket=<number>`` and then creates a commit file; a bucket's rows are
those of its newest committed version. Buckets that a run does not touch keep their files. A run that is repeated, or was broken off, reads
the versions before its own and writes its folder anew. Folders that an earlier run has superseded are removed after a commit, so those who
are still reading the version before lose nothing.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeops.sinks.tables import _fs, clustered

BUCKET = "_bucket"
COMMITTED = "_COMMITTED"


def folders(spark: SparkSession, root: str, prefix: str) -> dict[int, str]:
    """{number: path} of the folders ``<prefix><number>`` in root."""
    fs, path = _fs(spark, root)
    if not fs.exists(path):
        return {}
    names = [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()]
    return {int(n.removeprefix(prefix)): f"{root}/{n}" for n in names if n.startswith(prefix)}


def remove(spark: SparkSession, path: str) -> None:
    fs, jpath = _fs(spark, path)
    fs.delete(jpath, True)


def commit(spark: SparkSession, path: str) -> None:
    """Create the commit file of a version's folder."""
    fs, mark = _fs(spark, f"{path}/{COMMITTED}")
    fs.create(mark, True).close()


def is_committed(spark: SparkSession, path: str) -> bool:
    fs, mark = _fs(spark, f"{path}/{COMMITTED}")
    return fs.exists(mark)


@dataclass(frozen=True)
class KeyBuckets:
    """``schema`` are the rows' columns; ``keys`` some of them, NULL is a key like any other. Lists of buckets have ``buckets`` numbers at most."""

    spark: SparkSession
    root: str
    schema: StructType
    keys: Sequence[str]
    buckets: int = 64

    def bucket(self) -> Column:
        """The bucket of a row, by its keys as the table's types."""
        return F.pmod(F.xxhash64(*[F.col(k).cast(self.schema[k].dataType) for k in self.keys]), F.lit(self.buckets)).cast("int")

    def touched(self, rows: DataFrame) -> list[int]:
        return sorted(r[0] for r in rows.select(self.bucket()).distinct().collect())

    def committed(self, before: int | None = None) -> dict[int, str]:
        """{version: folder} of the committed versions, older than ``before`` if given."""
        found = folders(self.spark, self.root, "v=")
        return {v: p for v, p in found.items() if (before is None or v < before) and is_committed(self.spark, p)}

    def current(self, before: int | None = None) -> dict[int, str]:
        """{bucket: folder} of each bucket's newest version."""
        out: dict[int, str] = {}
        for _, path in sorted(self.committed(before).items()):
            out |= folders(self.spark, path, f"{BUCKET}=")
        return out

    def read(self, only: Iterable[int] | None = None, before: int | None = None) -> DataFrame:
        """The table's rows, of some buckets only if given."""
        wanted = None if only is None else set(only)
        paths = [p for b, p in sorted(self.current(before).items()) if wanted is None or b in wanted]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def write(self, rows: DataFrame, touched: Sequence[int], version: int) -> None:
        """Commit ``rows`` as the whole content of the touched buckets."""
        earlier = self.committed(before=version)
        kept = self.current(before=version)
        path = f"{self.root}/v={version}"
        remove(self.spark, path)
        clustered(rows.withColumn(BUCKET, self.bucket()), [BUCKET]).write.mode("append").partitionBy(BUCKET).parquet(path)
        for empty in set(touched) - set(folders(self.spark, path, f"{BUCKET}=")):
            self.spark.createDataFrame([], self.schema).write.parquet(f"{path}/{BUCKET}={empty}")
        commit(self.spark, path)
        for folder in earlier.values():
            held = folders(self.spark, folder, f"{BUCKET}=")
            old = [p for b, p in held.items() if kept[b] != p]
            for p in [folder] if len(old) == len(held) else old:
                remove(self.spark, p)
