"""The corpus pipeline: quality, near duplicates, benchmark decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and returns a DataFrame, which is written as Parquet
and read again as the next one's docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from lakeops.llm.bagminhash import keep_one
from lakeops.llm.common import numbered, packed
from lakeops.llm.decontamination import uncontaminated
from lakeops.llm.mixing import mixed_documents, source_weights
from lakeops.llm.quality import fit_quality, good_documents
from lakeops.llm.resharding import reshard
from lakeops.session import materialize

#: Runs that the mix is in before it is sharded.
OLD_SHARDS = 12
#: No SQL: the stages compress, schedule and solve a flow.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones among them, scores 0.3 or more."""
    return good_documents(docs, fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than one word in 20 lies in a window of the benchmark."""
    return uncontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the schedule: written as Parquet, the files and their rows follow it."""
    return mixed_documents(docs, source_weights(docs))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their shard of 16, their slot in it and their ``mix_position``, from 0 in the order of files and rows.

    The layout before is the mix cut into 12 runs of near equal bytes, so every shard is made of runs of the mix, each with the weights that
    the schedule has there, and its slots follow the mix over all of them. Columns of docs that are named like an added one are replaced.
    """
    try:
        docs.select("_metadata.row_index")
    except AnalysisException:  # not read from files
        docs = materialize(docs, "shard_docs")
    path = F.col("_metadata.file_path")
    # The number of a part file counts, not its text: from 100,000 files on numbers have six digits.
    part = F.coalesce(F.regexp_extract(path, r"/part-([0-9]{1,9})[^/]*$", 1).try_cast("int"), F.lit(-1))
    rows = docs.select(
        path.alias("_file"), part.alias("_part"), F.col("_metadata.row_index").alias("_row"), F.lit(0).alias("_all"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
    )
    rows = materialize(numbered(materialize(rows, "shard_rows"), ["_all"], "_part", ["_file", "_row"], {"_at": "size"}), "shard_line")
    total = rows.agg(F.sum("size")).first()[0] or 1
    rows = rows.select("_file", "_part", "_row", "size", F.col("_rank").alias("mix_position"), F.floor(F.col("_at") / F.lit(total) * OLD_SHARDS).cast("int").alias("old_shard"))
    rows = rows.withColumn("old_shard", F.least("old_shard", F.lit(OLD_SHARDS - 1)))
    placed = reshard(rows, 16, old="old_shard", size="size", slice_by="_part", order=["_file", "_row"], in_runs=True).drop("_part")
    whole = packed(docs, F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row_index"))
    added = ["size", "mix_position", "old_shard", "moved", "shard", "slot"]
    met = whole.join(placed.withColumnRenamed("_row", "_row_index"), ["_file", "_row_index"])
    return met.select(*[F.col(f"_row.`{c}`") for c in docs.columns if c not in added], *added)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate), ("mix", mix), ("shard", shard)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, one after the other; each result but the last is written to the shared folder and read back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
