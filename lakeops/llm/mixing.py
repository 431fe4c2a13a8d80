"""Mixing sources to target weights with a Pfair schedule of their blocks.

Time is counted in slots of one block. In the fluid schedule every source that still has blocks is served at a rate in
proportion to its weight, so that block k (from 1) of source s ends at slot t(k / w) with t(v) = sum of min(w v, blocks) over
all sources: a line between two sources' ends. A block is released at floor(t((k - 1) / w)) and due at ceil(t(k / w)); each slot
takes the released block with the earliest deadline. On one machine that meets all deadlines, so after any number of
slots a source is less than one block from its exact share, however many sources there are. All of it is in whole numbers:
weights are rational and only brought to one denominator.
"""

from __future__ import annotations

import heapq
from bisect import bisect_right
from collections.abc import Iterator, Mapping
from fractions import Fraction
from itertools import islice
from math import lcm

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import hash_slice, numbered, packed
from lakeops.session import materialize

BLOCK_ROWS = 32


class Fluid:
    """The fluid schedule of sources with (weight, blocks), both positive: where each block of each source ends."""

    def __init__(self, sources: Mapping[str, tuple[float, int]]) -> None:
        exact = {s: Fraction(w) for s, (w, _) in sources.items()}
        scale = lcm(*[w.denominator for w in exact.values()])
        self.weight = {s: int(w * scale) for s, w in exact.items()}
        self.blocks = {s: n for s, (_, n) in sources.items()}
        #: Ends of the sources in virtual time, as blocks / weight, and from each the line (done, rate): t(v) = done + rate v.
        ending = sorted(sources, key=lambda s: Fraction(self.blocks[s], self.weight[s]))
        self.ends = [(self.blocks[s], self.weight[s]) for s in ending]
        self.near = [n / w for n, w in self.ends]
        self.lines = [(0, sum(self.weight.values()))]
        for n, w in self.ends:
            done, rate = self.lines[-1]
            self.lines.append((done + n, rate - w))

    def end(self, source: str, k: int) -> tuple[int, int]:
        """(floor, ceil) of the slot at which ``k`` blocks of the source are done."""
        w = self.weight[source]
        at = bisect_right(self.near, k / w)
        while at > 0 and self.ends[at - 1][0] * w > k * self.ends[at - 1][1]:  # what the search in floats got wrong
            at -= 1
        while at < len(self.ends) and self.ends[at][0] * w <= k * self.ends[at][1]:
            at += 1
        done, rate = self.lines[at]
        return done + rate * k // w, done - (-rate * k // w)


def exact_schedule(sources: Mapping[str, tuple[float, int]]) -> Iterator[tuple[str, int]]:
    """(source, its how manieth block from 0) of slot after slot, for sources with (weight, blocks); ties go to the smaller source.

    One waiting block of each source is held, whatever their number.
    """
    fluid = Fluid(sources)
    due = {s: fluid.end(s, 1)[1] for s in sources}
    ready = [(due[s], s, 0) for s in sources]
    heapq.heapify(ready)
    waiting: list[tuple[int, int, str, int]] = []
    for slot in range(sum(fluid.blocks.values())):
        while waiting and waiting[0][0] <= slot:
            _, end, s, k = heapq.heappop(waiting)
            heapq.heappush(ready, (end, s, k))
        _, source, k = heapq.heappop(ready)
        yield source, k
        if k + 1 < fluid.blocks[source]:
            heapq.heappush(waiting, (fluid.end(source, k + 1)[0], fluid.end(source, k + 2)[1], source, k + 1))


def source_weights(documents: DataFrame, power: float = 0.5) -> DataFrame:
    """(source, weight): rows of each source to a power under 1, which raises small sources; a NULL source is one of its own."""
    return documents.groupBy("source").agg(F.pow(F.count(F.lit(1)), F.lit(power)).alias("weight"))


def exact_slots(blocks: DataFrame) -> DataFrame:
    """(source, block, slot) from (source, weight, blocks): the exact schedule of all blocks, made in one task and streamed out of it.

    It holds a block per source; a source that runs out leaves its slots to the others, which keep their weights relative to each other.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sources = {s: (w, int(n)) for part in parts for s, w, n in zip(part["source"], part["weight"], part["blocks"], strict=True)}
        made = enumerate(exact_schedule(sources)) if sources else iter(())
        while some := list(islice(made, 10_000)):
            yield pd.DataFrame([(s, k, slot) for slot, (s, k) in some], columns=["source", "block", "slot"])

    return blocks.coalesce(1).mapInPandas(run, "source string, block long, slot long")


def mixed_order(documents: DataFrame, weights: DataFrame, *, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(doc_id, source, block, slot, place) for each row of ``documents``: the row's block, the block's slot, its place in the block.

    ``weights`` is (source, weight), bounded by the number of sources. Within a source rows go by a hash of id and text, so a block is a
    random part of its source; all its blocks but the last have ``block_rows`` rows. Sources without a positive weight come after all
    others, in equal shares. A NULL source is a source. Repeated rows and ids each have their own place. No row is dropped.
    """
    given = {r["source"]: float(r["weight"] or 0) for r in weights.select("source", "weight").toLocalIterator()}
    name = {s: ("s" + s if s is not None else "n") for s in given}
    label = F.when(F.col("source").isNull(), "n").otherwise(F.concat(F.lit("s"), "source"))
    rows = documents.select("doc_id", "source", label.alias("_source"), F.xxhash64("text").alias("text_hash"))
    rows = rows.withColumn("_order", F.xxhash64("doc_id", "text_hash")).withColumn("_slice", hash_slice(F.col("_order")))
    rows = materialize(rows, "mix_rows")
    placed = numbered(rows, ["_source"], "_slice", ["_order", "doc_id", "text_hash"])
    placed = placed.withColumn("_block", F.expr(f"_rank div {int(block_rows)}")).withColumn("place", F.col("_rank") % block_rows)
    spark = documents.sparkSession
    blocks = rows.groupBy(F.col("_source").alias("source")).agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("long").alias("blocks"))
    blocks = materialize(blocks, "mix_blocks")
    found = {r["source"]: r["blocks"] for r in blocks.toLocalIterator()}
    of = {name[s]: w for s, w in given.items()}
    weighed = {s: of[s] for s in found if of.get(s, 0) > 0}
    rest = {s: 1.0 for s in found if s not in weighed}
    out = spark.createDataFrame([], "source string, block long, slot long")
    for weight, first in ((weighed, 0), (rest, sum(found[s] for s in weighed))):
        if weight:
            table = spark.createDataFrame([(s, w, found[s]) for s, w in sorted(weight.items())], "source string, weight double, blocks long")
            out = out.union(exact_slots(table).withColumn("slot", F.col("slot") + first))
    out = materialize(out, "mix_slots")
    slots = out.select(F.col("source").alias("_source"), F.col("block").alias("_block"), "slot")
    return placed.join(slots, ["_source", "_block"]).select("doc_id", "text_hash", "source", F.col("_block").alias("block"), "slot", "place")


def mixed_documents(documents: DataFrame, weights: DataFrame, **parameters) -> DataFrame:
    """``documents`` with their columns as they are, in mixed order: written as files, they follow the schedule from file to file.

    Rows that repeat both id and text stand together at the place of the first.
    """
    places = mixed_order(documents, weights, **parameters).groupBy("doc_id", "text_hash").agg(F.min(F.struct("slot", "place")).alias("_at"))
    places = places.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("_at.slot").alias("_slot"), F.col("_at.place").alias("_place"))
    rows = packed(documents, "doc_id", F.xxhash64("text").alias("text_hash"))
    met = rows.join(places, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")))
    return met.repartitionByRange(F.col("_slot"), F.col("_place")).sortWithinPartitions("_slot", "_place").select("_row.*")
