"""Resharding with the fewest moved bytes.

A minimum-cost flow from the old shards' sizes to the new shards' capacities, where staying costs nothing and moving a byte
costs one (or what the caller states), says how many bytes go from which old shard to which new one. Each old shard is a
line of rows that the flow cuts into pieces; a cut inside a row goes to the side that keeps the new sizes closest to their
capacities. The flow has as many nodes as there are shards; the rows are only cut and numbered by Spark.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.llm.common import numbered
from lakeops.session import materialize
from lakeops.sinks.buckets import commit, folders, is_committed, remove


def equal_capacities(total: int, shards: int) -> list[int]:
    return [total * (j + 1) // shards - total * j // shards for j in range(shards)]


def minimum_cost_flow(supply: Sequence[int], demand: Sequence[int], cost: Callable[[int, int], int]) -> dict[tuple[int, int], int]:
    """{(i, j): amount} that takes all supplies to the demands at the least cost: successive shortest augmenting paths."""
    if sum(supply) != sum(demand):
        raise ValueError("supplies and demands must have the same sum")
    n, m = len(supply), len(demand)
    left, need = list(supply), list(demand)
    flow: dict[tuple[int, int], int] = {}
    while any(left):
        # Bellman-Ford over old shards 0..n-1 and new shards n..n+m-1.
        distance: list[float] = [0 if left[i] else float("inf") for i in range(n)] + [float("inf")] * m
        parent = [-1] * (n + m)
        changed = True
        while changed:
            changed = False
            for i in range(n):
                for j in range(m):
                    c = cost(i, j)
                    if distance[i] + c < distance[n + j]:
                        distance[n + j], parent[n + j], changed = distance[i] + c, i, True
                    if flow.get((i, j)) and distance[n + j] - c < distance[i]:
                        distance[i], parent[i], changed = distance[n + j] - c, n + j, True
        end = min((j for j in range(m) if need[j]), key=lambda j: (distance[n + j], j))
        path, at = [], n + end
        while parent[at] >= 0:
            path.append((parent[at], at))
            at = parent[at]
        amount = min([left[at], need[end], *[flow[(b, a - n)] for a, b in path if a >= n]])
        for a, b in path:
            if a < n:
                flow[(a, b - n)] = flow.get((a, b - n), 0) + amount
            else:
                flow[(b, a - n)] -= amount
        left[at] -= amount
        need[end] -= amount
    return {k: v for k, v in flow.items() if v}


def settle_cuts(cuts: list[dict], shards: int) -> None:
    """Give each cut {left, right, low, high, at} its ``end``, low or high, so that the new shards stay near their capacities."""
    error = [0] * shards

    def turn(cut: dict, end: int) -> None:
        change = end - cut.get("end", cut["at"])
        error[cut["left"]] += change
        error[cut["right"]] -= change
        cut["end"] = end

    for _ in range(10):
        changed = False
        for cut in cuts:
            was = cut.get("end")
            costs = {}
            for end in (cut["low"], cut["high"]):
                change = end - cut.get("end", cut["at"])
                a, b = error[cut["left"]], error[cut["right"]]
                costs[end] = (a + change) ** 2 + (b - change) ** 2
            best = min(sorted(costs), key=costs.get)
            if best != was:
                turn(cut, best)
                changed = True
        if not changed:
            return


def reshard(
    rows: DataFrame, new_shards: int, *, old: str, size: str, slice_by: str, order: Sequence[str], cost: Callable[[int, int], int] | None = None,
    in_runs: bool = False,
) -> DataFrame:
    """Add ``shard`` (from 0), ``slot`` (gapless from 0 in its shard) and ``moved`` to narrow rows that have an old shard and a size.

    ``old`` holds the old shard as a number from 0 without NULLs, ``size`` a positive number of bytes. Rows keep to the order of
    (``slice_by``, ``order``) within their old shard, so a piece that stays or moves is a run of it. New capacities are equal to a byte;
    a shard misses its capacity by parts of the rows at its cuts only. The law is that sizes in bytes are near equal.
    Slots take the piece that stays first and then the others by old shard; with ``in_runs`` the old shards are consecutive runs of one
    order, by their numbers, and slots follow that order over all pieces of a shard.
    An empty table gives no rows; rows that tie in everything are alike. The driver holds a number for each pair of shards with a flow.
    """
    cost = cost or (lambda i, j: 0 if i == j else 1)
    rows = materialize(rows, "reshard_rows")
    line = materialize(numbered(rows, [old], slice_by, order, {"_from": size}), "reshard_line")
    sizes = {r[old]: (r["b"], r["n"]) for r in rows.groupBy(old).agg(F.sum(size).alias("b"), F.count(F.lit(1)).alias("n")).toLocalIterator()}
    olds = sorted(sizes)
    flow = minimum_cost_flow([sizes[i][0] for i in olds], equal_capacities(sum(b for b, _ in sizes.values()), new_shards), lambda a, j: cost(olds[a], j))
    goes: dict[int, list[tuple[int, int]]] = {}
    for (a, j), amount in sorted(flow.items(), key=lambda x: (x[0][0], olds[x[0][0]] != x[0][1], x[0][1])):
        goes.setdefault(olds[a], []).append((j, amount))
    cuts = []
    for i, parts in goes.items():
        at = 0
        for (j, amount), (then, _) in zip(parts, parts[1:], strict=False):
            at += amount
            cuts.append({"old": i, "at": at, "left": j, "right": then, "low": at, "high": at})
    spark = rows.sparkSession
    if cuts:
        where = spark.createDataFrame([(c["old"], c["at"]) for c in cuts], T.StructType([T.StructField("_old", rows.schema[old].dataType), T.StructField("_at", T.LongType())]))
        # At most a row for each pair of shards with a flow.
        hit = line.join(F.broadcast(where), (F.col(old) == F.col("_old")) & (F.col("_from") < F.col("_at")) & (F.col("_from") + F.col(size) > F.col("_at")))
        found = {(r["_old"], r["_at"]): (r["low"], r["high"]) for r in hit.select("_old", "_at", F.col("_from").alias("low"), (F.col("_from") + F.col(size)).alias("high")).collect()}
        for c in cuts:
            c["low"], c["high"] = found.get((c["old"], c["at"]), (c["at"], c["at"]))
        settle_cuts(cuts, new_shards)
    ends = {}
    for c in cuts:
        ends.setdefault(c["old"], []).append(c["end"])
    pieces = []
    for i, parts in goes.items():
        stops = [*ends.get(i, []), sizes[i][0]]
        pieces += [(i, low, high, j) for (j, _), low, high in zip(parts, [0, *stops], stops, strict=False) if low < high]
    number = rows.schema[old].dataType
    table = spark.createDataFrame(pieces, T.StructType([T.StructField("_old", number), T.StructField("_low", T.LongType()), T.StructField("_high", T.LongType()), T.StructField("shard", T.IntegerType())]))
    placed = line.join(F.broadcast(table), (F.col(old) == F.col("_old")) & (F.col("_from") >= F.col("_low")) & (F.col("_from") < F.col("_high")))
    counts = {(r[old], r["_low"]): (r["first"], r["n"]) for r in placed.groupBy(old, "_low").agg(F.min("_rank").alias("first"), F.count(F.lit(1)).alias("n")).collect()}
    held, slots = [0] * new_shards, []
    for i, low, _, j in sorted(pieces, key=lambda p: (p[3], not in_runs and p[0] != p[3], p[0], p[1])):
        first, n = counts.get((i, low), (0, 0))
        slots.append((i, low, held[j] - first))
        held[j] += n
    offsets = spark.createDataFrame(slots, T.StructType([T.StructField("_o", number), T.StructField("_l", T.LongType()), T.StructField("_shift", T.LongType())]))
    out = placed.join(F.broadcast(offsets), (F.col(old) == F.col("_o")) & (F.col("_low") == F.col("_l")))
    return out.select(*rows.columns, "shard", (F.col("_rank") + F.col("_shift")).alias("slot"), (F.col(old) != F.col("shard")).alias("moved"))


def affected_shards(placed: DataFrame, old: str) -> DataFrame:
    """(shard): new shards whose file changes, because rows leave or reach it. The others keep their files."""
    moved = placed.filter("moved")
    return moved.select("shard").union(moved.select(F.col(old).cast("int"))).distinct()


def rewrite_shards(documents: DataFrame, path: str, affected: DataFrame, version: int) -> None:
    """Write the affected shards of ``documents``, which have ``shard`` and ``slot``, as a new version below ``path``; files of other shards stay.

    A shard that has no rows any more becomes an empty folder of the version. The version counts once its commit file is there, so a run
    that breaks off changes nothing and can be repeated; ``read_shards`` takes the newest committed version of each shard. Each shard is spread over
    tasks by runs of slots, whose files follow each other by name.
    """
    spark, root = documents.sparkSession, f"{path}/v={version}"
    some = documents.join(F.broadcast(affected), "shard", "left_semi")  # a row for each shard at most
    tuned = some.repartitionByRange(F.col("shard"), F.col("slot")).sortWithinPartitions("shard", "slot")
    remove(spark, root)
    tuned.write.mode("append").partitionBy("shard").parquet(root)
    for empty in {r[0] for r in affected.collect()} - set(folders(spark, root, "shard=")):
        spark.createDataFrame([], documents.drop("shard").schema).write.parquet(f"{root}/shard={empty}")
    commit(spark, root)


def read_shards(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The documents of all shards, each from its newest committed version; ``schema`` has ``shard`` as well."""
    newest: dict[int, str] = {}
    for _, root in sorted(folders(spark, path, "v=").items()):
        if is_committed(spark, root):
            newest |= folders(spark, root, "shard=")
    inner = T.StructType([f for f in schema.fields if f.name != "shard"])
    out = spark.createDataFrame([], schema)
    for shard, folder in sorted(newest.items()):
        out = out.unionByName(spark.read.schema(inner).parquet(folder).withColumn("shard", F.lit(shard)))
    return out
