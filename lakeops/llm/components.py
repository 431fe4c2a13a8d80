"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.session import materialize


def between(links: DataFrame, groups: DataFrame) -> DataFrame:
    """The links (a, b) as links of groups, a < b, once each; those inside a group are left out. A key that is in none of the groups (key, group) is its own."""
    of = [groups.select(F.col("key").alias(end), F.col("group").alias(f"_{end}")) for end in ("a", "b")]
    ends = [F.coalesce(f"_{end}", end) for end in ("a", "b")]
    met = links.join(of[0], "a", "left").join(of[1], "b", "left")
    return met.select(F.least(*ends).alias("a"), F.greatest(*ends).alias("b")).filter("a < b").distinct()


def merged(groups: DataFrame, over: DataFrame) -> DataFrame:
    """(key, group) after ``over``, in the same columns, has put groups, or keys that are in none, into larger groups."""
    tops = over.select(F.col("key").alias("group"), F.col("group").alias("_top"))
    moved = groups.join(tops, "group", "left").select("key", F.coalesce("_top", "group").alias("group"))
    return moved.union(over.join(groups, "key", "left_anti").select("key", "group"))


def connected(links: DataFrame) -> DataFrame:
    """(key, group) for each end of the links (a, b): group is the smallest key that can be reached.

    Each round hooks every node to its smallest neighbour, follows the hooks to their ends and takes these as the next round's nodes. Links that
    have come to lie inside a group are dropped and those between the same groups become one, so at most half of the nodes go on and rounds
    get smaller. Hooks are followed by doubling: long chains need a number of steps that grows with the logarithm of their length. Each step is written
    to the shared folder.
    """
    known = links.filter(F.col("a").isNotNull() & F.col("b").isNotNull())
    edges = materialize(known.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "component_edges")
    groups = None
    while True:
        ends = edges.select(F.col("b").alias("key"), "a").union(edges.select("a", "a"))
        hooks = ends.groupBy("key").agg(F.min("a").alias("group"))
        while True:
            above = hooks.select(F.col("key").alias("group"), F.col("group").alias("_over"))
            higher = materialize(hooks.join(above, "group").select("key", F.col("group").alias("was"), F.col("_over").alias("group")), "component_hooks")
            hooks = higher.select("key", "group")
            if higher.filter(F.col("group") != F.col("was")).isEmpty():
                break
        groups = hooks if groups is None else materialize(merged(groups, hooks), "component_groups")
        edges = materialize(between(edges, hooks), "component_edges")
        if edges.isEmpty():
            return groups
