"""Registered queries of this subpackage, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.queries.registry import Tables
from lakeops.session import materialize

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``f(tables) -> DataFrame`` under a name, with an optional SQL twin."""

    def register(f: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, root: f(Tables(spark, root))
        if sql:
            ORACLES[name] = sql.strip()
        return f

    return register


def old_shard(shards: int = 12):
    """The layout before: all documents of a source lie in one shard, so a hot source makes a large one."""
    return F.pmod(F.xxhash64("source"), F.lit(shards)).cast("int")


@query("op1_hyperdimensional_language")
def op1(t: Tables) -> DataFrame:
    from lakeops.llm.language import fit_languages, identify_languages

    return identify_languages(t.documents, fit_languages(t.documents))


@query("op2_checked_personal_data")
def op2(t: Tables) -> DataFrame:
    from lakeops.llm.personal_data import personal_data

    return personal_data(t.documents).drop("found")


@query("op3_imatch_fingerprints")
def op3(t: Tables) -> DataFrame:
    from lakeops.llm.imatch import edited_fingerprints

    return edited_fingerprints(t.documents)


@query("op4_token_length_histogram")
def op4(t: Tables) -> DataFrame:
    from lakeops.llm.token_histogram import length_histogram, suffix_sums, token_lengths

    return suffix_sums(materialize(length_histogram(token_lengths(t.documents)), "token_histogram"))


@query("op5_min_cost_flow_reshard")
def op5(t: Tables) -> DataFrame:
    from lakeops.llm.common import hash_slice
    from lakeops.llm.resharding import reshard

    text = F.coalesce("text", F.lit(""))
    rows = t.documents.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), old_shard().alias("old_shard"),
        F.xxhash64("doc_id", "text").alias("_order"),
    ).withColumn("_slice", hash_slice(F.col("_order")))
    placed = reshard(rows, 16, old="old_shard", size="size", slice_by="_slice", order=["_order", "doc_id", "size", "text_crc32"])
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "old_shard", "moved"
    )


OP6_SQL = r"""
with dw as (
  select doc_id, rid, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') w
  from (select doc_id, row_number() over () rid, coalesce(text, '') "text" from documents)),
bw as (
  select cast(item_id as varchar) item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') w
  from benchmark where text is not null),
win as (
  select distinct item, least(13, len(w)) k, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') g
  from (select item, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) i from bw where len(w) > 0)),
occ as (
  select d.rid, d.i, d.k, win.item
  from (select rid, k, i, array_to_string(w[i:i + k - 1], ' ') g
        from (select rid, w, k, unnest(range(1, len(w) - k + 2)) i from dw, (select distinct k from win) where len(w) >= k)) d
  join win on win.k = d.k and win.g = d.g),
hit as (select rid, count(distinct p) n from (select rid, unnest(range(i, i + k)) p from (select distinct rid, i, k from occ)) group by rid),
its as (select rid, count(item) n, string_agg(item, ',' order by item) s from (select distinct rid, item from occ) group by rid)
select doc_id, cast(len(w) as bigint) n_words, coalesce(hit.n, 0) n_hit, coalesce(its.n, 0) n_items, sha256(coalesce(its.s, '')) items_sha256,
  coalesce(hit.n, 0) > 0 and 20 * coalesce(hit.n, 0) >= len(w) contaminated
from dw left join hit using (rid) left join its using (rid)
"""


@query("op6_prefix_filtered_decontamination", OP6_SQL)
def op6(t: Tables) -> DataFrame:
    from lakeops.llm.decontamination import benchmark_overlap

    return benchmark_overlap(t.documents, t.benchmark).drop("items")


@query("op7_dice_license_scan")
def op7(t: Tables) -> DataFrame:
    from lakeops.llm.licenses import license_passages

    return license_passages(t.documents).drop("passages")


@query("op8_compression_quality")
def op8(t: Tables) -> DataFrame:
    from lakeops.llm.quality import fit_quality, score_quality

    scored = score_quality(t.documents, fit_quality(t.documents, t.labels))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "size_difference")


@query("op9_pfair_mixing")
def op9(t: Tables) -> DataFrame:
    from lakeops.llm.mixing import mixed_order, source_weights

    return mixed_order(t.documents, source_weights(t.documents)).select("doc_id", "source", "block", "slot", "place")


OP10_SQL = r"""
with recursive w as (select doc_id, regexp_extract_all(lower(text), '(?:[a-z0-9]|[^\x00-\x7F])+') w from documents),
sh as (
  select doc_id, array_to_string(w[i:i + 4], ' ') g, count(*) c
  from (select doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) i from w where len(w) > 0) group by all),
n as (select doc_id, sum(c) n from sh group by 1),
shared as (select a.doc_id x, b.doc_id y, sum(least(a.c, b.c)) o from sh a join sh b on a.g = b.g and a.doc_id <> b.doc_id group by 1, 2),
link as (select x, y from shared join n a on a.doc_id = x join n b on b.doc_id = y where o >= 0.8 * (a.n + b.n - o)),
reach as (select doc_id, doc_id as top from documents union select reach.doc_id, link.y from reach join link on link.x = reach.top),
class as (select doc_id, min(top) as class_id from reach group by 1)
select doc_id, class_id, count(*) over (partition by class_id) as n_copies from class
"""


@query("op10_bag_minhash", OP10_SQL)
def op10(t: Tables) -> DataFrame:
    from lakeops.llm.bagminhash import near_duplicates

    return near_duplicates(t.documents)


OP11_SQL = r"""
with d as (select row_number() over () rid, doc_id, string_split(coalesce(text, ''), chr(10)) ls from documents),
l as (
  select rid, doc_id, i, ls[i] line, translate(trim(ls[i], concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') k
  from (select rid, doc_id, ls, unnest(range(1, len(ls) + 1)) i from d)),
f as (select k, min(doc_id) keeper from l where length(k) >= 10 group by k having count(distinct doc_id) >= 2),
m as (select rid, doc_id, i, line, keeper is not null and keeper <> doc_id gone from l left join f using (k))
select any_value(doc_id) doc_id, count(*) n_lines, count(*) filter (gone) n_dropped, sha256(coalesce(string_agg(line, chr(10) order by i) filter (not gone), '')) kept_sha256
from m group by rid
"""


@query("op11_range_line_dedup", OP11_SQL)
def op11(t: Tables) -> DataFrame:
    from lakeops.llm.line_dedup import deduplicated_lines

    return deduplicated_lines(t.documents).select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@query("op12_spelling_variants")
def op12(t: Tables) -> DataFrame:
    from lakeops.llm.spelling import spelling_variants, vocabulary

    return spelling_variants(materialize(vocabulary(t.documents), "spelling_words"))


@query("op13_grammar_runs")
def op13(t: Tables) -> DataFrame:
    from lakeops.llm.grammar_runs import periodic_runs

    checksum = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    top = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    found = periodic_runs(t.documents, seed=checksum).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), top.alias("_top"), F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")
    )
    return found.select(
        "doc_id", "n_runs", (-F.col("_top.start")).alias("start"), F.col("_top.length").alias("length"), (-F.col("_top.period")).alias("period"),
        F.expr("1000 * _top.length div -_top.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )


@query("pipeline")
def pipeline(t: Tables) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(t.spark, t.root)
