"""Exact token counts for every context limit from one histogram of encoded lengths.

Documents are encoded once and only their lengths are kept, aggregated to (length, documents). Suffix sums over the lengths
then answer totals, quantiles and totals of texts cut to any limit without reading a text again.
"""

from __future__ import annotations

import base64
from collections.abc import Sequence

import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.llm.common import map_texts, own_columns

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how the public byte-level vocabulary splits a text before it merges bytes.
SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Lengths are summed in blocks of so many, and the blocks after that.
BLOCK = 1_024

_ENCODINGS: dict[bytes, tiktoken.Encoding] = {}


def encoding(vocabulary: bytes) -> tiktoken.Encoding:
    """The tokenizer of a vocabulary file's content, kept by a worker."""
    if vocabulary not in _ENCODINGS:
        _ENCODINGS.clear()
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in vocabulary.splitlines() if line)}
        _ENCODINGS[vocabulary] = tiktoken.Encoding("vocabulary", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
    return _ENCODINGS[vocabulary]


def token_lengths(documents: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, n_tokens) for each row; 0 for a NULL or empty text. Special tokens count as ordinary text.

    The vocabulary file, of about a megabyte, is read by the driver and broadcast.
    """
    with open(vocabulary, "rb") as file:
        held = documents.sparkSession.sparkContext.broadcast(file.read())

    def work(raw: list[bytes]) -> dict:
        encode = encoding(held.value).encode_ordinary
        return {"n_tokens": [len(encode(t.decode("utf-8", "replace"))) for t in raw]}

    return map_texts(own_columns(documents, "doc_id", "text"), work, [("n_tokens", T.LongType())])


def length_histogram(lengths: DataFrame) -> DataFrame:
    """(n_tokens, docs): how many documents have each length."""
    return lengths.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("docs"))


def suffix_sums(histogram: DataFrame, block: int = BLOCK) -> DataFrame:
    """For each length: docs, docs_from (that long or longer), tokens_from (their tokens), tokens_cut (all texts cut to that length)
    and quantile (share of documents no longer). Empty for an empty histogram.

    Sums run inside blocks of lengths and over one row for each block, so no task holds all lengths.
    """
    rows = histogram.select("n_tokens", "docs", (F.col("n_tokens") * F.col("docs")).alias("_tokens"), F.expr(f"n_tokens div {int(block)}").alias("_block"))
    inside = Window.partitionBy("_block").orderBy(F.col("n_tokens").desc())
    after = Window.orderBy(F.col("_block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.col("_block").desc()).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = rows.groupBy("_block").agg(F.sum("docs").alias("_d"), F.sum("_tokens").alias("_t"))
    blocks = blocks.select(
        "_block", F.coalesce(F.sum("_d").over(after), F.lit(0)).alias("_docs_after"), F.coalesce(F.sum("_t").over(after), F.lit(0)).alias("_tokens_after"),
        F.sum("_d").over(whole).alias("_docs"), F.sum("_t").over(whole).alias("_all"),
    )
    sums = rows.select("*", F.sum("docs").over(inside).alias("_in"), F.sum("_tokens").over(inside).alias("_tin")).join(blocks, "_block")
    sums = sums.select("n_tokens", "docs", (F.col("_docs_after") + F.col("_in")).alias("docs_from"), (F.col("_tokens_after") + F.col("_tin")).alias("tokens_from"), "_docs", "_all")
    return sums.select(
        "n_tokens", "docs", "docs_from", "tokens_from", (F.col("_all") - F.col("tokens_from") + F.col("n_tokens") * F.col("docs_from")).alias("tokens_cut"),
        ((F.col("_docs") - F.col("docs_from") + F.col("docs")) / F.col("_docs")).alias("quantile"),
    )


def totals_at(sums: DataFrame, limits: Sequence[int]) -> DataFrame:
    """(context, docs_over, tokens_cut): for each limit the documents that are longer, and all tokens when texts are cut to it.

    The next length above a limit has all that is needed: what is longer keeps the limit's tokens, the rest is kept whole.
    """
    up = F.struct("n_tokens", "docs_from", "tokens_from")
    made = sums.agg(F.coalesce(F.max("tokens_from"), F.lit(0)).alias("_all"), *[F.min(F.when(F.col("n_tokens") > int(x), up)).alias(f"_{i}") for i, x in enumerate(limits)])
    rows = []
    for i, x in enumerate(limits):
        over = F.coalesce(F.col(f"_{i}.docs_from"), F.lit(0))
        cut = F.col("_all") - F.coalesce(F.col(f"_{i}.tokens_from"), F.lit(0)) + over * int(x)
        rows.append(F.struct(F.lit(int(x)).cast("long").alias("context"), over.alias("docs_over"), cut.alias("tokens_cut")))
    return made.select(F.explode(F.array(*rows)).alias("_r")).select("_r.*")


def length_quantiles(sums: DataFrame, shares: Sequence[float]) -> DataFrame:
    """(share, n_tokens): the smallest length that at least that share of the documents do not exceed."""
    made = sums.agg(*[F.min(F.when(F.col("quantile") >= float(s), F.col("n_tokens"))).alias(f"_{i}") for i, s in enumerate(shares)])
    return made.select(F.explode(F.array(*[F.struct(F.lit(float(s)).alias("share"), F.col(f"_{i}").alias("n_tokens")) for i, s in enumerate(shares)])).alias("_r")).select("_r.*")
