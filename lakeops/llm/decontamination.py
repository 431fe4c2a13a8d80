"""Benchmark decontamination: which words of a document lie in a window of a benchmark item.

An exact containment join with prefix filtering. An item's windows are sets of words that a document must hold
in full, so a window's prefix is its rarest word alone: words are ordered by how often the documents hold them, and
documents meet only windows whose rarest word they hold. Where the word stands in the window and in the document fixes where
the window would begin; it must lie within the document (length and positional bound), its rarest and next rarest words must
stand in their places, and only then is the whole window compared.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.llm.common import in_small_batches, keep_texts, map_texts, own_columns, pieces, texts_of

WINDOW = 13
#: Windows that a task holds at once; a larger benchmark is taken in blocks of so many.
BLOCK = 200_000
#: Words are runs of these bytes of the UTF-8 text after lower-casing A-Z.
_WORD_BYTES = bytes(i for i in range(256) if not (i <= 0x2F or 0x3A <= i <= 0x60 or 0x7B <= i <= 0x7F))
_TO_WORDS = bytes(i if i in _WORD_BYTES else (i + 32 if 0x41 <= i <= 0x5A else 0x20) for i in range(256))


def words(text: bytes) -> list[bytes]:
    return text.translate(_TO_WORDS).split()


def windows(items: Iterator[tuple[str | None, bytes]], size: int) -> Iterator[tuple[str | None, tuple[bytes, ...]]]:
    """(item, window) for every run of ``size`` words; an item of fewer words, but not none, is one window."""
    for item, text in items:
        w = words(text)
        if w:
            for at in range(max(1, len(w) - size + 1)):
                yield item, tuple(w[at : at + size])


def word_frequencies(documents: DataFrame, vocabulary: set[bytes]) -> dict[bytes, int]:
    """How often the documents hold each word of the vocabulary. The result is no larger than the vocabulary."""
    known = documents.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        wanted, counts = known.value, Counter()
        for batch in batches:
            for _, raw in pieces(texts_of(batch.column(0))):
                for text in raw:
                    counts.update(filter(wanted.__contains__, words(text)))
        yield pa.RecordBatch.from_pydict({"word": list(counts), "n": list(counts.values())}, schema=pa.schema([("word", pa.binary()), ("n", pa.int64())]))

    counted = in_small_batches(own_columns(documents, "text")).mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {bytes(r["word"]): r["n"] for r in counted.toLocalIterator()}


def prefix_index(block: list[tuple[str, tuple[bytes, ...]]], frequency: dict[bytes, int]) -> dict:
    """{rarest word: {(offset of it, length, offset of the next rarest, that word, the window): items}} for the windows of a block."""
    index: dict = {}
    for item, window in block:
        order = sorted(range(len(window)), key=lambda i: (frequency.get(window[i], 0), window[i], i))
        first, second = order[0], order[min(1, len(order) - 1)]
        entry = (first, len(window), second, window[second], window)
        index.setdefault(window[first], {}).setdefault(entry, []).append(item)
    return {w: [(*e, tuple(dict.fromkeys(x for x in i if x is not None))) for e, i in held.items()] for w, held in index.items()}


def find_windows(text: list[bytes], index: dict) -> Iterator[tuple[int, int, tuple[str, ...]]]:
    """(first word, word after the last, items) of every occurrence of a window."""
    n = len(text)
    for at in [i for i, word in enumerate(text) if word in index]:
        for first, length, second, next_rare, window, items in index[text[at]]:
            start = at - first
            if start >= 0 and start + length <= n and text[start + second] == next_rare and tuple(text[start : start + length]) == window:
                yield start, start + length, items


class Finder:
    """Finds the windows of a benchmark in texts, inside tasks.

    The benchmark is read to the driver in blocks of ``block`` windows, each broadcast on its own, so neither a task nor a
    broadcast holds more than that; a task goes through the blocks for each piece of its texts.
    """

    def __init__(self, documents: DataFrame, benchmark: DataFrame, window: int, block: int) -> None:
        items = own_columns(benchmark, "item_id", "text").filter(F.col("text").isNotNull()).select(
            F.col("item_id").cast("string").alias("item_id"), F.encode("text", "UTF-8").alias("text")
        )
        pairs = windows(((r["item_id"], bytes(r["text"])) for r in items.toLocalIterator()), window)
        self.blocks = []
        while part := list(islice(pairs, block)):
            frequency = word_frequencies(documents, {w for _, x in part for w in x})
            self.blocks.append(documents.sparkSession.sparkContext.broadcast(prefix_index(part, frequency)))

    def __call__(self, raw: list[bytes]) -> list[tuple[int, int, list[str]]]:
        """(words, words hit, sorted items) of each text."""
        texts = [words(t) for t in raw]
        spans: list[list[tuple[int, int]]] = [[] for _ in texts]
        found: list[set[str]] = [set() for _ in texts]
        for held in self.blocks:
            index = held.value
            for i, text in enumerate(texts):
                for a, b, whose in find_windows(text, index):
                    spans[i].append((a, b))
                    found[i].update(whose)
            if len(self.blocks) > 1:
                held.__dict__.pop("_value", None)  # read again for the next piece, so that one block is held at a time
        return [(len(t), covered(s), sorted(x)) for t, s, x in zip(texts, spans, found, strict=True)]


def covered(spans: list[tuple[int, int]]) -> int:
    total, end = 0, 0
    for a, b in sorted(spans):
        total += max(0, b - max(a, end))
        end = max(end, b)
    return total


def is_contaminated(n_words: int, n_hit: int, one_in: int) -> bool:
    return n_hit > 0 and one_in * n_hit >= n_words


def benchmark_overlap(documents: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, block: int = BLOCK, one_in: int = 20) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items) for each row of ``documents``.

    A word is hit when it lies in an occurrence of a window of some item; ``items`` are the ids, as text and sorted, of the items with
    such windows. A document is contaminated when one in ``one_in`` of its words or more are hit, and not none.
    A NULL or empty text has no words. Items without words have no window; windows of an item without an id count for the words hit, but it is
    not among the items. Rows that repeat an item_id are one item with the windows of all its texts. Repeated documents are judged each.

    The documents are read once for the word frequencies and once for the search, and never shuffled.
    """
    find = Finder(documents, benchmark, window, block)

    def work(raw: list[bytes]) -> dict:
        made = find(raw)
        return {
            "n_words": [n for n, _, _ in made], "n_hit": [h for _, h, _ in made], "n_items": [len(x) for _, _, x in made],
            "items_sha256": [hashlib.sha256(",".join(x).encode()).hexdigest() for _, _, x in made],
            "contaminated": [is_contaminated(n, h, one_in) for n, h, _ in made], "items": [x for _, _, x in made],
        }

    adds = [("n_words", T.LongType()), ("n_hit", T.LongType()), ("n_items", T.LongType()), ("items_sha256", T.StringType()), ("contaminated", T.BooleanType()), ("items", T.ArrayType(T.StringType()))]
    return map_texts(own_columns(documents, "doc_id", "text"), work, adds)


def uncontaminated(documents: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, block: int = BLOCK, one_in: int = 20) -> DataFrame:
    """``documents`` without the contaminated rows, with its columns as they are; each row is judged by its own text."""
    find = Finder(documents, benchmark, window, block)
    return keep_texts(documents, lambda raw: [not is_contaminated(n, h, one_in) for n, h, _ in find(raw)])
