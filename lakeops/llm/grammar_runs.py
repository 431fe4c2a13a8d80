"""Periodic runs of words, found on a Re-Pair grammar of each text.

The word ids of a text are compressed by pairs: in each round every pair of neighbours that occurs at least twice in its text becomes a
nonterminal, where occurrences overlap the more frequent pair goes first. What is left of a text, in which no pair occurs twice, is closed by a
balanced tree. A run lies over the boundary of the smallest nonterminal that holds it, so it is enough to find the runs over each nonterminal's boundary,
once per nonterminal, and to place them at all its positions in the derivation; runs that a nonterminal's ends have cut are merged into the whole ones.

Many texts are handled at once in arrays. Extents are compared by two polynomial hashes of 31 bits each.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.llm.common import in_small_batches, own_columns, pieces, texts_of
from lakeops.llm.shingles import mix

LEAST = 12
#: Candidate extents that are compared at once.
AT_ONCE = 500_000
_PRIMES = ((2147483647, 1103515245), (2147483629, 1220703125))


class Extents:
    """Longest common extents between places of an array of words."""

    def __init__(self, words: np.ndarray) -> None:
        self.tables = []
        n = len(words)
        for k, (prime, base) in enumerate(_PRIMES):
            powers = np.ones(1, np.uint64)
            step = base
            while len(powers) <= n:
                powers = np.concatenate([powers, powers * np.uint64(step) % np.uint64(prime)])
                step = step * step % prime
            letters = mix(words.astype(np.uint64) * np.uint64(2) + np.uint64(k)) % np.uint64(prime - 1) + np.uint64(1)
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(letters * powers[:n] % np.uint64(prime)) % np.uint64(prime)])
            self.tables.append((np.uint64(prime), powers, sums))

    def equal(self, i: np.ndarray, j: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        """Whether ``size`` words from i equal those from j, for i before j."""
        same = np.ones(len(i), bool)
        for prime, powers, sums in self.tables:
            left = (sums[i + size] + prime - sums[i]) % prime * powers[j - i] % prime
            same &= left == (sums[j + size] + prime - sums[j]) % prime
        return same

    def forward(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many words from i equal those from j, ``most`` at most."""
        return self._longest(i, j, most, 1)

    def backward(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many words before i equal those before j, ``most`` at most."""
        return self._longest(i, j, most, -1)

    def _longest(self, i: np.ndarray, j: np.ndarray, most: np.ndarray, way: int) -> np.ndarray:
        got = np.zeros(len(i), np.int64)
        step = 1 << int(most.max(initial=0)).bit_length()
        while step:
            can = np.flatnonzero(got + step <= most)
            at = got[can] if way > 0 else -got[can] - step
            fits = can[self.equal(i[can] + at, j[can] + at, step)]
            got[fits] += step
            step >>= 1
        return got


def grammar(symbols: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, ...]:
    """The derivation of every text: (nonterminal, start, middle, end, text) of each of its inner nodes.

    ``symbols`` are the words of consecutive texts, no symbol in two texts; ``text`` is the text of each.
    """
    start, n_symbols = np.arange(len(symbols)), int(symbols.max(initial=-1)) + 1
    end = start + 1
    nodes = []

    def replace(at: np.ndarray, made: np.ndarray) -> None:
        nonlocal symbols, text, start, end
        nodes.append((made, start[at], end[at], end[at + 1], text[at]))
        symbols, end = symbols.copy(), end.copy()
        symbols[at], end[at] = made, end[at + 1]
        stays = np.ones(len(symbols), bool)
        stays[at + 1] = False
        symbols, text, start, end = symbols[stays], text[stays], start[stays], end[stays]

    while len(symbols) > 1:
        beside = text[1:] == text[:-1]
        pair = np.where(beside, symbols[:-1] * n_symbols + symbols[1:], -1)
        kinds, which, often = np.unique(pair, return_inverse=True, return_counts=True)
        often[kinds < 0] = 0
        turn = np.empty(len(kinds), np.int64)
        turn[np.lexsort((mix(kinds.astype(np.uint64)), often))] = np.arange(1, len(kinds) + 1)
        again = (often >= 2)[which]
        if not again.any():
            break
        # Of the same pair over and over ("a a a a") every second one can go; of the others the one whose turn is later.
        chain = np.ones(len(pair), bool)
        chain[1:] = pair[1:] != pair[:-1]
        place = np.arange(len(pair))
        can = again & ((place - np.maximum.accumulate(np.where(chain, place, 0))) % 2 == 0)
        order = np.concatenate([[0], np.where(can, turn[which], 0), [0]])
        at = np.flatnonzero(can & (order[1:-1] > order[:-2]) & (order[1:-1] > order[2:]))
        chosen, made = np.unique(which[at], return_inverse=True)
        replace(at, n_symbols + made)
        n_symbols += len(chosen)
    while len(symbols) > 1:
        first = np.ones(len(text), bool)
        first[1:] = text[1:] != text[:-1]
        place = np.arange(len(text))
        odd = (place - np.maximum.accumulate(np.where(first, place, 0))) % 2 == 1
        at = np.flatnonzero(odd) - 1
        if not len(at):
            break
        replace(at, n_symbols + np.arange(len(at)))
        n_symbols += len(at)
    return tuple(np.concatenate(c) for c in zip(*nodes, strict=True)) if nodes else (np.empty(0, np.int64),) * 5


def boundary_runs(symbols: np.ndarray, ends: np.ndarray, start: np.ndarray, middle: np.ndarray, end: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, ...]:
    """(node, start, end, period) of the stretches that repeat with a period at least twice and over the middle of [start, end), cut at its ends.

    ``ends`` is the end of each place's text. A stretch of ``least`` words whose period is q has max(least - q, q) words, ``least`` / 2 or more, that equal
    the word q further on; so a quarter of ``least`` of these lie right before or right behind the middle or the place q before it. Other
    places of these few words inside the node give the periods to compare.
    """
    gram = max(1, least // 4)
    extents = Extents(symbols)
    size = len(symbols)
    grams = np.full(size, -1)
    whole = np.flatnonzero(np.arange(size) + gram <= ends)
    held = symbols[whole]
    for g in range(1, gram):
        _, held = np.unique(held * (int(symbols.max()) + 1) + symbols[whole + g], return_inverse=True)
    grams[whole] = held
    listed = whole[np.argsort(grams[whole], kind="stable")]
    keys = grams[listed] * (size + 1) + listed
    found = []
    for shift in (0, gram):
        anchor = middle - shift
        node = np.flatnonzero((anchor >= start) & (anchor + gram <= end))
        base = grams[anchor[node]] * (size + 1)
        low, high = np.searchsorted(keys, base + start[node]), np.searchsorted(keys, base + end[node] - gram, side="right")
        many = high - low
        edges = np.searchsorted(np.cumsum(many), np.arange(AT_ONCE, int(many.sum()) + AT_ONCE, AT_ONCE)) + 1
        for a, b in zip(np.concatenate([[0], edges[:-1]]), edges, strict=True):
            of = np.repeat(np.arange(a, min(b, len(node))), many[a:b])
            if not len(of):
                continue
            within = np.arange(len(of)) - np.repeat(np.cumsum(many[a:b]) - many[a:b], many[a:b])
            other, own, n = listed[low[of] + within], anchor[node[of]], node[of]
            apart = other != own
            i, j, n = np.minimum(other, own)[apart], np.maximum(other, own)[apart], n[apart]
            q = j - i
            ahead, behind = extents.forward(i, j, end[n] - j), extents.backward(i, j, i - start[n])
            runs = np.flatnonzero(ahead + behind >= np.maximum(q, least - q))
            found.append(np.stack([n[runs], i[runs] - behind[runs], j[runs] + ahead[runs], q[runs]]))
    if not found:
        return (np.empty(0, np.int64),) * 4
    return tuple(np.unique(np.concatenate(found, axis=1), axis=1))


def merged(start: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, ...]:
    """Maximal (start, end, period): parts of one period that overlap by it or more are one; of equal intervals the smallest period counts."""
    order = np.lexsort((-end, start, period))
    start, end, period = start[order], end[order], period[order]
    kind = np.cumsum(np.concatenate([[0], period[1:] != period[:-1]]))
    far = int(end.max(initial=0)) + 1
    reach = np.maximum.accumulate(end + kind * far) - kind * far
    new = np.ones(len(start), bool)
    new[1:] = (period[1:] != period[:-1]) | (start[1:] > reach[:-1] - period[1:])
    at = np.flatnonzero(new)
    start, end, period = start[at], np.maximum.reduceat(end, at) if len(at) else end, period[at]
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    first = np.ones(len(start), bool)
    first[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[first], end[first], period[first]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def runs_of(words: np.ndarray, offsets: np.ndarray, least: int = LEAST) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of all runs of consecutive texts, by start and period; text k has the word ids from offsets[k] to offsets[k + 1]."""
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(len(offsets) - 1)]
    # A run says some words twice; texts that say nothing of half its length twice have none and are not compressed.
    half = max(1, least // 2)
    if len(words) < least:
        return out
    grams = mix(text.astype(np.uint64))
    for g in range(half):
        grams = mix(grams + np.concatenate([words[g:], np.full(g, -1)]).astype(np.uint64))
    whole = np.arange(len(words)) + half <= offsets[text + 1]
    grams, of = grams[whole], text[whole]
    order = np.argsort(grams, kind="stable")
    twice = np.flatnonzero(grams[order][1:] == grams[order][:-1])
    picked = np.zeros(len(out), bool)
    picked[of[order[twice]]] = True
    kept = np.flatnonzero(picked[text])
    if not len(kept):
        return out
    words, text = words[kept], text[kept]
    _, symbols = np.unique(text * (int(words.max()) + 1) + words, return_inverse=True)
    bound = np.searchsorted(text, np.arange(len(out) + 1))
    kind, start, middle, end, _ = grammar(symbols, text)
    long = np.flatnonzero(end - start >= least)
    kind, start, middle, end = kind[long], start[long], middle[long], end[long]
    # Each nonterminal once, at its first position ...
    _, first, which = np.unique(kind, return_index=True, return_inverse=True)
    node, low, high, period = boundary_runs(symbols, bound[text + 1], start[first], middle[first], end[first], least)
    # ... and its runs at all of them.
    by = np.argsort(which, kind="stable")
    begins = np.searchsorted(which[by], np.arange(len(first) + 1))
    times = begins[node + 1] - begins[node]
    run = np.repeat(np.arange(len(node)), times)
    place = by[np.repeat(begins[node] - (np.cumsum(times) - times), times) + np.arange(len(run))]
    moved = start[place] - start[first][node[run]]
    low, high, period = merged(low[run] + moved, high[run] + moved, period[run])
    for k, s, e, q in zip(text[low], low, high, period, strict=True):
        out[k].append((int(s - bound[k]), int(e - s), int(q)))
    return out


def repeated_tail(n: int, seed: int) -> np.ndarray | None:
    """Which word stands at each of n places of a text whose tail is made periodic; None where the seed leaves it alone.

    Seeds that 10 divides change a text: with g = seed // 10, a = g % n and p = 1 + (n - a) // (3 + g % 8), word i from a on is word a + (i - a) % p.
    """
    if seed % 10 or not n:
        return None
    g = seed // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    place = np.arange(n)
    place[a:] = a + (place[a:] - a) % p
    return place


def periodic_runs(documents: DataFrame, least: int = LEAST, seed: Column | None = None) -> DataFrame:
    """(doc_id, runs, collapsed) for each row of ``documents``.

    Words are maximal stretches without space, tab and line-feed-like bytes, compared as they are and numbered from 0. ``runs`` lists
    (start, length, period), by start and then period: stretches of at least max(``least``, 2 period) words whose smallest period it is and that no
    neighbouring word extends. ``collapsed`` joins by a space the words that no run holds after its first period. NULL and empty texts have no words: no run,
    an empty text. ``seed`` makes tails periodic first, see ``repeated_tail``. Rows that repeat are treated alike; other columns are not read.
    """
    rows = own_columns(documents.withColumn("_seed", F.lit(1) if seed is None else seed), "doc_id", "text", "_seed")
    id_type = documents.schema["doc_id"].dataType
    run_type = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
    out = T.StructType([T.StructField("doc_id", id_type), T.StructField("runs", T.ArrayType(run_type)), T.StructField("collapsed", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(out)
        for batch in batches:
            seeds = batch.column(2).to_pylist()
            for begin, raw in pieces(texts_of(batch.column(1))):
                ids: defaultdict = defaultdict(count().__next__)
                split, numbers, offsets = [], [], [0]
                for k, text in enumerate(raw):
                    words = text.split()
                    number = np.fromiter((ids[w] for w in words), np.int64, len(words))
                    place = repeated_tail(len(words), seeds[begin + k])
                    if place is not None:
                        words, number = [words[x] for x in place], number[place]
                    split.append(words)
                    numbers.append(number)
                    offsets.append(offsets[-1] + len(words))
                runs = runs_of(np.concatenate(numbers), np.array(offsets), least)
                collapsed = []
                for words, own in zip(split, runs, strict=True):
                    if own:
                        depth = np.zeros(len(words) + 1, np.int64)
                        for s, length, q in own:
                            depth[s + q] += 1
                            depth[s + length] -= 1
                        words = [words[x] for x in np.flatnonzero(np.cumsum(depth[:-1]) == 0)]
                    collapsed.append(b" ".join(words))
                part = batch.slice(begin, len(raw))
                made = pa.array([[dict(zip(("start", "length", "period"), x, strict=True)) for x in own] for own in runs], schema.field("runs").type)
                yield pa.RecordBatch.from_arrays([part.column(0).cast(schema.field("doc_id").type), made, pa.array(collapsed, pa.binary()).cast(pa.string())], schema=schema)

    return in_small_batches(rows).mapInArrow(run, out)
