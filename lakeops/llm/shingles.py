"""Words and word shingles of many texts at once, as 64-bit hashes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

SEPARATORS = bytes(i for i in range(128) if not chr(i).isalnum())
#: Which of the 256 byte values belong to words: ASCII letters and digits, and all bytes of other characters.
IN_WORD = np.array([i >= 128 or chr(i).isalnum() for i in range(256)])
_TABLE = np.random.Generator(np.random.PCG64(20240607)).integers(1, 2**63, 4096, dtype=np.uint64) | np.uint64(1)
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose outputs look random (the finalizer of SplitMix64)."""
    x = x + _GOLD
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@dataclass
class Words:
    """Word hashes of consecutive texts; the words of text i are ``hashes[offsets[i]:offsets[i + 1]]``."""

    hashes: np.ndarray
    offsets: np.ndarray


def words_of(texts: list[bytes]) -> Words:
    """Lower-cased words: runs of letters and digits, other than ASCII all characters count as letters."""
    lowered = [t.lower() if t.isascii() else t.decode("utf-8", "replace").lower().encode() for t in texts]
    flat = np.frombuffer(b" ".join([*lowered, b""]) + b" ", np.uint8)
    ends = np.cumsum([len(t) + 1 for t in lowered])
    inside = IN_WORD[flat]
    edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0)))
    starts, stops = edges[::2], edges[1::2]
    if not len(starts):
        return Words(np.empty(0, np.uint64), np.zeros(len(texts) + 1, np.int64))
    at = np.flatnonzero(inside)
    lengths = stops - starts
    firsts = np.cumsum(lengths) - lengths
    place = np.arange(len(at)) - np.repeat(firsts, lengths)
    terms = (flat[at].astype(np.uint64) + np.uint64(1)) * _TABLE[place & 4095]
    hashes = mix(np.add.reduceat(terms, firsts) + lengths.astype(np.uint64))
    return Words(hashes, np.concatenate([[0], np.searchsorted(starts, ends)]))


def shingles_of(words: Words, size: int) -> Words:
    """Hashes of all runs of ``size`` words of each text; a text of fewer words, but not none, is one shingle."""
    counts = np.diff(words.offsets)
    made = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    offsets = np.concatenate([[0], np.cumsum(made)])
    if not offsets[-1]:
        return Words(np.empty(0, np.uint64), offsets)
    owner = np.repeat(np.arange(len(counts)), made)
    first = words.offsets[owner] + np.arange(offsets[-1]) - offsets[owner]
    padded = np.concatenate([words.hashes, np.zeros(size, np.uint64)])
    out = np.zeros(len(first), np.uint64)
    last = words.offsets[owner + 1]
    for j in range(size):
        out = mix(out + np.where(first + j < last, padded[first + j], np.uint64(0)) * np.uint64(2 * j + 1))
    return Words(out, offsets)
