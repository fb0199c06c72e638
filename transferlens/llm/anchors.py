"""Substring dedup by fixed-block anchors: words of 13-word windows that also start in a smaller document are removed.

Every document is cut into non-overlapping reference blocks of 7 words, which are indexed by hash; every rolling window
of 7 words probes the index. A window of 13 words always holds one whole reference block of its own document, so two documents that share a window
meet in a block of one and a probe of the other. Each hit is extended by up to six words on either side: the 13-word windows
over it are looked up by hash, and neighbouring windows that an earlier document has join to maximal exact repeats.
Extension goes by key and not by pair, so a passage of n documents costs n look-ups and not n squared.

The exchanges, and how hot passages are kept harmless, are in ``repeats``. 64-bit hashes stand for equality.

Defined cases: a null text has no words; documents under 13 words lose nothing; a null key counts as the largest;
rows with the same key do not remove each other's words; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from transferlens.llm import repeats
from transferlens.llm.suffixes import BYTES, safe
from transferlens.llm.wavelet import SPACE

WINDOW = 13
BLOCK = 7
INVERSE = pow(repeats.BASE, -1, 1 << 64)


@dataclass
class Words:
    data: np.ndarray
    ends: np.ndarray
    starts: np.ndarray
    stops: np.ndarray
    owner: np.ndarray
    nth: np.ndarray
    left: np.ndarray
    first: np.ndarray
    hashes: np.ndarray
    blocks: np.ndarray


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out)


def word_hashes(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Where words start and stop, the first word of each text, and 64-bit hashes of the words."""
    solid = ~SPACE[data]
    starts, stops = solid.copy(), solid.copy()
    starts[1:] &= ~solid[:-1]
    stops[:-1] &= ~solid[1:]
    inner = ends[1:-1][(ends[1:-1] > 0) & (ends[1:-1] < len(data))]
    starts[inner] |= solid[inner]
    stops[inner - 1] |= solid[inner - 1]
    starts, stops = np.flatnonzero(starts), np.flatnonzero(stops) + 1
    # A word's hash: its part of the running polynomial, moved to power 0.
    running = np.concatenate([[np.uint64(0)], np.cumsum(BYTES[data] * powers(repeats.BASE, len(data)), dtype=np.uint64)])
    back = powers(INVERSE, len(data) + 1)
    word = repeats.mixed((running[stops] - running[starts]) * back[starts] + (stops - starts).astype(np.uint64))
    bounds = np.searchsorted(starts, ends)
    return starts, stops, bounds, word


class FixedBlocks:
    columns = "key bigint, n_words bigint, n_removed bigint, kept_sha256 string"
    anchors_per_byte = 1 / 6

    def read(self, data: np.ndarray, ends: np.ndarray, alive: np.ndarray) -> Words:
        starts, stops, bounds, word = word_hashes(data, ends)
        counts = np.diff(bounds)
        owner = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
        nth = np.arange(len(starts)) - np.repeat(bounds[:-1], counts)
        left = np.repeat(np.where(alive, counts, 0), counts) - nth
        two = safe(word, 1, word)
        four = safe(two, 2, two)
        six = safe(four, 4, two)
        seven = safe(six, 6, word)
        return Words(data, ends, starts, stops, owner, nth, left, bounds, safe(seven, BLOCK, six), seven)

    def anchors(self, text: Words):
        places = np.flatnonzero(text.left >= BLOCK)
        return places, text.owner[places], text.blocks[places], text.nth[places] % BLOCK == 0

    def windows(self, text: Words, places: np.ndarray, shared: np.ndarray):
        n = len(text.starts)
        hits = np.zeros(n + BLOCK + 1, np.int32)
        hits[places[shared] + 1] = 1
        np.cumsum(hits, out=hits)
        at = np.flatnonzero((text.left >= WINDOW) & (hits[BLOCK : BLOCK + n] > hits[:n]))
        return at, text.owner[at], text.hashes[at]

    def rows(self, text: Words, ids: list, copies: np.ndarray, removed: np.ndarray) -> pa.RecordBatch:
        gone = repeats.covered(removed, WINDOW, len(text.starts))
        counts = np.diff(text.first)
        for i in np.flatnonzero(copies & (counts >= WINDOW)):
            gone[text.first[i] : text.first[i + 1]] = True
        # A kept word keeps the byte after it in its document, as a space.
        edge = np.zeros(len(text.data) + 1, np.int8)
        np.add.at(edge, text.starts[~gone], 1)
        np.add.at(edge, np.minimum(text.stops + 1, text.ends[text.owner + 1])[~gone], -1)
        keep = np.cumsum(edge, dtype=np.int8)[: len(text.data)] > 0
        plain = np.where(SPACE[text.data], np.uint8(32), text.data)
        sums = np.concatenate([[0], np.cumsum(gone)])
        dropped = np.diff(sums[text.first])
        bounds = zip(text.ends[:-1], text.ends[1:], strict=True)
        shas = [hashlib.sha256(plain[a:b][keep[a:b]].tobytes().rstrip(b" ")).hexdigest() for a, b in bounds]
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(counts), pa.array(dropped), pa.array(shas)], ["key", "n_words", "n_removed", "kept_sha256"])


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, n_words, n_removed, kept_sha256."""
    return repeats.without_repeats(docs, FixedBlocks(), key, text)
