"""Suffix dedup by a difference cover: bytes of strings that also start in a document with a smaller id are removed.

Two suffixes matter to each other only up to ``LENGTH`` bytes, so suffixes are ordered by that prefix and no deeper; ranks are
64-bit hashes instead of places in the alphabet, for which any fixed order brings equal prefixes together.

1. *Sort sampled triples.* Positions whose offset in the document, modulo 21, lies in a perfect difference cover (5 of
   21) are sampled. A sampled suffix is named by its triple of 10-byte letters. Any two equal prefixes of 50 bytes have,
   at one of the offsets 0 to 20, a triple that is sampled in both, so a prefix without a shared triple is unique.
2. *Recurse on names.* The prefix of 50 bytes at a position is the pair of the names at it and 20 bytes on.
3. *Merge the remaining suffixes*, sampled or not, that have a shared triple: all are sorted by that pair.
4. *Compare adjacent prefixes*: of equal ones the smallest document keeps its bytes.

The exchanges, and how hot strings are kept harmless, are in ``repeats``. Hash agreement of 64 bits stands for equality
(chance of one false removal about suffixes squared over 2^65). Sorting all suffixes to the end would ship some twenty
bytes for each byte of text; bounded by the prefix it ships about one.

Defined cases: a null text is empty; texts under 50 bytes lose nothing; a null key counts as the largest; rows with
the same key do not remove each other's bytes; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from transferlens.llm import repeats

LENGTH = 50
LETTER = 10
CYCLE = 21
COVER = (0, 1, 4, 14, 16)
IN_COVER = np.isin(np.arange(CYCLE), COVER)
BYTES = np.random.default_rng(21).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


@dataclass
class Text:
    data: np.ndarray
    ends: np.ndarray
    owner: np.ndarray
    names: np.ndarray
    left: np.ndarray


class DifferenceCover:
    columns = "key bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    anchors_per_byte = len(COVER) / CYCLE

    def read(self, data: np.ndarray, ends: np.ndarray, alive: np.ndarray) -> Text:
        """Names of all triples; ``left`` counts the bytes from each position to the end of its text, 0 in copies."""
        one = BYTES[data]
        two = safe(one, 1, one)
        four = safe(two, 2, two)
        letter = safe(safe(four, 4, four), 8, two)
        names = safe(safe(letter, LETTER, letter), 2 * LETTER, letter)
        sizes = np.diff(ends)
        owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        left = np.repeat(np.where(alive, ends[1:], 0), sizes) - np.arange(len(data))
        return Text(data, ends, owner, names, left)

    def anchors(self, text: Text):
        inside = offsets(text)
        places = np.flatnonzero(IN_COVER[inside] & (text.left >= 3 * LETTER))
        return places, text.owner[places], text.names[places], np.ones(len(places), bool)

    def windows(self, text: Text, places: np.ndarray, shared: np.ndarray):
        far = LENGTH - 3 * LETTER
        n = len(text.data)
        hits = np.zeros(n + far + 2, np.int32)
        hits[places[shared] + 1] = 1
        np.cumsum(hits, out=hits)
        at = np.flatnonzero((text.left >= LENGTH) & (hits[far + 1 : far + 1 + n] > hits[:n]))
        pair = repeats.mixed(text.names[at]) * np.uint64(repeats.BASE) + text.names[at + far]
        return at, text.owner[at], pair

    def rows(self, text: Text, ids: list, copies: np.ndarray, removed: np.ndarray) -> pa.RecordBatch:
        gone = repeats.covered(removed, LENGTH, len(text.data))
        sizes = np.diff(text.ends)
        for i in np.flatnonzero(copies & (sizes >= LENGTH)):
            gone[text.ends[i] : text.ends[i + 1]] = True
        counts, spans, shas = [], [], []
        for a, b in zip(text.ends[:-1], text.ends[1:], strict=True):
            part = gone[a:b]
            counts.append(int(np.count_nonzero(part)))
            spans.append(int(np.count_nonzero(part[1:] & ~part[:-1])) + int(part[0]) if b > a else 0)
            kept = text.data[a:b][~part] if counts[-1] else text.data[a:b]
            shas.append(hashlib.sha256(kept).hexdigest())
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(sizes), pa.array(counts, pa.int64()), pa.array(spans, pa.int64()), pa.array(shas)],
            ["key", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def offsets(text: Text) -> np.ndarray:
    """Offset of each position in its text, modulo the cycle."""
    sizes = np.diff(text.ends)
    return (np.arange(len(text.data)) - np.repeat(text.ends[:-1], sizes)) % CYCLE


def safe(left: np.ndarray, far: int, right: np.ndarray) -> np.ndarray:
    return repeats.joined(left, far, right) if len(left) > far else left


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, n_bytes, n_removed, n_spans, kept_sha256."""
    return repeats.without_repeats(docs, DifferenceCover(), key, text)
