"""Token ids in wavelet matrices: one succinct, compressed record per shard of documents.

Texts are put in key order, tokenised and cut into shards of about ``TOKENS`` ids. A shard maps its ids to the ranks of its own
sorted alphabet and stores one bit-plane per bit of a rank: plane b holds bit b of every rank, in the order that sorting
stably by the higher bits gives. Planes are zstd-compressed; running counts of ones every ``STRIDE`` bits support rank
and select, so access, counting and occurrence lookup need no other file. A file of shards is Parquet, one row per shard:
shard (a number that grows along the key order), keys, ends (running token counts of the documents), alphabet, planes, ones.

Texts are tokenised piece by piece, each distinct piece once (see ``WordTokens``): the vocabulary drops white space, lower-cases, and
never joins pieces, nor words between ASCII white space. The ``tokenizers`` file is a parameter of the caller; it has to cut as
``word_bpe_49k.json`` does and to end words with ``WORD_END``.

Defined cases: a null or empty text has the end id alone; null keys come first; repeated rows are encoded each; a text
longer than a shard makes a shard of its own; an empty table gives an empty result.
"""

from __future__ import annotations

import os
import re
import zlib
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from transferlens.llm.common import lean
from transferlens.llm.language import blocks, text_bytes
from transferlens.session import shared_folder

TOKENS = 1 << 20
BLOCK = 1 << 20
END = 1
STRIDE = 4096
CACHE = 250_000
JOINED = 4096
WORD_END = "</w>"
APART = "\x02"
SCHEMA = "shard bigint, n_docs bigint, n_tokens bigint, keys binary, nulls binary, ends binary, alphabet binary, planes array<binary>, ones array<binary>"
DOCS = "shard bigint, key bigint, inside bigint, n_tokens bigint, ids_crc32 bigint"

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

# Kinds of bytes: 0 white space, letters, digits, other marks, and those whose words are left to the tokenizer.
LETTER, DIGIT, MARK, ODD = range(1, 5)
KIND = np.full(256, MARK, np.uint8)
KIND[SPACE] = 0
KIND[65:91] = KIND[97:123] = LETTER
KIND[48:58] = DIGIT
KIND[128:] = KIND[ord("'")] = ODD
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SIMPLE = re.compile(rb"[a-z]+|[0-9]|(?:(?!<\|)[^\x80-\xff'a-zA-Z0-9\s])+").fullmatch


def build_planes(ranks: np.ndarray, levels: int) -> list[np.ndarray]:
    """Bits of each level, the highest first, each in the order that the levels above leave."""
    planes = []
    for level in range(levels - 1, -1, -1):
        bits = (ranks >> level & 1).astype(bool)
        planes.append(bits)
        # Taking by index is faster than by mask.
        ranks = np.concatenate([ranks.take(np.flatnonzero(~bits)), ranks.take(np.flatnonzero(bits))])
    return planes


def read_planes(planes: list[np.ndarray], n: int) -> np.ndarray:
    """All ranks, from the lowest level up."""
    ranks = np.zeros(n, np.uint16 if len(planes) <= 16 else np.uint32)
    for level, bits in enumerate(reversed(planes)):
        above, zeros = np.empty_like(ranks), np.flatnonzero(~bits)
        above[zeros] = ranks[: len(zeros)]
        above[np.flatnonzero(bits)] = ranks[len(zeros) :] | (1 << level)
        ranks = above
    return ranks


class Shard:
    """Access, counting and occurrence lookup on one shard's record."""

    def __init__(self, record: dict):
        unpack = zstandard.ZstdDecompressor().decompress
        self.n = record["n_tokens"]
        self.alphabet = np.frombuffer(unpack(record["alphabet"]), np.uint32)
        self.ends = np.cumsum(np.frombuffer(unpack(record["ends"]), np.uint32).astype(np.int64))
        self.keys = np.frombuffer(unpack(record["keys"]), np.int64)
        self.nulls = np.frombuffer(unpack(record["nulls"]), np.uint8).astype(bool)
        self.planes = [np.unpackbits(np.frombuffer(unpack(p), np.uint8), count=self.n).view(bool) for p in record["planes"]]
        self.ones = [np.frombuffer(p, np.uint32) for p in record["ones"]]

    def tokens(self) -> np.ndarray:
        return self.alphabet[read_planes(self.planes, self.n)] if self.n else np.zeros(0, np.uint32)

    def _rank(self, level: int, place: int) -> int:
        """Ones before ``place``: the stored count of the last stride and the bits after it."""
        at = place // STRIDE
        return int(self.ones[level][at]) + int(np.count_nonzero(self.planes[level][at * STRIDE : place]))

    def _total(self, level: int) -> int:
        return self._rank(level, self.n)

    def access(self, place: int) -> int:
        rank = 0
        for level, bits in enumerate(self.planes):
            bit, ones = bool(bits[place]), self._rank(level, place)
            place = self.n - self._total(level) + ones if bit else place - ones
            rank = rank << 1 | bit
        return int(self.alphabet[rank])

    def _range(self, token: int, stop: int) -> tuple[int, int] | None:
        rank = int(np.searchsorted(self.alphabet, token))
        if rank == len(self.alphabet) or self.alphabet[rank] != token:
            return None
        low, high = 0, stop
        for level in range(len(self.planes)):
            a, b = self._rank(level, low), self._rank(level, high)
            if rank >> (len(self.planes) - 1 - level) & 1:
                zeros = self.n - self._total(level)
                low, high = zeros + a, zeros + b
            else:
                low, high = low - a, high - b
        return low, high

    def count(self, token: int, stop: int | None = None) -> int:
        """How often ``token`` stands before place ``stop``."""
        found = self._range(token, self.n if stop is None else stop)
        return found[1] - found[0] if found else 0

    def occurrence(self, token: int, nth: int) -> int:
        """The place of the nth occurrence (from 0), walking the levels back up; -1 if there is none."""
        found = self._range(token, self.n)
        if not found or nth >= found[1] - found[0]:
            return -1
        place, rank = found[0] + nth, int(np.searchsorted(self.alphabet, token))
        for level in range(len(self.planes) - 1, -1, -1):
            one = rank >> (len(self.planes) - 1 - level) & 1
            zeros = self.n - self._total(level)
            place = self._select(level, bool(one), place - zeros if one else place)
        return place

    def _select(self, level: int, bit: bool, nth: int) -> int:
        before = self.ones[level].astype(np.int64)
        if not bit:
            before = np.minimum(np.arange(len(before)) * STRIDE, self.n) - before
        at = int(np.searchsorted(before, nth, "right")) - 1
        part = self.planes[level][at * STRIDE : (at + 1) * STRIDE]
        return at * STRIDE + int(np.flatnonzero(part if bit else ~part)[nth - int(before[at])])


def record(shard: int, keys: list, lengths: np.ndarray, tokens: np.ndarray) -> dict:
    pack = zstandard.ZstdCompressor(level=1).compress
    present = np.zeros(1 << 17 if not len(tokens) or tokens.max() < 1 << 17 else int(tokens.max()) + 1, bool)
    present[tokens] = True
    alphabet = np.flatnonzero(present).astype(np.uint32)
    rank = np.zeros(len(present), np.uint16 if len(alphabet) <= 1 << 16 else np.uint32)
    rank[alphabet] = np.arange(len(alphabet))
    levels = max(int(len(alphabet) - 1).bit_length(), 1)
    planes = build_planes(rank[tokens], levels)
    starts = np.arange(0, len(tokens) + STRIDE, STRIDE)
    ones = []
    for bits in planes:
        packed = np.packbits(bits)
        sums = np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)])
        ones.append(sums[np.minimum(starts // 8, len(packed))].astype(np.uint32).tobytes())
    null = np.array([k is None for k in keys], np.uint8)
    return {"shard": shard, "n_docs": len(keys), "n_tokens": len(tokens), "keys": pack(np.array([k or 0 for k in keys], np.int64).tobytes()),
            "nulls": pack(null.tobytes()), "ends": pack(lengths.astype(np.uint32).tobytes()), "alphabet": pack(alphabet.tobytes()),
            "planes": [pack(np.packbits(p).tobytes()) for p in planes], "ones": ones}


def as_list(column: pa.Array) -> list[bytes]:
    """The values of a binary column without nulls, several times as fast as ``to_pylist``."""
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].tolist()
    held = data.to_pybytes() if data else b""
    return [held[a:b] for a, b in zip(ends, ends[1:])]


class WordTokens:
    """Token ids of texts, each distinct piece encoded once and remembered while it was used among the last ``CACHE`` to
    twice as many distinct pieces.

    Words of ASCII letters, digits and marks are cut here where the vocabulary cuts them (runs of letters, single digits, runs of other
    marks) and lower-cased as it does; many new pieces are encoded as one text, in which the last token of each tells its end. Words with other
    bytes, an apostrophe or the start of a special token are given to the tokenizer as they stand.
    """

    def __init__(self, file: str):
        # One thread per task, which is what Spark gives it; a pool of its own would cost memory for each thread.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(file)
        self.encode = tokenizer.encode_batch_fast
        vocabulary = tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
        # A word that no piece looks like, to set words apart that are encoded together.
        (self.apart,) = self.encode([APART], add_special_tokens=False)[0].ids
        self.fresh: dict[bytes, int] = {}
        self.older: dict[bytes, int] = {}
        # Piece k has the ids flat[stops[k - 1] : stops[k]]; piece 0 is the end id.
        self.flat, self.stops = np.array([END], np.uint32), np.array([1], np.int32)

    def one_by_one(self, words: list[bytes]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.encode([w.decode() for w in words], add_special_tokens=False)]

    def encoded(self, pieces: list[bytes], plain: bool) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces and where those of each end. They are encoded together; plain pieces end with a token
        that ends a word, others are set apart by a word of their own."""
        ids, stops, before = [], [], 0
        for i in range(0, len(pieces), JOINED):
            part = pieces[i : i + JOINED]
            text = b" ".join(part).decode() if plain else f" {APART} ".join([*(w.decode() for w in part), ""])
            found = np.array(self.encode([text], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.flatnonzero(self.last[found]) + 1 if plain else np.flatnonzero(found == self.apart)
            if len(ends) == len(part):
                if not plain:
                    found, ends = np.delete(found, ends), ends - np.arange(len(ends))
            else:
                each = self.one_by_one(part)
                found, ends = np.concatenate(each), np.cumsum([len(x) for x in each])
            ids.append(found)
            stops.append(ends + before)
            before += len(found)
        return np.concatenate([np.zeros(0, np.uint32), *ids]), np.concatenate([np.zeros(0, np.int64), *stops])

    def look_up(self, pieces: list[bytes]) -> np.ndarray:
        """The number of each piece."""
        found = list(map(self.fresh.get, pieces))
        missing = [w for w, k in zip(pieces, found, strict=True) if k is None]
        known = {w: k for w in missing if (k := self.older.get(w)) is not None}
        new = [w for w in missing if w not in known] if known else missing
        for plain in (True, False):
            part = [w for w in new if (SIMPLE(w) is not None) is plain]
            if part:
                ids, stops = self.encoded(part, plain)
                known.update(zip(part, range(len(self.stops), len(self.stops) + len(part))))
                self.flat, self.stops = np.concatenate([self.flat, ids]), np.concatenate([self.stops, (stops + len(self.flat)).astype(np.int32)])
        self.fresh.update(known)
        return np.array([known[w] if k is None else k for w, k in zip(pieces, found, strict=True)] if known else found, np.int32)

    def forget(self) -> None:
        """Drops what was last used before the last ``CACHE`` distinct pieces."""
        if len(self.fresh) > CACHE:
            used = np.concatenate([[0], np.fromiter(self.fresh.values(), np.int64, len(self.fresh))])
            sizes = np.diff(self.stops, prepend=np.int32(0))[used]
            stops = np.cumsum(sizes, dtype=np.int32)
            self.flat = self.flat[np.arange(stops[-1]) + np.repeat(self.stops[used] - stops, sizes)]
            self.stops = stops
            self.older, self.fresh = dict(zip(self.fresh, range(1, len(used)))), {}

    def tokens(self, data: np.ndarray, ends: np.ndarray, i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts i to j, each closed by the end id, and the number of ids of each text."""
        part, bounds = data[ends[i] : ends[j]], ends[i : j + 1] - ends[i]
        kind = KIND[part]
        solid = kind > 0
        starts = solid.copy()
        starts[1:] &= ~solid[:-1]
        inner = bounds[:-1][bounds[:-1] < len(part)]
        starts[inner] |= solid[inner]
        # Without white space the pieces lie one after the other.
        at = np.flatnonzero(solid)
        kind, letters, starts = kind[at], part[at], starts[at]
        if len(at):
            odd = kind == ODD
            special = np.flatnonzero((letters[:-1] == ord("<")) & (letters[1:] == ord("|")))
            odd[special] = True
            whole = np.logical_or.reduceat(odd, np.flatnonzero(starts))[np.cumsum(starts, dtype=np.int32) - 1]
            cut = kind == DIGIT
            cut[1:] |= kind[1:] != kind[:-1]
            starts |= cut & ~whole
            letters = np.where(whole, letters, LOWER[letters])
            first = np.flatnonzero(starts)
            offsets = np.append(first, len(at)).astype(np.int32)
            units = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(letters)]).dictionary_encode()
            codes, distinct = units.indices.to_numpy(), as_list(units.dictionary)
            per_text = np.diff(np.searchsorted(at[first], bounds))
        else:
            codes, distinct, per_text = np.zeros(0, np.int32), [], np.zeros(j - i, np.int64)
        codes = self.look_up(distinct)[codes] if distinct else codes
        codes = np.insert(codes, np.cumsum(per_text), 0)
        lengths = np.diff(self.stops, prepend=np.int32(0))[codes]
        stops = np.cumsum(lengths, dtype=np.int32)
        ids = self.flat[np.arange(int(stops[-1]) if len(stops) else 0, dtype=np.int32) + np.repeat(self.stops[codes] - stops, lengths)]
        last = np.cumsum(per_text + 1) - 1
        self.forget()
        return ids, np.diff(np.concatenate([[0], stops[last]]))


@cache
def tokens_of(file: str) -> WordTokens:
    """One per Python worker, which serves many tasks: what it remembers is the same for all of them."""
    return WordTokens(file)


def encoder(file: str, tokens: int = TOKENS):
    def encode(batches):
        from pyspark import TaskContext

        words, shard = tokens_of(file), TaskContext.get().partitionId() << 32
        keys, lengths, ids, size = [], [], [], 0

        def close():
            row = record(shard, keys, np.concatenate(lengths), np.concatenate(ids))
            return pa.RecordBatch.from_pylist([row], schema=ARROW)

        for batch in batches:
            data, ends = text_bytes(batch.column("text"))
            names = batch.column("key").to_pylist()
            for i, j in blocks(ends, BLOCK):
                part, each = words.tokens(data, ends, i, j)
                if size and size + len(part) > tokens:
                    yield close()
                    keys, lengths, ids, size, shard = [], [], [], 0, shard + 1
                keys += names[i:j]
                lengths.append(each)
                ids.append(part)
                size += len(part)
        if size:
            yield close()

    return encode


ARROW = pa.schema([("shard", pa.int64()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("keys", pa.binary()), ("nulls", pa.binary()),
                   ("ends", pa.binary()), ("alphabet", pa.binary()), ("planes", pa.list_(pa.binary())), ("ones", pa.list_(pa.binary()))])


def write_shards(docs: DataFrame, file: str, path: str, key: str = "doc_id", text: str = "text", tokens: int = TOKENS) -> None:
    rows = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.repartitionByRange("key").sortWithinPartitions("key")
    rows.mapInArrow(lean(encoder(file, tokens)), SCHEMA).write.parquet(path)


def decode(batches):
    for batch in batches:
        for row in range(batch.num_rows):
            one = batch.slice(row, 1).to_pylist()[0]
            shard = Shard(one)
            ids = shard.tokens().astype("<u4")
            starts = np.concatenate([[0], shard.ends[:-1]])
            sums = [zlib.crc32(ids[a:b]) for a, b in zip(starts, shard.ends, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(sums), one["shard"])), pa.array(shard.keys, mask=shard.nulls), pa.array(starts),
                 pa.array(shard.ends - starts), pa.array(sums, pa.int64())],
                ["shard", "key", "inside", "n_tokens", "ids_crc32"])


def read_documents(spark, path: str) -> DataFrame:
    """One row per document, from the files alone: key, start (ids before it), n_tokens, ids_crc32."""
    shards = spark.read.schema(SCHEMA).parquet(path)
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = shards.select(F.col("shard").alias("_shard"), F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("_start"))
    docs = shards.mapInArrow(lean(decode), DOCS)
    joined = docs.join(starts, docs["shard"] == starts["_shard"])
    return joined.select("key", (F.col("_start") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def encode_documents(docs: DataFrame, file: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Writes the shards to the shared folder and reads the documents back from them."""
    path = shared_folder(docs.sparkSession, "shards")
    write_shards(docs, file, path, key, text)
    return read_documents(docs.sparkSession, path)
