"""Repeated strings across documents, found over chunks of whole texts; the common ground of two operators.

Documents are packed into chunks of about ``CHUNK`` bytes, kept in a table that is bucketed by chunk, so that the small answers
to a chunk meet its texts without another shuffle of the texts. Copies of a whole text with a smaller id are set aside by
their digest first. Then two exchanges follow, each keyed by hash ranges:

1. *Anchors*, a few positions chosen by the operator's scheme: each chunk sends its sorted distinct anchor hashes, delta-coded
   (just wide enough that false agreement is rare), and gets back one bit per hash: whether another document has it.
2. *Windows* that lie on shared anchors: each chunk sends their sorted distinct 64-bit hashes and the smallest document
   of each, and gets back one bit per hash: whether a chunk has it in a smaller document.

A chunk sends a hash once however often it has it, so a passage of very many documents costs one entry per chunk, and no
pair of documents is ever formed. Both hash ranges and chunks have sizes that do not depend on the data's skew.
At larger scale, raise CHUNK, RANGE and PART together (64 MB, 16 M and 512 MB suit 100 TB).
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transferlens.llm.common import staged
from transferlens.llm.language import text_bytes
from transferlens.session import shared_folder

CHUNK = 4 << 20
PART = 16 << 20
RANGE = 1 << 18
SPARE_BITS = 14
BASE = 0x9E3779B97F4A7C15
LAST = np.iinfo(np.int64).max
CHUNKS = "chunk bigint, ids binary, ends binary, digests binary, text binary"


class Scheme(Protocol):
    """What tells one operator from the other."""

    columns: str
    anchors_per_byte: float

    def read(self, data: np.ndarray, ends: np.ndarray, alive: np.ndarray) -> object: ...

    def anchors(self, text) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Place, document and hash of each anchor, and whether it is an indexed one."""

    def windows(self, text, places: np.ndarray, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place, document and hash of each window that the shared anchors allow."""

    def rows(self, text, ids: list, copies: np.ndarray, removed: np.ndarray) -> pa.RecordBatch: ...


def mixed(hashes: np.ndarray) -> np.ndarray:
    """Spreads every bit of polynomial hashes over all bits."""
    hashes = hashes ^ (hashes >> np.uint64(32))
    hashes = hashes * np.uint64(0xD6E8FEB86659FD93)
    hashes = hashes ^ (hashes >> np.uint64(32))
    hashes = hashes * np.uint64(0xD6E8FEB86659FD93)
    return hashes ^ (hashes >> np.uint64(32))


def joined(left: np.ndarray, far: int, right: np.ndarray) -> np.ndarray:
    """Polynomial hash of two adjacent strings at each place, ``right`` standing ``far`` further on; wraps in 64 bits."""
    out = left * np.uint64(pow(BASE, far, 1 << 64))
    out[: len(out) - far] += right[far:]
    return out


def pack(numbers: np.ndarray) -> bytes:
    """Whole numbers in byte planes, as many as the largest needs; compressors take it from there."""
    width = max((int(numbers.max()).bit_length() + 7) // 8, 1) if len(numbers) else 1
    planes = numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + np.ascontiguousarray(planes.T).tobytes()


def unpack(packed: bytes) -> np.ndarray:
    width = packed[0]
    planes = np.frombuffer(packed, np.uint8, offset=1).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.reshape(-1).view("<u8")


def deltas(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=np.uint64(0)))


def undeltas(packed: bytes) -> np.ndarray:
    return np.cumsum(unpack(packed), dtype=np.uint64)


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of all elements of runs that start at ``starts``, run after run."""
    return np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())


def binaries(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Consecutive parts of the bytes; more than 2 GB of them raise an error."""
    ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64), pa.int32())
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, ends.buffers()[1], pa.py_buffer(data)])


def pack_runs(numbers: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """``pack`` of each run of numbers, at once for all, as a chunk has runs for thousands of ranges."""
    if not len(sizes):
        return pa.array([], pa.binary())
    most = np.maximum.reduceat(numbers, np.cumsum(sizes) - sizes)
    widths = 1 + sum((most >> np.uint64(8 * k) > 0).astype(np.int64) for k in range(1, 8))
    lengths = 1 + widths * sizes
    starts = np.cumsum(lengths) - lengths
    out = np.empty(lengths.sum(), np.uint8)
    out[starts] = widths
    planes = numbers.astype("<u8").view(np.uint8).reshape(-1, 8)
    at, step, width = spread(starts + 1, sizes), np.repeat(sizes, sizes), np.repeat(widths, sizes)
    for k in range(widths.max()):
        on = slice(None) if k < widths.min() else width > k
        out[at[on]] = planes[on, k]
        at += step
    return binaries(out, lengths)


def unpack_runs(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all packed runs, and how many each has."""
    data, ends = text_bytes(column)
    widths = data[ends[:-1]].astype(np.int64)
    sizes = (np.diff(ends) - 1) // widths
    out = np.zeros((sizes.sum(), 8), np.uint8)
    at, step, width = spread(ends[:-1] + 1, sizes), np.repeat(sizes, sizes), np.repeat(widths, sizes)
    for k in range(widths.max()):
        on = slice(None) if k < widths.min() else width > k
        out[on, k] = data[at[on]]
        at += step
    return out.reshape(-1).view("<u8"), sizes


def deltas_of_runs(keys: np.ndarray, sizes: np.ndarray) -> pa.Array:
    gaps, starts = np.diff(keys, prepend=np.uint64(0)), np.cumsum(sizes) - sizes
    gaps[starts] = keys[starts]
    return pack_runs(gaps, sizes)


def keys_of_runs(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    gaps, sizes = unpack_runs(column)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(gaps, dtype=np.uint64)])
    return sums[1:] - np.repeat(sums[np.cumsum(sizes) - sizes], sizes), sizes


def pack_bits(bits: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """The bits of each run in bytes of its own."""
    lengths = (sizes + 7) // 8
    padded = np.zeros(8 * lengths.sum(), np.uint8)
    padded[spread(8 * (np.cumsum(lengths) - lengths), sizes)] = bits
    return binaries(np.packbits(padded), lengths)


def unpack_bits(column: pa.Array, sizes: np.ndarray) -> np.ndarray:
    data, ends = text_bytes(column)
    return np.unpackbits(data[ends[0] : ends[-1]])[spread(8 * (ends[:-1] - ends[0]), sizes)]


def write_chunks(docs: DataFrame, key: str, text: str, total: int) -> DataFrame:
    def chunks(batches):
        from pyspark import TaskContext

        chunk, held, size = TaskContext.get().partitionId() << 32, [], 0

        def close():
            held.sort(key=lambda x: (x[0], x[1]))
            ends = np.cumsum([0, *(len(t) for _, t in held)])
            digests = b"".join(hashlib.blake2b(t, digest_size=16).digest() for _, t in held)
            ids = np.array([i for i, _ in held], np.int64)
            values = [[chunk], [ids.tobytes()], [ends.tobytes()], [digests], [b"".join(t for _, t in held)]]
            kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], ["chunk", "ids", "ends", "digests", "text"])

        for batch in batches:
            data, ends = text_bytes(batch.column("text"))
            for i, doc in enumerate(batch.column("id").to_pylist()):
                held.append((doc, data[ends[i] : ends[i + 1]].tobytes()))
                size += int(ends[i + 1] - ends[i])
                if size >= CHUNK:
                    yield close()
                    chunk, held, size = chunk + 1, [], 0
        if held:
            yield close()

    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(int(LAST))).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    name = f"chunks_{uuid.uuid4().hex}"
    parts = max(12, math.ceil(total / PART))
    writer = rows.mapInArrow(chunks, CHUNKS).write.bucketBy(parts, "chunk").sortBy("chunk").format("parquet")
    writer.option("compression", "zstd").option("path", shared_folder(spark, name)).saveAsTable(name)
    return spark.table(name)


def whole_copies(chunks: DataFrame) -> DataFrame:
    """Per chunk, the documents whose whole text a smaller id has: chunk, copies (their places)."""

    def digests(batches):
        for batch in batches:
            for chunk, ids, packed in zip(*(batch.column(c).to_pylist() for c in ("chunk", "ids", "digests")), strict=True):
                n = len(ids) // 8
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, chunk)), pa.array(np.arange(n, dtype=np.int32)), pa.array(np.frombuffer(ids, np.int64)),
                     pa.array([packed[16 * i : 16 * i + 16] for i in range(n)], pa.binary())], ["chunk", "place", "id", "digest"])

    rows = chunks.select("chunk", "ids", "digests").mapInArrow(digests, "chunk bigint, place int, id bigint, digest binary")
    rows = staged(rows, "digests")
    # Written out, so that both sides of the join are shuffled and a hot digest can be split.
    first = staged(rows.groupBy("digest").agg(F.min("id").alias("first")), "first")
    copies = rows.join(first, "digest").filter("id > first")
    return staged(copies.groupBy("chunk").agg(F.collect_list("place").alias("copies")), "copies")


def opened(batch: pa.RecordBatch, scheme: Scheme) -> Iterator[tuple]:
    for row in range(batch.num_rows):
        one = {c: batch.column(c)[row] for c in batch.schema.names}
        ends = np.frombuffer(one["ends"].as_buffer(), np.int64)
        raw = one["text"].as_buffer()
        data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
        alive = np.ones(len(ends) - 1, bool)
        alive[one["copies"].as_py() or []] = False
        yield one, alive, scheme.read(data, ends, alive)


def distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct hashes; the order that sorts all, where each distinct one starts in it, and the number of each in it."""
    order = np.argsort(hashes)
    ordered = hashes[order]
    new = np.concatenate([np.ones(min(len(hashes), 1), bool), ordered[1:] != ordered[:-1]])
    starts = np.flatnonzero(new)
    return ordered[starts], order, starts, np.cumsum(new) - 1


def placed(order: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sorted values back in the places they were sorted from."""
    out = np.empty(len(order), values.dtype)
    out[order] = values
    return out


def anchor_keys(scheme: Scheme, text, bits: int):
    """Sorted distinct anchor hashes; per hash: in several documents here, indexed here."""
    _, docs, hashes, indexed = scheme.anchors(text)
    keys, order, starts, _ = distinct(mixed(hashes) >> np.uint64(64 - bits))
    if not len(keys):
        return keys, np.zeros(0, bool), np.zeros(0, bool)
    docs = docs[order]
    several = np.minimum.reduceat(docs, starts) < np.maximum.reduceat(docs, starts)
    return keys, several, np.maximum.reduceat(indexed[order], starts)


def window_keys(scheme: Scheme, text, bits: int, answers):
    """Sorted distinct window hashes and the first document of each; per window: number of its hash, place and document."""
    places, _, hashes, _ = scheme.anchors(text)
    keys, order, _, number = distinct(mixed(hashes) >> np.uint64(64 - bits))
    shared = placed(order, answered(answers, len(keys))[number])
    at, docs, hashes = scheme.windows(text, places, shared)
    keys, order, starts, number = distinct(mixed(hashes))
    first = np.minimum.reduceat(docs[order], starts) if len(keys) else docs[:0]
    return keys, first, placed(order, number), at, docs


def answered(answers: pa.ListScalar, n: int) -> np.ndarray:
    """The bits of all ranges, in their order."""
    parts = answers.values
    if parts is None:
        assert n == 0, n
        return np.zeros(0, bool)
    order = np.argsort(parts.field("part").to_numpy())
    sizes = parts.field("n").to_numpy()[order].astype(np.int64)
    assert sizes.sum() == n, (sizes.sum(), n)
    return unpack_bits(parts.field("bits").take(pa.array(order)), sizes).astype(bool)


def cut(keys: np.ndarray, bits: int, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges of equal width that hold sorted keys, how many keys each has, and by how much a key exceeds the start of its range."""
    borders = np.array([(i << bits) // parts for i in range(parts)], np.uint64)
    sizes = np.diff(np.append(np.searchsorted(keys, borders), len(keys)))
    used = np.flatnonzero(sizes)
    return used, sizes[used], keys - np.repeat(borders, sizes)


def ask_anchors(scheme: Scheme, bits: int, parts: int):
    def ask(batches):
        for batch in batches:
            for one, _, text in opened(batch, scheme):
                keys, several, indexed = anchor_keys(scheme, text, bits)
                used, sizes, rest = cut(keys, bits, parts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(used, pa.int64()), pa.array(np.full(len(used), one["chunk"].as_py())), deltas_of_runs(rest, sizes),
                     pack_bits(several, sizes), pack_bits(indexed, sizes)], ["part", "chunk", "keys", "several", "indexed"])

    return ask


def gathered(table: pa.Table):
    """Keys of all chunks of a range, sorted: order, where each distinct key starts, its number per entry, entries per chunk."""
    keys, sizes = keys_of_runs(table.column("keys"))
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    return order, np.flatnonzero(new), np.cumsum(new) - 1, sizes


def answers(table: pa.Table, bits: np.ndarray, sizes: np.ndarray) -> pa.Table:
    return pa.table({"chunk": table.column("chunk"), "part": table.column("part"), "n": pa.array(sizes, pa.int32()), "bits": pack_bits(bits, sizes)})


ANSWERS = "chunk bigint, part bigint, n int, bits binary"


def tell_anchors(table: pa.Table) -> pa.Table:
    """An anchor is shared if several documents have it and it is indexed in one of them."""
    order, starts, number, sizes = gathered(table)
    chunks = np.diff(np.append(starts, len(order)))
    several = np.maximum.reduceat(unpack_bits(table.column("several"), sizes)[order], starts)
    indexed = np.maximum.reduceat(unpack_bits(table.column("indexed"), sizes)[order], starts)
    shared = ((chunks > 1) | (several > 0)) & (indexed > 0)
    bits = np.zeros(len(order), bool)
    bits[order] = shared[number]
    return answers(table, bits, sizes)


def ask_windows(scheme: Scheme, bits: int, parts: int):
    def ask(batches):
        for batch in batches:
            for one, _, text in opened(batch, scheme):
                keys, docs, _, _, _ = window_keys(scheme, text, bits, one["shared"])
                used, sizes, rest = cut(keys, 64, parts)
                ids = np.frombuffer(one["ids"].as_buffer(), np.int64)[docs]
                least = np.minimum.reduceat(ids, np.cumsum(sizes) - sizes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(used, pa.int64()), pa.array(np.full(len(used), one["chunk"].as_py())), deltas_of_runs(rest, sizes),
                     pa.array(least), pack_runs((ids - np.repeat(least, sizes)).astype(np.uint64), sizes)], ["part", "chunk", "keys", "least", "ids"])

    return ask


def tell_windows(table: pa.Table) -> pa.Table:
    """Whether a smaller document has the window in another chunk."""
    order, starts, number, sizes = gathered(table)
    ids = unpack_runs(table.column("ids"))[0].astype(np.int64) + np.repeat(table.column("least").to_numpy(), sizes)
    first = np.minimum.reduceat(ids[order], starts)
    bits = np.zeros(len(order), bool)
    bits[order] = first[number] < ids[order]
    return answers(table, bits, sizes)


def tell_rows(scheme: Scheme, bits: int):
    def tell(batches):
        for batch in batches:
            for one, alive, text in opened(batch, scheme):
                keys, first, inverse, places, docs = window_keys(scheme, text, bits, one["shared"])
                earlier = answered(one["earlier"], len(keys))
                ids = np.frombuffer(one["ids"].as_buffer(), np.int64)
                removed = places[earlier[inverse] | (ids[docs] > ids[first[inverse]])] if len(keys) else places
                yield scheme.rows(text, [None if i == LAST else i for i in ids.tolist()], ~alive, removed)

    return tell


def collected(rows: DataFrame, name: str, column: str) -> DataFrame:
    """The answers of all ranges to each chunk; their number is that of the ranges."""
    found = staged(rows, name)
    return found.groupBy("chunk").agg(F.collect_list(F.struct("part", "n", "bits")).alias(column))


def without_repeats(docs: DataFrame, scheme: Scheme, key: str = "doc_id", text: str = "text") -> DataFrame:
    total = docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    chunks = write_chunks(docs, key, text, total)
    anchors = max(int(total * scheme.anchors_per_byte), 1)
    bits = min(max(anchors.bit_length() + SPARE_BITS, 24), 60)
    parts = max(12, min(math.ceil(anchors / RANGE), int(CHUNK * scheme.anchors_per_byte) // 64))
    known = chunks.join(whole_copies(chunks), "chunk", "left")
    asked = known.select("chunk", "ends", "text", "copies").mapInArrow(ask_anchors(scheme, bits, parts), "part bigint, chunk bigint, keys binary, several binary, indexed binary")
    shared = collected(asked.groupBy("part").applyInArrow(tell_anchors, ANSWERS), "anchors", "shared")
    known = known.join(shared, "chunk", "left")
    asked = known.select("chunk", "ids", "ends", "text", "copies", "shared").mapInArrow(ask_windows(scheme, bits, parts), "part bigint, chunk bigint, keys binary, least bigint, ids binary")
    earlier = collected(asked.groupBy("part").applyInArrow(tell_windows, ANSWERS), "windows", "earlier")
    known = known.join(earlier, "chunk", "left").select("chunk", "ids", "ends", "text", "copies", "shared", "earlier")
    return known.mapInArrow(tell_rows(scheme, bits), scheme.columns)


def covered(places: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which of n positions lie in a run of ``length`` from one of ``places``, which are distinct."""
    edge = np.zeros(n + 1, np.int32)
    edge[places] += 1
    edge[places + length] -= 1
    return np.cumsum(edge, out=edge)[:n] > 0
