"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are read as UTF-8 bytes, ASCII letters in lower case, everything in ASCII that is no letter as one kind of space;
n-grams of 2, 3 and 4 bytes are hashed into ``BUCKETS`` buckets, those of spaces alone left out. Spark counts them per
language over at most about ``sample`` training texts of each language, so that rare ones are learned at any size; the log-probability matrix (languages x buckets, bounded) is
broadcast and whole texts are scored in numpy, a bounded block of bytes at a time; a longer text is taken in parts.

Defined cases: a null text or one without a letter is ``und`` with score 0, as is every text where no language was
learned; other texts get a learned language; repeated rows are judged alike; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transferlens.llm.common import about, lean

SAMPLE = 5_000
BUCKETS = 1 << 16
ORDERS = (2, 3, 4)
SMOOTHING = 0.5
BLOCK = 2 << 20
# Bytes that are read as n-grams at once: they take some 50 times as much memory.
PART = 256 << 10
UNKNOWN = "und"

SYMBOL = np.zeros(256, np.uint32)
SYMBOL[128:] = np.arange(128, 256)
SYMBOL[97:123] = np.arange(97, 123)
SYMBOL[65:91] = np.arange(97, 123)
MIX = np.uint64(0x9E3779B97F4A7C15)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column, and where each text starts and ends (null: empty), without a copy."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    column = column.fill_null("") if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else column.fill_null(b"")
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8), ends.astype(np.int64)


def blocks(ends: np.ndarray, most: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``most`` bytes; a longer text is a range of its own."""
    i, n = 0, len(ends) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(ends, ends[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def padded(data: np.ndarray, ends: np.ndarray, i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of texts i to j, a space before and after each, and the first symbol's place of each text."""
    lengths = np.diff(ends[i : j + 1])
    starts = np.concatenate([[0], np.cumsum(lengths + 2)])
    out = np.zeros(int(starts[-1]), np.uint32)
    shift = np.repeat(np.arange(1, 2 * (j - i) + 1, 2), lengths)
    out[np.arange(int(lengths.sum())) + shift] = SYMBOL[data[ends[i] : ends[j]]]
    return out, starts


def parts(data: np.ndarray, ends: np.ndarray, most: int | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, int]]:
    """Texts i to j with their padded symbols and starts, and in how many places of a text n-grams start.

    They hold about ``most`` bytes (by default PART). A longer text comes in parts that overlap by what its last n-grams need.
    """
    most = most or PART
    for i, j in blocks(ends, most):
        a, b = int(ends[i]), int(ends[j])
        if b - a <= most:
            yield i, j, *padded(data, ends, i, j), most + 2
            continue
        for p in range(a - 1, b + 1, most):
            q = min(p + most + max(ORDERS) - 1, b + 1)
            symbols = np.zeros(q - p, np.uint32)
            symbols[max(a - p, 0) : min(q, b) - p] = SYMBOL[data[max(p, a) : min(q, b)]]
            yield i, j, symbols, np.array([0, q - p]), most


def grams(symbols: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the n-gram that starts at each place, and whether it holds a letter."""
    n = max(len(symbols) - order + 1, 0)
    packed = np.zeros(n, np.uint32)
    for k in range(order):
        packed |= symbols[k : k + n] << np.uint32(8 * k)
    hashed = (packed.astype(np.uint64) + np.uint64(order << 40)) * MIX
    return (hashed >> np.uint64(48)).astype(np.int64) % BUCKETS, packed != 0


def count_grams(batches):
    """Rows of language, bucket and count, summed over a task."""
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        data, ends = text_bytes(batch.column("text"))
        langs = batch.column("lang").to_pylist()
        for i, lang in enumerate(langs):
            into = sums.setdefault(lang, np.zeros(BUCKETS, np.int64))
            for _, _, symbols, _, most in parts(data, ends[i : i + 2]):
                for order in ORDERS:
                    found, real = (x[:most] for x in grams(symbols, order))
                    into += np.bincount(found[real], minlength=BUCKETS)
    for lang, counts in sums.items():
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(counts[at])], ["lang", "bucket", "n"])


def learn(docs: DataFrame, trained: Column, key: str = "doc_id", text: str = "text", lang: str = "lang",
          sample: int = SAMPLE) -> tuple[list[str], np.ndarray]:
    """Languages and their log-probabilities (buckets x languages), from the rows of ``trained`` that have a language."""
    rows = docs.filter(trained & F.col(lang).isNotNull() & F.col(text).isNotNull())
    rows = rows.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    counted = about(rows, sample, "lang").select("text", "lang").mapInArrow(lean(count_grams), "lang string, bucket int, n bigint")
    table = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(set(table["lang"]))
    counts = np.full((BUCKETS, len(langs)), SMOOTHING)
    np.add.at(counts, (table["bucket"].to_numpy(np.int64), [langs.index(x) for x in table["lang"]]), table["n"].to_numpy(float))
    return langs, np.log(counts / counts.sum(axis=0)) if langs else counts


def log_scores(column: pa.Array, matrix: np.ndarray) -> np.ndarray:
    """Log-likelihood of each text under each language, over whole texts."""
    data, ends = text_bytes(column)
    out = np.zeros((len(ends) - 1, matrix.shape[1]))
    for i, j, symbols, starts, most in parts(data, ends):
        for order in ORDERS:
            found, real = grams(symbols, order)
            within = np.clip(np.diff(starts) - order + 1, 0, most)
            for lang in range(matrix.shape[1]):
                terms = matrix[:, lang][found]
                terms *= real
                terms = np.append(terms, 0.0)
                # n-grams that cross into the next text lie between a text's end and the next start.
                bounds = np.column_stack([starts[:-1], starts[:-1] + within]).ravel()
                sums = np.add.reduceat(terms, np.minimum(bounds, len(terms) - 1))[::2]
                out[i:j, lang] += np.where(within > 0, sums, 0.0)
    return out


def predict(docs: DataFrame, langs: list[str], matrix: np.ndarray, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score, the posterior probability under equal priors."""
    plain = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    if not langs:
        return docs.withColumn("lang_pred", F.lit(UNKNOWN)).withColumn("score", F.lit(0.0))
    shared = docs.sparkSession.sparkContext.broadcast((langs, matrix - matrix.mean(axis=1, keepdims=True)))

    def score(batches):
        names, log_ratios = shared.value
        names = pa.array(names, pa.string())
        for batch in batches:
            sums = log_scores(batch.column(text), log_ratios)
            sums -= sums.max(axis=1, keepdims=True) if len(sums) else 0
            posterior = np.exp(sums)
            posterior /= posterior.sum(axis=1, keepdims=True)
            best = posterior.argmax(axis=1)
            letters = batch.column("_letters")
            named = pc.if_else(letters, names.take(pa.array(best)), pa.scalar(UNKNOWN))
            certain = np.where(letters.to_numpy(zero_copy_only=False), posterior.max(axis=1, initial=0.0), 0.0)
            kept = [batch.column(c) for c in batch.schema.names if c in wanted]
            yield pa.RecordBatch.from_arrays([*kept, named, pa.array(certain)], [*wanted, "lang_pred", "score"])

    wanted = list(docs.columns)
    fields = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return docs.withColumn("_letters", plain).mapInArrow(lean(score), fields)
