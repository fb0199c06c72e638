"""Near-duplicate detection by ProbMinHash signatures, banding and exact verification.

A text is its distinct shingles of five words (a shorter text is one shingle), each weighing 1 + ln(occurrences). Every shingle
draws a Poisson process of arrivals at the rate of its weight, each arrival at a random register; a register keeps its
first arrival. A shingle stops as soon as its next arrival comes after every register's first, so most stop at
once. Two texts agree in a register with the probability Jaccard similarity of their weighted shingles. Half of the 32 bands of 4
registers come from weighted shingles; links are decided by plain similarity, so the other half come from shingles that all weigh the same. Texts
of plain similarity 0.8 become candidates with a chance above 0.9997 however often either repeats its lines, and above 0.9999999 where
both repeat them alike (0.987 and 0.9998 at 0.7).

Candidates are verified on their whole sets of shingles: a link needs a Jaccard similarity of at least 0.8. Equal texts
are one text from the start. In each band's bucket all texts are first verified against the smallest one, which costs one
pair per text. Buckets that then still hold several components are searched for links between these: all pairs of
components in buckets of up to 16 texts; in larger ones each text outside the largest component first meets one text inside
it and one outside. What is outside even then is compared with the whole bucket, in blocks of about BLOCK by BLOCK
texts: a task multiplies two incidence matrices and returns only the links that join components, fewer than its
texts. No pair of a bucket that could change a class goes unseen; pairs inside a component are never compared.

Defined cases: null and empty texts (and texts of white space alone) are equal only to identical ones; null keys are
left out of pairs and are classes of their own; rows that repeat a key and a text are one text; rows that share a key but not the text are
texts of their own (all but one of them count as larger than all keys, so a class keeps the row with the smallest key); an empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from transferlens.llm import repeats
from transferlens.llm.anchors import word_hashes
from transferlens.llm.common import lean, staged
from transferlens.llm.components import components
from transferlens.llm.language import blocks, text_bytes
from transferlens.llm.suffixes import safe

SHINGLE = 5
SIMILAR = 0.8
BANDS = 32
ROWS = 4
REGISTERS = BANDS * ROWS
SMALL = 16
BLOCK = 512
BLOCK_BYTES = 8 << 20
SLAB = 1 << 23
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
STEPS = (1, 1, 2, 4, 8, 16)


def shingles(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text and hash of every shingle."""
    starts, _, bounds, words = word_hashes(data, ends)
    counts = np.diff(bounds)
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    two = safe(words, 1, words)
    five = repeats.mixed(safe(safe(two, 2, two), 4, words))
    owner = np.repeat(np.arange(len(counts)), counts)
    left = np.repeat(counts, counts) - (np.arange(len(words)) - np.repeat(bounds[:-1], counts))
    full = left >= SHINGLE
    # A text of one to four words is one shingle: the sum of its words' hashes, each moved by its place.
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    whole = np.array([np.bitwise_xor.reduce(repeats.mixed(words[bounds[i] : bounds[i + 1]] + np.arange(counts[i], dtype=np.uint64))) for i in short], np.uint64)
    return np.concatenate([owner[full], short]), np.concatenate([five[full], whole])


def distinct(owner: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text and how often they stand in it."""
    _, first, n = np.unique(repeats.mixed(hashes + owner.astype(np.uint64) * GOLDEN), return_index=True, return_counts=True)
    return owner[first], hashes[first], n


def signatures(owner: np.ndarray, hashes: np.ndarray, n: np.ndarray, texts: int, registers: int = REGISTERS) -> np.ndarray:
    """texts x registers: the shingle that arrives first at each register; 0 for texts without shingles."""
    first = np.full(texts * registers, np.inf)
    who = np.zeros(texts * registers, np.uint64)
    rate = 1 + np.log(n)
    time, turn, step = np.zeros(len(owner)), 0, 0
    while len(owner):
        many = STEPS[min(step, len(STEPS) - 1)]
        turns = np.arange(turn, turn + many, dtype=np.uint64)
        draw = repeats.mixed(hashes[:, None] + (turns + np.uint64(1)) * GOLDEN)
        times = time[:, None] + np.cumsum(-np.log(((draw >> np.uint64(11)).astype(float) + 0.5) / 2.0**53), axis=1) / rate[:, None]
        at = owner[:, None] * registers + (repeats.mixed(draw) % np.uint64(registers)).astype(np.int64)
        early = times < first[at]
        places, arrivals, names = at[early], times[early], np.broadcast_to(hashes[:, None], at.shape)[early]
        np.minimum.at(first, places, arrivals)
        won = first[places] == arrivals
        who[places[won]] = names[won]
        latest = first.reshape(texts, registers).max(axis=1) if step < 4 else latest_of(first, owner, latest)
        on = times[:, -1] < latest[owner]
        owner, hashes, rate, time = owner[on], hashes[on], rate[on], times[on, -1]
        turn, step = turn + many, step + 1
    return who.reshape(texts, registers)


def latest_of(first: np.ndarray, owner: np.ndarray, latest: np.ndarray) -> np.ndarray:
    """Brings ``latest`` up to date for the texts that still draw."""
    open_ = np.unique(owner)
    latest[open_] = first.reshape(len(latest), -1)[open_].max(axis=1)
    return latest


def band_hashes(owner: np.ndarray, hashes: np.ndarray, n: np.ndarray, texts: int) -> np.ndarray:
    """texts x BANDS: the first half of the bands from weighted shingles, the other half from plain ones."""
    weighted = signatures(owner, hashes, n, texts, REGISTERS // 2)
    plain = signatures(owner, repeats.mixed(hashes + GOLDEN), np.ones(len(n), np.int64), texts, REGISTERS // 2)
    who = np.concatenate([weighted, plain], axis=1).reshape(texts, BANDS, ROWS)
    band = repeats.mixed(np.arange(1, BANDS + 1, dtype=np.uint64) * GOLDEN)[None, :] + np.zeros((texts, BANDS), np.uint64)
    for row in range(ROWS):
        band = repeats.mixed(band * GOLDEN + who[:, :, row])
    return band


def sign(batches):
    """key, digest of the text, band hashes (none for a text without words)."""
    for batch in batches:
        data, ends = text_bytes(batch.column("text"))
        for i, j in blocks(ends):
            part, bounds = data[ends[i] : ends[j]], ends[i : j + 1] - ends[i]
            owner, hashes, n = distinct(*shingles(part, bounds))
            band = band_hashes(owner, hashes, n, j - i)
            has = np.zeros(j - i, bool)
            has[owner] = True
            offsets = np.concatenate([[0], np.cumsum(np.where(has, BANDS, 0))]).astype(np.int32)
            bands = pa.ListArray.from_arrays(pa.array(offsets), pa.array(band[has].view(np.int64).ravel()))
            digests = [hashlib.blake2b(part[a:b], digest_size=16).digest() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("key").slice(i, j - i), pa.array(digests, pa.binary()), bands], ["key", "digest", "bands"])


def pack_sets(batches):
    for batch in batches:
        data, ends = text_bytes(batch.column("text"))
        for i, j in blocks(ends):
            owner, hashes, _ = distinct(*shingles(data[ends[i] : ends[j]], ends[i : j + 1] - ends[i]))
            order = np.lexsort((hashes, owner))
            hashes, at = hashes[order] >> np.uint64(16), np.searchsorted(owner[order], np.arange(j - i + 1))
            sets = [repeats.deltas(hashes[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("key").slice(i, j - i), pa.array(sets, pa.binary())], ["key", "set"])


def compare(batches):
    """Pairs whose whole sets of shingles have a Jaccard similarity of SIMILAR or more."""
    for batch in batches:
        found, hub, packed = [], None, None
        for a, b in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
            right = b.as_buffer()
            if packed is None or not right.equals(packed):
                packed, hub = right, repeats.undeltas(b.as_py())
            own = repeats.undeltas(a.as_py())
            both = len(own) + len(hub) - len(np.union1d(own, hub))
            found.append(both / max(len(own) + len(hub) - both, 1))
        near = pa.array(found, pa.float64())
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), near], ["a", "b", "similarity"])


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    left = sets.select(F.col("key").alias("a"), F.col("set").alias("set_a"))
    right = sets.select(F.col("key").alias("b"), F.col("set").alias("set_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "set_a", "set_b")
    return both.mapInArrow(lean(compare), "a bigint, b bigint, similarity double").filter(F.col("similarity") >= SIMILAR)


def numbered(rows: DataFrame) -> tuple[DataFrame, bool]:
    """``rows`` (key, text and others) with a number for each text of a key, which is the key where it has one text, and whether all have."""
    rows = rows.withColumn("print", F.struct(F.xxhash64(F.lit(1), "text").alias("a"), F.xxhash64(F.lit(2), "text").alias("b")))
    prints = rows.filter("key IS NOT NULL").groupBy("key").agg(F.min("print").alias("first"), F.max("print").alias("last"))
    several = staged(prints.filter("first <> last").select(F.col("key").alias("_key"), "first"), "several_texts")
    if several.isEmpty():
        return rows.withColumn("id", F.col("key")).drop("print"), True
    top = rows.agg(F.max("key")).first()[0]
    rows = rows.join(several, F.col("key") == F.col("_key"), "left")
    more = F.lit(top + 1) + F.monotonically_increasing_id()
    # Written out, as these numbers must not change.
    given = rows.withColumn("id", F.when(F.col("first").isNull() | (F.col("print") == F.col("first")), F.col("key")).otherwise(more))
    return staged(given.drop("print", "first", "_key"), "numbered"), False


def near_classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, class_id (the smallest key of its class), text_id (the smallest key with its text)."""
    rows, plain = numbered(docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")))
    found = classes_of(rows.select(F.col("id").alias("key"), "text"))
    if plain:
        return found
    keys = staged(rows.select("id", F.col("key").alias("of")).distinct(), "keys_of_numbers")
    for name in ("key", "class_id", "text_id"):
        named = keys.withColumnsRenamed({"id": f"_{name}", "of": f"of_{name}"})
        found = found.join(named, found[name].eqNullSafe(named[f"_{name}"]))
    return found.select(*(F.col(f"of_{name}").alias(name) for name in ("key", "class_id", "text_id")))


def classes_of(rows: DataFrame) -> DataFrame:
    """The classes of texts whose keys are their own."""
    signed = staged(rows.mapInArrow(lean(sign), "key bigint, digest binary, bands array<bigint>"), "signed")
    # Tables that are joined on a hot key are written out first, so that both sides are shuffled and the key can be split.
    first = staged(signed.groupBy("digest").agg(F.min("key").alias("text_id")), "first")
    texts = staged(signed.join(first, "digest").select("key", "text_id", "bands"), "texts")
    held = texts.filter("key = text_id").dropDuplicates(["key"]).select("key", F.explode("bands").alias("band"))
    hubs = held.groupBy("band").agg(F.min("key").alias("hub"), F.count("*").alias("n")).filter("n > 1")
    hubs = staged(hubs, "hubs")
    buckets = staged(held.join(hubs, "band"), "buckets")
    pairs = staged(buckets.filter("key <> hub").select(F.col("key").alias("a"), F.col("hub").alias("b")).distinct(), "pairs")
    wanted = pairs.select(F.col("a").alias("_k")).union(pairs.select("b")).union(buckets.filter("n > 2").select("key")).distinct()
    sets = rows.join(wanted, F.col("key") == F.col("_k"), "left_semi").dropDuplicates(["key", "text"])
    own = texts.filter("key = text_id").select(F.col("key").alias("_k")).distinct()
    sets = staged(sets.mapInArrow(lean(pack_sets), "key bigint, set binary").join(own, F.col("key") == F.col("_k"), "left_semi"), "sets")
    links = staged(verified(pairs, sets), "links")
    labels = components(links)
    rest = staged(outside(buckets.filter("n > 2"), labels), "rest")
    more = staged(across(rest).join(pairs, ["a", "b"], "left_anti"), "pairs")
    added = staged(verified(more, sets), "links")
    if not added.isEmpty():
        links = staged(links.union(added), "links")
        labels = components(links)
        rest = staged(outside(buckets.filter("n > 2"), labels), "rest")
    added = staged(between(rest, sets), "links")
    if not added.isEmpty():
        labels = components(links.select("a", "b").union(added))
    classes = labels.select(F.col("node").alias("text_id"), "component")
    joined = texts.select("key", "text_id").join(classes, "text_id", "left")
    return joined.select("key", F.coalesce("component", "text_id").alias("class_id"), "text_id")


def outside(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of the buckets that hold several components, and whether they are outside the bucket's largest one."""
    named = buckets.join(labels, buckets["key"] == labels["node"], "left")
    named = staged(named.select("band", "n", "key", F.coalesce("component", "key").alias("component")), "named")
    sizes = named.groupBy("band", "component").agg(F.count("*").alias("size"))
    largest = sizes.groupBy("band").agg(F.max(F.struct(F.col("size"), -F.col("component"))).alias("top"), F.count("*").alias("kinds"))
    largest = staged(largest.filter("kinds > 1").select("band", (-F.col("top.col2")).alias("main")), "largest")
    return named.join(largest, "band").select("band", "n", "key", "component", (F.col("component") != F.col("main")).alias("outside"))


def across(rest: DataFrame) -> DataFrame:
    """Pairs between components of a bucket: all of them in a small bucket; in a large one each text outside its largest
    component with one text of that component and one text outside, others in every bucket."""
    outer = rest.filter("outside")
    small = outer.filter(F.col("n") <= SMALL).join(rest.select("band", F.col("key").alias("other"), F.col("component").alias("others")), "band")
    rank = F.struct(F.xxhash64("band", "key").alias("rank"), F.col("key"), F.col("component"))
    hubs = rest.filter(F.col("n") > SMALL).groupBy("band", "outside").agg(F.min(rank).alias("hub"))
    hubs = staged(hubs.select("band", F.col("hub.key").alias("other"), F.col("hub.component").alias("others")), "hubs")
    large = outer.filter(F.col("n") > SMALL).join(hubs, "band")
    both = small.unionByName(large).filter("component <> others")
    return both.select(F.greatest("key", "other").alias("a"), F.least("key", "other").alias("b")).distinct()


def between(rest: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) that join components in large buckets: every text outside the largest component against the whole bucket.

    A bucket is cut by hash into blocks that hold few texts and few bytes, so that no task sees a whole one.
    """
    large = rest.filter(F.col("n") > SMALL).join(sets.select(F.col("key").alias("_k"), "set"), F.col("key") == F.col("_k"))
    large = staged(large.select("band", "key", "component", "outside", "set"), "large")

    def many(side):
        return F.ceil(F.greatest(F.sum(side) / BLOCK, F.sum(F.length("set") * side) / BLOCK_BYTES)).cast("int")

    shape = staged(large.groupBy("band").agg(many(F.col("outside").cast("int")).alias("rows"), many(F.lit(1)).alias("columns")), "shape")
    cut = large.join(shape, "band")
    at = F.xxhash64("key")
    left = cut.filter("outside").select("band", "key", "component", "set", F.lit(True).alias("outside"), F.pmod(at, "rows").cast("int").alias("i"),
                                        F.explode(F.sequence(F.lit(0), F.col("columns") - 1)).alias("j"))
    right = cut.select("band", "key", "component", "set", F.lit(False).alias("outside"),
                       F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("i"), F.pmod(at, "columns").cast("int").alias("j"))
    return left.union(right).groupBy("band", "i", "j").applyInArrow(joining, "a bigint, b bigint").distinct()


def joining(block: pa.Table) -> pa.Table:
    """Of the links between outside texts and texts of the other side, enough to join all components they join."""
    outer = block.column("outside").to_numpy()
    keys, names = block.column("key").to_numpy(), block.column("component").to_numpy()
    packed = block.column("set").to_pylist()
    halves = []
    for side in (outer, ~outer):
        found = [repeats.undeltas(packed[k]) for k in np.flatnonzero(side)]
        sizes = np.array([len(x) for x in found], np.int64)
        halves.append((keys[side], names[side], sizes, np.concatenate([np.zeros(0, np.uint64), *found]), np.repeat(np.arange(len(found)), sizes)))
    (keys_a, names_a, sizes_a, a, row_a), (keys_b, names_b, sizes_b, b, row_b) = halves
    shared = np.intersect1d(a, b)
    both = np.zeros((len(keys_a), len(keys_b)), np.int64)
    width = max(SLAB // max(len(keys_a) + len(keys_b), 1), 1)
    for low in range(0, len(shared), width):
        columns = shared[low : low + width]
        both += np.rint(incidence(columns, a, row_a, len(keys_a)) @ incidence(columns, b, row_b, len(keys_b)).T).astype(np.int64)
    near = both / np.maximum(sizes_a[:, None] + sizes_b[None, :] - both, 1) >= SIMILAR
    i, j = np.nonzero(near & (names_a[:, None] != names_b[None, :]))
    _, first = np.unique(np.column_stack([names_a[i], names_b[j]]), axis=0, return_index=True)
    top: dict[int, int] = {}

    def root(x: int) -> int:
        while top.get(x, x) != x:
            top[x] = x = top.get(top[x], top[x])
        return x

    kept = []
    for k in np.sort(first):
        x, y = root(int(names_a[i[k]])), root(int(names_b[j[k]]))
        if x != y:
            top[max(x, y)] = min(x, y)
            kept.append(k)
    ends = keys_a[i[kept]] if kept else keys[:0], keys_b[j[kept]] if kept else keys[:0]
    return pa.table({"a": np.maximum(*ends), "b": np.minimum(*ends)})


def incidence(columns: np.ndarray, hashes: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """n texts x columns: 1 where the text holds the shingle."""
    at = np.minimum(np.searchsorted(columns, hashes), len(columns) - 1)
    held = columns[at] == hashes
    out = np.zeros((n, len(columns)), np.float32)
    out[rows[held], at[held]] = 1
    return out


def drop_near(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with the smallest key of each class, one row each; documents without a key stay."""
    names = docs.columns
    held = docs.select(F.struct(*names).alias("row"), F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows, _ = numbered(held)
    stay = classes_of(rows.select(F.col("id").alias("key"), "text")).filter("key = class_id").select(F.col("key").alias("_stays")).distinct()
    kept = rows.filter(F.col("id").isNotNull()).join(stay, F.col("id") == F.col("_stays"), "left_semi")
    # Rows that repeat key and text, of which one stays.
    one = Window.partitionBy("id").orderBy("key")
    kept = kept.withColumn("_n", F.row_number().over(one)).filter("_n = 1")
    return kept.select("row").union(rows.filter(F.col("id").isNull()).select("row")).select("row.*")
