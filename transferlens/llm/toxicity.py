"""Toxicity: a support vector machine on a subsequence string kernel, with Nystroem landmarks.

Kernel. Two words are compared by their common subsequences of three symbols; each occurrence counts LAMBDA to the power
of its span, spans are at most SPAN + 1, and a word's sum is divided by what a word of its length would have with itself
if all subsequences differed. Gaps make ``idxiot`` and ``idot`` close to ``idiot``; marks inside words are passed
over and single letters in a row are read as one word, so ``i.d.i.o.t`` and ``i d i o t`` are that word.

Windows. A text is read in windows of one to WINDOW successive words; a window's words are joined without the space, so that insults
split into pieces (``blo ck he ad``) and phrases of harmless words are seen. A text's margin is the largest of its windows'.

Training is on labelled texts: a linear SVM (squared hinge) on Nystroem features, where each toxic text shows its most toxic window
and each clean one all of its windows, by the most toxic ones found so far (a multiple-instance SVM). The bounded sample is drawn by
label. Round 0 starts from windows that stand in toxic texts far more often than in clean ones: words and, for toxic texts without
such a word, phrases. In each of ROUNDS further rounds Spark finds the best window of every text under the last machine, and the
machine is fitted to these texts' windows anew, with new landmarks. The function of a window is linear in its subsequences, so it is
folded into one weight per symbol triple and the matrix of landmarks is not needed to score. Margins are mapped to 0..1 by a logistic
curve fitted on the labelled texts, each weighted by how many it stands for.

Defined cases: null and empty texts and texts without letters have the least margin; without labels of both kinds, or where no
window tells toxic texts from clean ones, every score is the share of toxic labels (0 without any); rows without a label are not
learned from; repeated rows score alike; an empty table gives an empty result; columns named score or predicted are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transferlens.llm.common import staged
from transferlens.llm.language import blocks, text_bytes

SAMPLE = 12_000
VOCABULARY = 60_000
LANDMARKS = 96
MARKS = 1000
BATCH = 200
WINDOW = 4
ROUNDS = 2
WITNESS = 64
LAMBDA = 0.6
SPAN = 5
COST = 10.0
LEAST = -4.0
SYMBOLS = 64

# 0: between words, 255: passed over; letters 1 to 26, digits 27 to 31 in pairs, other bytes 32 to 63.
CODE = np.full(256, 255, np.uint8)
CODE[[9, 10, 11, 12, 13, 32]] = 0
CODE[97:123] = np.arange(1, 27)
CODE[65:91] = np.arange(1, 27)
CODE[48:58] = 27 + np.arange(10) // 2
CODE[128:] = 32 + np.arange(128) % 32
PAIRS = [(a, a + b) for a in range(1, SPAN) for b in range(1, SPAN - a + 1)]


def coded(data: np.ndarray, ends: np.ndarray, i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of texts i to j with a 0 after each word and text, and the text of each symbol."""
    lengths = np.diff(ends[i : j + 1]) + 1
    out = np.zeros(int(lengths.sum()) + 1, np.uint8)
    owner = np.repeat(np.arange(j - i, dtype=np.int32), lengths)
    out[1:][np.arange(len(owner)) - np.repeat(np.cumsum(lengths) - lengths, lengths) < np.repeat(lengths - 1, lengths)] = CODE[data[ends[i] : ends[j]]]
    keep = out != 255
    keep[0] = True
    out, owner = out[keep], owner[keep[1:]]
    # A space between two single letters of one text goes, so that spaced-out words are read as one.
    gap = np.flatnonzero(out[2:-2] == 0) + 2
    gap = gap[(out[gap - 2] == 0) & (out[gap + 2] == 0) & (out[gap - 1] > 0) & (out[gap + 1] > 0)]
    gap = gap[owner[gap - 1] == owner[gap]]
    if len(gap):
        keep = np.ones(len(out), bool)
        keep[gap] = False
        out, owner = out[keep], owner[keep[1:]]
    return out[1:], owner


def word_bounds(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = np.concatenate([[0], (symbols > 0).view(np.int8), [0]])
    change = np.diff(inside)
    return np.flatnonzero(change == 1), np.flatnonzero(change == -1)


def self_weight(most: int = 64) -> np.ndarray:
    """Square root of the sum of squared weights of all subsequences of a word, by its length."""
    out = np.zeros(most + 1)
    for n in range(most + 1):
        out[n] = sum(max(n - far, 0) * LAMBDA ** (2 * (far + 1)) for _, far in PAIRS)
    return np.sqrt(out)


def norms(lengths: np.ndarray) -> np.ndarray:
    table = self_weight()
    full = sum(LAMBDA ** (2 * (far + 1)) for _, far in PAIRS)
    exact = table[np.minimum(lengths, 64)]
    return np.maximum(np.where(lengths > 64, np.sqrt(exact**2 + np.maximum(lengths - 64, 0) * full), exact), 1e-9)


def triples(symbols: np.ndarray):
    """For each pair of gaps: index of the triple at each place, 0 where it leaves the word, and its weight."""
    n = len(symbols)
    wide = np.concatenate([symbols, np.zeros(SPAN, np.uint8)]).astype(np.int32)
    # Symbols up to the end of the word, at most SPAN.
    left = np.zeros(n + SPAN, np.int8)
    for back in range(SPAN, 0, -1):
        ends_here = wide[back : back + n] == 0
        left[:n][ends_here] = back
    left[:n][left[:n] == 0] = SPAN + 1
    first = wide[:n] * (SYMBOLS * SYMBOLS)
    for near, far in PAIRS:
        index = first + wide[near : near + n] * SYMBOLS + wide[far : far + n]
        index *= (left[:n] > far) & (symbols > 0)
        yield index, LAMBDA ** (far + 1)


def symbols_of(word: str) -> bytes:
    """The symbols of a word or a phrase, as a window of it."""
    code = CODE[np.frombuffer(word.encode(), np.uint8)]
    return code[(code != 255) & (code != 0)].tobytes()


def subsequences(window: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Triples of a window's symbols and their normalised weights."""
    code = np.frombuffer(window, np.uint8)
    found = [(index[index > 0], weight) for index, weight in triples(code)]
    weights = np.concatenate([np.full(len(i), w) for i, w in found])
    return np.concatenate([i for i, _ in found]), weights / norms(np.array([len(code)]))[0]


def dense(found: list[tuple[np.ndarray, np.ndarray]], columns: np.ndarray) -> np.ndarray:
    """Weights of the triples ``columns`` (sorted) in each of a bounded list of words."""
    out = np.zeros((len(found), len(columns)), np.float32)
    for row, (index, weight) in enumerate(found):
        at = np.minimum(np.searchsorted(columns, index), len(columns) - 1)
        known = columns[at] == index
        np.add.at(out[row], at[known], weight[known])
    return out


def kernels(found: list[tuple[np.ndarray, np.ndarray]], columns: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
    """Kernel of each word with each landmark, BATCH words at a time, so that the driver never holds them all densely."""
    parts = [dense(found[i : i + BATCH], columns) @ landmarks.T for i in range(0, len(found), BATCH)]
    return np.concatenate([np.zeros((0, len(landmarks)), np.float32), *parts])


def spread(rows: np.ndarray, order: np.ndarray, most: int, alike: float = 0.7) -> list[int]:
    """The first rows along ``order`` of which no two are much alike."""
    chosen: list[int] = []
    for i in order:
        if len(chosen) == most:
            break
        size = float(rows[i] @ rows[i])
        if size > 0 and (not chosen or (rows[chosen] @ rows[i] / np.sqrt(size * (rows[chosen] ** 2).sum(axis=1))).max() < alike):
            chosen.append(int(i))
    return chosen


def windows(symbols: np.ndarray, owner: np.ndarray, weights: np.ndarray, bias: float):
    """For each window size: the text, the margin and the ends of every window, in the stream of all words without spaces; the stream."""
    starts, stops = word_bounds(symbols)
    stream = symbols[symbols > 0]
    text = owner[starts]
    ends = np.cumsum(stops - starts)
    begins = ends - (stops - starts)
    # What the triples that begin before a place and reach ``far`` symbols on add up to: a window takes those that end in it.
    sums = {far: np.zeros(len(stream) + 1) for far in range(2, SPAN + 1)}
    wide = np.concatenate([stream, np.zeros(SPAN, np.uint8)]).astype(np.int32)
    n = len(stream)
    first = wide[:n] * (SYMBOLS * SYMBOLS)
    for near, far in PAIRS:
        sums[far][1:] += weights[first + wide[near : near + n] * SYMBOLS + wide[far : far + n]] * np.float32(LAMBDA ** (far + 1))
    for far in sums:
        np.cumsum(sums[far], out=sums[far])
    for size in range(1, WINDOW + 1):
        count = len(text) - size + 1
        if count <= 0:
            return
        one = text[:count] == text[size - 1 :]
        s, e = begins[:count][one], ends[size - 1 :][one]
        total = sum(run[np.maximum(e - far, s)] - run[s] for far, run in sums.items())
        yield text[:count][one], total / norms(e - s) + bias, s, e, stream


def margins(column: pa.Array, weights: np.ndarray, bias: float) -> np.ndarray:
    """The largest margin of a window, for each whole text."""
    data, ends = text_bytes(column)
    out = np.full(len(ends) - 1, LEAST)
    for i, j in blocks(ends):
        for text, values, _, _, _ in windows(*coded(data, ends, i, j), weights, bias):
            np.maximum.at(out, i + text, values)
    return np.maximum(out, LEAST)


def witnesses(column: pa.Array, weights: np.ndarray, bias: float) -> list[bytes | None]:
    """The symbols of the window of the largest margin among those of 3 to WITNESS symbols, for each whole text."""
    data, ends = text_bytes(column)
    best = np.full(len(ends) - 1, -np.inf)
    out: list[bytes | None] = [None] * len(best)
    for i, j in blocks(ends):
        for text, values, s, e, stream in windows(*coded(data, ends, i, j), weights, bias):
            keep = np.flatnonzero((e - s >= 3) & (e - s <= WITNESS))
            # The last of a text in order of margin, ties to the first place.
            keep = keep[np.lexsort((-s[keep], values[keep], text[keep]))]
            last = keep[np.flatnonzero(np.diff(text[keep], append=-1))]
            for k in last[values[last] > best[i + text[last]]]:
                best[i + text[k]] = values[k]
                out[i + text[k]] = stream[s[k] : e[k]].tobytes()
    return out


def word_column(text: str) -> Column:
    """Lower-case words as the kernel reads them: marks in them are passed over."""
    return F.split(F.regexp_replace(F.lower(F.col(text)), r"[^\p{L}\p{N}\s]+", ""), r"\s+")


def phrase_column(words: str) -> Column:
    """The distinct windows of two to WINDOW words, joined by spaces."""
    def of(size: int) -> Column:
        places = F.sequence(F.lit(1), F.greatest(F.size(words) - size + 1, F.lit(1)))
        return F.transform(places, lambda i: F.array_join(F.slice(F.col(words), i, size), " "))

    return F.array_distinct(F.concat(*(of(size) for size in range(2, WINDOW + 1))))


def fit_svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 60) -> np.ndarray:
    """Linear SVM with squared hinge loss in the primal, by Newton steps on the rows inside the margin."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    ridge = np.eye(len(w))
    ridge[-1, -1] = 1e-6
    for step in range(rounds):
        active = y * (x @ w) < 1
        xa, ca = x[active], weight[active, None]
        new = np.linalg.solve(ridge + COST * xa.T @ (ca * xa), COST * xa.T @ (weight[active] * y[active]))
        if np.allclose(new, w, atol=1e-7):
            break
        w = 0.5 * (w + new) if step > 20 else new
    return w


def fit_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve, by Newton steps on smoothed labels."""
    z = np.column_stack([x, np.ones(len(x))])
    t = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
    w = np.array([1.0, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve(z.T @ (z * (weight * (p * (1 - p) + 1e-6))[:, None]) + 1e-3 * np.eye(2), z.T @ (weight * (t - p)) - 1e-3 * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return float(max(w[0], 1e-3)), float(w[1])


Model = tuple[np.ndarray, float, float, float]


def draw(labelled: DataFrame, toxic: str = "toxic", sample: int = SAMPLE) -> DataFrame:
    """About ``sample`` / 2 rows of each label, by what they hold, with the number of rows that each stands for as ``weight``.

    May be drawn from keys and labels alone, before any text is joined to them.
    """
    label = F.col(toxic).cast("int")
    sizes = {r["y"]: r["n"] for r in labelled.groupBy(label.alias("y")).agg(F.count("*").alias("n")).collect() if r["y"] is not None}
    share = F.lit(0.0)
    for y, n in sizes.items():
        share = F.when(label == y, F.lit(min(1.0, sample / 2 / n))).otherwise(share)
    at = F.xxhash64(*labelled.columns) / F.lit(2.0**64) + 0.5
    rows = labelled.filter(label.isNotNull() & (at < share)).withColumn("weight", F.try_divide(F.lit(1.0), share))
    lost = set(sizes) - {r["y"] for r in rows.select(label.alias("y")).distinct().collect()}
    if lost:
        raise ValueError(f"a sample of the rows labelled {sorted(lost)} is empty: too many of them are equal")
    return rows


def telling(counts: DataFrame) -> list[tuple[str, int]]:
    """Windows that stand in at least 3 toxic texts and in far fewer clean ones (``good`` counts those at their weight)."""
    share = F.col("bad") / (F.col("bad") + F.col("good") + 1)
    found = counts.filter((F.col("bad") >= 3) & (share > 0.6)).orderBy(F.desc("bad"), "window").limit(MARKS).collect()
    return [(r["window"], r["bad"]) for r in found]


def start(rows: DataFrame, base: float) -> tuple[dict[bytes, float], list[bytes]]:
    """Windows to begin with: telling ones with their numbers of toxic texts, and words of clean texts."""
    bad, good = F.sum(F.when(F.col("y") == 1, 1).otherwise(0)), F.sum(F.when(F.col("y") == 0, 1).otherwise(0))
    worded = rows.select("y", word_column("text").alias("words"))
    words = worded.select("y", F.explode(F.array_distinct("words")).alias("window")).filter(F.length("window").between(3, 40))
    counts = staged(words.groupBy("window").agg(bad.alias("bad"), good.alias("good")), "toxicity_words")
    marks = telling(counts)
    clean = counts.filter((F.col("good") > 0) & (F.col("bad") <= 2 * base * (F.col("bad") + F.col("good"))))
    frequent = [r["window"] for r in clean.orderBy(F.desc("good"), "window").limit(5000).collect()]
    others = [r["window"] for r in clean.orderBy(F.xxhash64("window"), "window").limit(VOCABULARY // 3).collect()]

    known = F.array(*(F.lit(w) for w, _ in marks)).cast("array<string>")
    missed = worded.filter((F.col("y") == 1) & ~F.arrays_overlap("words", known))
    phrases = missed.select(F.explode(phrase_column("words")).alias("window")).groupBy("window").agg(F.count("*").alias("bad"))
    phrases = phrases.filter((F.col("bad") >= 3) & F.length("window").between(3, WITNESS))
    wanted = staged(phrases.orderBy(F.desc("bad"), "window").limit(VOCABULARY), "toxicity_phrases")
    if not wanted.isEmpty():
        clean_rows = worded.filter(F.col("y") == 0).select(F.explode(phrase_column("words")).alias("window"))
        seen = clean_rows.join(wanted, "window", "left_semi").groupBy("window").agg(F.count("*").alias("good"))
        marks += telling(wanted.join(seen, "window", "left").fillna(0, ["good"]))
    positive: dict[bytes, float] = {}
    for window, n in marks:
        code = symbols_of(window)
        if len(code) >= 3:
            positive[code] = positive.get(code, 0) + n
    return positive, [c for c in dict.fromkeys(symbols_of(w) for w in [*frequent, *others]) if len(c) >= 3 and c not in positive]


def machine(positive: dict[bytes, float], negative: dict[bytes, float]) -> tuple[np.ndarray, float]:
    """Triple weights and bias of an SVM on Nystroem features, from windows with the number of texts that each speaks for."""
    positive = dict(sorted(positive.items(), key=lambda item: (-item[1], item[0])))
    found = [subsequences(x) for x in [*positive, *negative]]
    # Landmarks come from the most frequent toxic windows; triples that none of these has add nothing to a kernel with one.
    shown = found[: min(len(positive), 4 * LANDMARKS)]
    columns = np.unique(np.concatenate([i for i, _ in shown]))
    landmarks = dense(shown, columns)
    landmarks = landmarks[spread(landmarks, np.arange(len(shown)), LANDMARKS)]
    close = kernels(found[len(positive) :], columns, landmarks).max(axis=1, initial=0)
    nearest = dense([found[len(positive) + k] for k in np.argsort(-close, kind="stable")[: 4 * LANDMARKS]], columns)
    phi = np.concatenate([landmarks, nearest[spread(nearest, np.arange(len(nearest)), LANDMARKS)]])
    values, vectors = np.linalg.eigh((phi @ phi.T).astype(float) + 1e-3 * np.eye(len(phi)))
    root = vectors / np.sqrt(values) @ vectors.T
    features = kernels(found, columns, phi) @ root
    y = np.concatenate([np.ones(len(positive)), -np.ones(len(negative))])
    # Windows of many texts weigh more; those of a few stand there by chance, more often than not.
    often = np.clip(np.array(list(positive.values()), float) / 5, 0.2, 20)
    w = fit_svm(features, y, np.concatenate([often, np.clip(np.array(list(negative.values()), float), 1, 20)]))
    weights = np.zeros(SYMBOLS**3, np.float32)
    weights[columns] = (root @ w[:-1]) @ phi
    return weights, float(w[-1])


def learn(labelled: DataFrame, text: str = "text", toxic: str = "toxic", weight: str | None = None, sample: int = SAMPLE) -> Model:
    """Triple weights, bias, slope and offset, from texts with a 0/1 label.

    Unless ``weight`` says that the rows are a sample already (see :func:`draw`), one is drawn.
    """
    rows = labelled.select(F.coalesce(F.col(text), F.lit("")).alias("text"), F.col(toxic).cast("int").alias("y"),
                           *([F.col(weight).alias("weight")] if weight else []))
    rows = staged(rows if weight else draw(rows, "y", sample), "toxicity_sample")
    n, bad = rows.agg(F.sum("weight"), F.sum(F.col("weight") * F.col("y"))).first()
    base = bad / n if n else 0.0
    flat = (np.zeros(SYMBOLS**3, np.float32), 0.0, 0.0, float(np.log(base / (1 - base))) if 0 < base < 1 else (30.0 if base else -30.0))
    positive, words = start(rows, base) if 0 < base < 1 else ({}, [])
    if not positive or not words:
        return flat
    context = rows.sparkSession.sparkContext
    negative = dict.fromkeys(words, 1.0)
    held = context.broadcast(machine(positive, negative))

    def shown(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(witnesses(batch.column("text"), *held.value), pa.binary()), batch.column("y")], ["window", "y"])

    for _ in range(ROUNDS):
        best = rows.select("text", "y").mapInArrow(shown, "window binary, y int").filter("window IS NOT NULL")
        texts = best.groupBy("window").agg(F.sum("y").alias("bad"), F.sum(1 - F.col("y")).alias("good")).orderBy(F.desc("bad"), "window").collect()
        # A window that most texts with it say is clean is not what makes the others toxic.
        positive = {bytes(r["window"]): float(r["bad"]) for r in texts if r["bad"] > r["good"]}
        negative |= {bytes(r["window"]): float(r["good"]) for r in texts if r["good"] >= max(r["bad"], 1)}
        for window in positive:
            negative.pop(window, None)
        if not positive:
            return flat
        held = context.broadcast(machine(positive, negative))

    def judged(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(margins(batch.column("text"), *held.value)), batch.column("y"), batch.column("weight")], ["x", "y", "w"])

    seen = rows.select("text", "y", "weight").mapInArrow(judged, "x double, y int, w double").toPandas()
    slope, offset = fit_curve(seen["x"].to_numpy(float), seen["y"].to_numpy(float), seen["w"].to_numpy(float))
    return *held.value, slope, offset


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` without its text, with score and predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    wanted = [c for c in docs.columns if c not in (text, "score", "predicted")]

    def judged(batches):
        weights, bias, slope, offset = shared.value
        for batch in batches:
            x = margins(batch.column(text), weights, bias)
            p = 1 / (1 + np.exp(-np.clip(slope * x + offset, -30, 30)))
            kept = [batch.column(c) for c in wanted]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(p), pa.array((p >= 0.5).astype(np.int32))], [*wanted, "score", "predicted"])

    fields = [*(docs.schema[c] for c in wanted), T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    return docs.mapInArrow(judged, T.StructType(fields))
