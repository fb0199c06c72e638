"""The string kernel and the windows against brute force; phrases, split insults and rare labels."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from transferlens.llm import toxicity
from transferlens.llm.common import held_out

ROWS = "doc_id bigint, text string, toxic int"


def said(spark, model, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    return [found[i] for i in range(len(texts))]


def slow_weights(code: bytes) -> dict[int, float]:
    """Every common choice of three places of a window, by its symbols."""
    out: dict[int, float] = {}
    for i, j, k in itertools.combinations(range(len(code)), 3):
        if k - i <= toxicity.SPAN:
            at = code[i] * 64 * 64 + code[j] * 64 + code[k]
            out[at] = out.get(at, 0.0) + toxicity.LAMBDA ** (k - i + 1)
    most = sum(toxicity.LAMBDA ** (2 * (k - i + 1)) for i, j, k in itertools.combinations(range(len(code)), 3) if k - i <= toxicity.SPAN)
    return {at: w / max(np.sqrt(most), 1e-9) for at, w in out.items()}


@pytest.mark.parametrize("word", ["idiot", "idxiot", "aaaaaa", "ab", "a", "blockhead", "gojumplakegojumplake" * 2, "mañana9"])
def test_kernel_of_a_window(word):
    code = toxicity.symbols_of(word)
    index, weight = toxicity.subsequences(code)
    found: dict[int, float] = {}
    for i, w in zip(index, weight):
        found[int(i)] = found.get(int(i), 0.0) + w
    assert found == pytest.approx(slow_weights(code))


def test_margins_and_witnesses_of_whole_texts():
    rng = random.Random(4)
    weights = np.random.default_rng(4).normal(size=64**3).astype(np.float32)
    texts = [" ".join("".join(rng.choice("abcdeé.7") for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(0, 14))) for _ in range(60)]
    texts += ["", None, " \n", "...", "a b c", "i d i o t", "ab"]
    column = pa.array(texts, pa.string())
    margins, best = toxicity.margins(column, weights, 0.25), toxicity.witnesses(column, weights, 0.25)
    data, ends = toxicity.text_bytes(column)
    for t in range(len(texts)):
        symbols, _ = toxicity.coded(data, ends, t, t + 1)
        words = [w for w in symbols.tobytes().split(b"\0") if w]
        windows = [b"".join(words[i : i + k]) for k in range(1, toxicity.WINDOW + 1) for i in range(len(words) - k + 1)]
        values = {w: sum(weights[at] * x for at, x in slow_weights(w).items()) + 0.25 for w in windows}
        assert margins[t] == pytest.approx(max([toxicity.LEAST, *values.values()]), abs=1e-4)
        shown = [w for w in windows if 3 <= len(w) <= toxicity.WITNESS]
        assert (best[t] is None) == (not shown)
        if shown:
            assert values[best[t]] == pytest.approx(max(values[w] for w in shown), abs=1e-4)


def test_phrases_of_harmless_words(spark):
    """Each word of the insult stands in clean texts just as often; only the three in a row tell."""
    rng = random.Random(2)
    clean = ["".join(rng.choice(["an", "er", "on", "th", "in", "ea", "st"]) for _ in range(3)) for _ in range(300)]
    rows = []
    for i in range(600):
        words = [rng.choice(clean) for _ in range(25)]
        if i % 3 == 0:
            words[9:9] = ["go", "jump", "lake"]
        else:
            for word in ("go", "jump", "lake"):
                words.insert(rng.randrange(len(words) // 3) * 3, word)
        rows.append((i, " ".join(words), int(i % 3 == 0)))
    model = toxicity.learn(spark.createDataFrame(rows, ROWS))
    scores = said(spark, model, ["an er go jump lake thin", "go jump lake", "lake an er jump on th go in", " ".join(clean[:60]), ""])
    assert min(scores[:2]) > 0.5 > max(scores[2:])


def test_insults_in_pieces_and_learning_twice(spark):
    rng = random.Random(1)
    clean = ["".join(rng.choice(["an", "er", "on", "th", "in", "ea", "st"]) for _ in range(3)) for _ in range(300)]
    rows = [(i, " ".join([*rng.choices(clean, k=30), *(["blockhead"] if i % 4 == 0 else []), *rng.choices(clean, k=5)]), int(i % 4 == 0)) for i in range(400)]
    labelled = spark.createDataFrame(rows, ROWS)
    model, again = toxicity.learn(labelled), toxicity.learn(labelled.repartition(7))
    texts = ["blo ck he ad", "you bl ock head", "b l o c k h e a d", "blockxhead", "block.head", " ".join(clean), None]
    scores = said(spark, model, texts)
    assert min(scores[:5]) > 0.5 > max(scores[5:])
    assert said(spark, again, texts) == pytest.approx(scores, abs=1e-6)


def test_labels_that_tell_nothing(spark):
    def scores(rows):
        return said(spark, toxicity.learn(spark.createDataFrame(rows, ROWS)), ["any text", "", None])

    texts = ["one two three", None, ""]
    assert scores([]) == pytest.approx([0.0] * 3, abs=1e-9)
    assert scores([(i, t, 1) for i, t in enumerate(texts)]) == pytest.approx([1.0] * 3, abs=1e-9)
    assert scores([(i, t, None) for i, t in enumerate(texts)]) == pytest.approx([0.0] * 3, abs=1e-9)
    assert scores([(i, "equal text here", i % 4 // 3) for i in range(400)]) == pytest.approx([0.25] * 3, abs=0.01)


def test_sample_keeps_rare_labels_and_their_weight(spark):
    labels = spark.range(20_000).select("id", F.when(F.col("id") % 1000 == 0, 1).otherwise(0).alias("toxic"))
    drawn = toxicity.draw(labels, sample=2000)
    found = {r.toxic: (r.n, r.w) for r in drawn.groupBy("toxic").agg(F.count("*").alias("n"), F.sum("weight").alias("w")).collect()}
    assert found[1] == (20, 20.0)
    assert 850 < found[0][0] < 1150 and found[0][1] == pytest.approx(19_980, rel=0.15)
    same = spark.range(5000).select(F.lit(1).alias("key"), F.lit(0).alias("toxic"))
    try:
        assert toxicity.draw(same, sample=10).count() == 5000
    except ValueError as error:
        assert "empty" in str(error)


def test_scores_replace_columns_and_repeat(spark):
    model = toxicity.learn(spark.createDataFrame([(i, "bad thing" if i % 2 else "good day", i % 2) for i in range(60)], ROWS))
    docs = spark.createDataFrame([(1, "bad thing", "x", 3)] * 3 + [(None, None, None, None)], "doc_id bigint, text string, score string, predicted int")
    rows = toxicity.score(docs, model).collect()
    assert len({r.score for r in rows if r.doc_id == 1}) == 1 and all(0 <= r.score <= 1 for r in rows) and rows[0].predicted == 1
    assert rows[0].asDict().keys() == {"doc_id", "score", "predicted"}
    assert toxicity.score(docs.limit(0), model).isEmpty()


def test_held_out_texts(spark):
    """Gapped, split and plain insults among 5 % toxic texts; the fold that is not learned from is told apart."""
    rng = random.Random(6)
    clean = ["".join(rng.choice(["an", "er", "on", "th", "in", "ea", "st", "ru", "ol"]) for _ in range(rng.randint(1, 4))) for _ in range(500)]
    forms = ["blockhead", "b.lockhead", "blockxhead", "numskull", "num skull", "dim wit", "dimwit"]
    rows = [(i, " ".join([*rng.choices(clean, k=40), *([rng.choice(forms)] if i % 20 == 0 else []), *rng.choices(clean, k=20)]), int(i % 20 == 0)) for i in range(3000)]
    docs = spark.createDataFrame(rows, ROWS).repartition(4)
    fold = held_out("doc_id", 5, 0)
    model = toxicity.learn(docs.filter(~fold))
    found = toxicity.score(docs.filter(fold).select("doc_id", "text", "toxic"), model).toPandas()
    ranks, bad = found["score"].rank(), found["toxic"] == 1
    area = (ranks[bad].sum() - bad.sum() * (bad.sum() + 1) / 2) / (bad.sum() * (~bad).sum())
    assert area > 0.99 and ((found["predicted"] == 1) == bad).mean() > 0.99
