"""Fill-in-the-middle against a plain version in Python, and back."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from transferlens.llm import fill_in_middle as fim

SCHEMA = "doc_id bigint, text string, n string, form string, h1 int"


def plain_version(key, text):
    text = text or ""
    h = [int(hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "<P>" + text[:a], "<M>" + text[a:b], "<S>" + text[b:]
    spm = h[3] % 100 < 20
    return n, "spm" if spm else "psm", a, b - a, suffix + prefix + middle if spm else prefix + suffix + middle


@pytest.mark.parametrize("most", [fim.MOST, 7])
def test_whole_texts_and_back(spark, most):
    rng = random.Random(2)
    texts = ["", None, "a", "é", "\n", "a\r\nb\n", "𝒳🦆é‍", "x<P>y", "<S>", "a<M", "<P><", "P>" * 9, "<S" * 5, "long " * 60_000 + "🦆", "\x00\x0b "]
    texts += ["".join(rng.choice("ab<>PSMé🦆\n ") for _ in range(rng.randint(0, 40))) for _ in range(300)]
    rows = [*enumerate(texts, -3), (None, "no key"), (5, "a twin"), (5, "a twin"), (6, "a" * 21)]
    df = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA).repartition(3)
    out = fim.fill_in_middle(df, most=most).withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    assert sorted(map(repr, ((r.key, r.back) for r in out))) == sorted(map(repr, ((k, t or "") for k, t in rows)))
    want = [(k, *plain_version(k, t)) for k, t in rows]
    assert sorted(map(repr, ((r.key, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in out))) == sorted(map(repr, want))
    assert {r.form for r in out} == {"plain", "psm", "spm"}
    assert fim.fill_in_middle(df.limit(0)).count() == 0


@pytest.mark.parametrize("most", [3, 1000])
def test_other_units_and_markers(spark, most):
    marks = ("[pre]", "[suf]", "[mid]")
    rows = [(i, " ".join(f"word{k}" for k in range(i))) for i in range(1, 30)] + [(30, "two  spaces break it")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = fim.fill_in_middle(df, markers=marks, unit=r"\w+ ?", changed=100, most=most).withColumn("back", fim.restored(F.col("output"), F.col("form"), marks))
    for r in out.collect():
        text = dict(rows)[r.key]
        assert r.back == text
        if r.key == 30:
            assert (r.n, r.form, r.output) == (None, "plain", text)
            continue
        assert r.n == r.key and r.form != "plain"
        for cut in (r.prefix_chars, r.prefix_chars + r.middle_chars):
            assert cut in (0, len(text)) or text[cut - 1] == " "


def test_ends_are_those_of_every_repetition():
    for most in (4, 5, 100):
        pattern = fim.repeated(r"ab|c", most)
        n, end = fim.measured(pattern, "abcabcc")
        assert n == 5 and [end(k) for k in range(6)] == [0, 2, 3, 5, 6, 7]
        assert fim.measured(pattern, "abx") is None and fim.measured(pattern, "")[0] == 0
