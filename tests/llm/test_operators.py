"""Each operator on a small table that holds its edge cases, against brute force where SQL cannot express it."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from transferlens.llm import (
    anchors, content_sort, decontamination, language, mixing, probminhash, suffixes, toxicity, url_trees, wavelet,
)
from transferlens.llm.common import about, held_out
from transferlens.session import shared_folder

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, row string, score double"


def sentence(rng, n, words):
    return " ".join(rng.choice(words) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 7))) for _ in range(400)]
    plain = [sentence(rng, rng.randint(1, 60), words) for _ in range(40)]
    shared = sentence(rng, 30, words)
    long = sentence(rng, 3000, words)
    near = long.split()
    near[100] = "changed"
    extra = [f"{plain[0]} {shared}", f"{shared} {plain[1]}", f"x{shared}\t{plain[2]}", plain[3], plain[3], plain[3].replace(" ", " \n"),
             "", None, "   ", "é" * 80, "é" * 80 + "z", long, " ".join(near), shared, shared.upper()]
    return dict(enumerate(plain + extra, 3))


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en" if i % 2 else "de", ("a", "b", None)[i % 3], None, "k", "r", 1.0) for i, t in texts.items()]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_key(df, key="key"):
    return {r[key]: r for r in df.collect()}


def removed(sequences, length):
    first, out = {}, {}
    for i, s in sorted(sequences.items()):
        for k in range(len(s) - length + 1):
            first.setdefault(tuple(s[k : k + length]), i)
    for i, s in sequences.items():
        gone = [False] * len(s)
        for k in range(len(s) - length + 1):
            if first[tuple(s[k : k + length])] < i:
                gone[k : k + length] = [True] * length
        out[i] = gone
    return out


def test_fixed_blocks_against_brute_force(docs, texts, empty):
    words = {i: re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode()) for i, t in texts.items()}
    found, gone = by_key(anchors.remove_repeats(docs)), removed(words, 13)
    assert set(found) == set(texts) and any(map(any, gone.values()))
    for i, s in words.items():
        kept = b" ".join(w for w, g in zip(s, gone[i]) if not g)
        assert (found[i].n_words, found[i].n_removed, found[i].kept_sha256) == (len(s), sum(gone[i]), hashlib.sha256(kept).hexdigest())
    assert anchors.remove_repeats(empty).count() == 0


def test_suffixes_against_brute_force(docs, texts, empty):
    data = {i: (t or "").encode() for i, t in texts.items()}
    found, gone = by_key(suffixes.remove_repeats(docs)), removed(data, 50)
    assert set(found) == set(texts) and any(map(any, gone.values()))
    for i, s in data.items():
        kept = bytes(b for b, g in zip(s, gone[i]) if not g)
        spans = sum(g and not (k and gone[i][k - 1]) for k, g in enumerate(gone[i]))
        row = found[i]
        assert (row.n_bytes, row.n_removed, row.n_spans, row.kept_sha256) == (len(s), sum(gone[i]), spans, hashlib.sha256(kept).hexdigest())
    assert suffixes.remove_repeats(empty).count() == 0


@pytest.mark.parametrize("chunk", [1 << 20, 1])
def test_repeats_compare_ids_and_not_places(spark, monkeypatch, chunk):
    monkeypatch.setattr(anchors.repeats, "CHUNK", chunk)
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(200)]
    one, two = sentence(rng, 30, words), sentence(rng, 30, words)
    rows = [(1, f"first {one}"), (1, f"second {one}"), (None, f"third {two}"), (None, f"fourth {two}"), (2, f"fifth {one}")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    for found in (anchors.remove_repeats(docs), suffixes.remove_repeats(docs)):
        gone = sorted((r.key or 9, r.n_removed > 0) for r in found.collect())
        assert gone == [(1, False), (1, False), (2, True), (9, False), (9, False)]


def test_the_cover_meets_every_difference():
    assert {(a - b) % suffixes.CYCLE for a in suffixes.COVER for b in suffixes.COVER} == set(range(suffixes.CYCLE))


def test_content_sort(docs, texts, empty):
    found = by_key(content_sort.exact_groups(docs, partitions=4))
    groups = {}
    for i, t in sorted(texts.items()):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(i)
    for norm, ids in groups.items():
        for i in ids:
            row = found[i]
            assert (row.keep, row.group_size, row.kept) == (ids[0], len(ids), i == ids[0])
            assert row.text_sha256 == hashlib.sha256(norm.encode()).hexdigest()
    twice = content_sort.exact_groups(docs.union(docs))
    assert twice.filter("kept").count() == len(groups)
    assert content_sort.exact_groups(empty).count() == 0
    kept = content_sort.drop_copies(docs.union(docs))
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(ids[0] for ids in groups.values())


def test_drop_copies_of_null_and_repeated_keys(spark):
    rows = [(None, "alone"), (1, "a"), (1, "b"), (0, "b"), (None, "a  a"), (None, "a a"), (3, None), (2, "")]
    kept = content_sort.drop_copies(spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, sha string"))
    assert kept.columns == ["doc_id", "text", "sha"]
    found = sorted(((r.doc_id, re.sub(r"\s+", " ", r.text or "")) for r in kept.collect()), key=str)
    assert found == sorted([(None, "alone"), (1, "a"), (0, "b"), (None, "a a"), (2, "")], key=str)


def test_near_dedup_keeps_texts_that_share_a_key(spark):
    rng = random.Random(12)
    words = [f"w{k}" for k in range(300)]
    one, two, three = (sentence(rng, 40, words) for _ in range(3))
    rows = [(1, one), (1, two), (1, two), (2, two), (2, three), (3, one), (None, one), (None, two), (4, f"{three} more")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, id string").repartition(2)
    kept = probminhash.drop_near(docs)
    found = [(r.doc_id, r.text) for r in kept.collect()]
    assert kept.columns == docs.columns and {t for k, t in found if k is not None} in ({one, two, three}, {one, two, f"{three} more"})
    assert sum(k is not None for k, _ in found) == 3 and sum(k is None for k, _ in found) == 2
    classes = probminhash.near_classes(docs).collect()
    assert len(classes) == len(rows) and {r.key for r in classes} == {1, 2, 3, 4, None}
    assert len({r.class_id for r in classes if r.key is not None}) <= 3 and all(r.class_id <= 4 for r in classes if r.key is not None)


def test_samples_are_never_empty(spark, monkeypatch):
    df = spark.range(5000).select(F.col("id").alias("key"), (F.col("id") % 50 == 0).cast("string").alias("lang"))
    assert 50 < about(df, 100).count() < 200 and about(df, 5000).count() == 5000
    sizes = {r.lang: r["count"] for r in about(df, 200, "lang").groupBy("lang").count().collect()}
    assert sizes["true"] == 100 and 100 < sizes["false"] < 300
    monkeypatch.setattr(type(df), "count", lambda self: 10**11)
    # One row in five million, so 5,000 rows mostly have none; a share of 0 would leave out every row of any table.
    with pytest.raises(ValueError, match="empty"):
        about(df, 20_000)
    share = (20_000 << 64) // 10**11
    assert 0 < share < 1 << 64


def near_labels(texts):
    def shingles(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} - {()}

    sets, label = {i: shingles(t) for i, t in texts.items()}, {i: i for i in texts}
    for a in texts:
        for b in texts:
            both = sets[a] & sets[b]
            if (texts[a] or "") == (texts[b] or "") or both and len(both) >= 0.8 * len(sets[a] | sets[b]):
                low, high = sorted((label[a], label[b]))
                label = {i: low if x == high else x for i, x in label.items()}
    return label


def test_near_classes_of_large_buckets_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(probminhash, "BLOCK", 20)
    rng = random.Random(11)
    base = [f"w{k}" for k in range(120)]
    texts = {}
    for i in range(150):
        words = list(base)
        for k in rng.sample(range(120), rng.choice([1, 2, 3, 4, 5])):
            words[k] = f"other{rng.randint(0, 3)}"
        texts[i] = " ".join(words)
    label = near_labels(texts)
    assert 3 < len(set(label.values())) < 100
    found = by_key(probminhash.near_classes(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")))
    assert {i: r.class_id for i, r in found.items()} == label


def test_near_classes_against_brute_force(docs, texts, empty):
    label = near_labels(texts)
    found = by_key(probminhash.near_classes(docs))
    assert {i: r.class_id for i, r in found.items()} == label and len(set(label.values())) < len(label)
    assert probminhash.near_classes(empty).count() == 0
    kept = probminhash.drop_near(docs.union(docs))
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(set(label.values()))


def test_signatures_estimate_weighted_similarity():
    owner = np.repeat([0, 1], 300)
    hashes = probminhash.repeats.mixed(np.concatenate([np.arange(300), np.arange(60, 360)]).astype(np.uint64))
    who = probminhash.signatures(owner, hashes, np.ones(600, np.int64), 2)
    assert abs((who[0] == who[1]).mean() - 240 / 360) < 0.17 and (who > 0).all()


@pytest.mark.parametrize("share,often", [(0, 1), (2, 100), (4, 100), (2, 1000), (4, 1000)])
def test_unequal_repeats_do_not_hide_near_copies(share, often):
    """Pairs of a plain Jaccard similarity of 0.8, of which one text repeats a part of its shingles, meet in a band."""
    pairs, rng = 400, np.random.default_rng(share + often)
    owner, hashes, n = [], [], []
    for i in range(pairs):
        names = probminhash.repeats.mixed(rng.integers(0, 1 << 62, 100).astype(np.uint64))
        for text, own in enumerate((names[:90], np.concatenate([names[:80], names[90:]]))):
            owner.append(np.full(len(own), 2 * i + text))
            hashes.append(own)
            times = np.ones(len(own), np.int64)
            if share and text:
                times[:: share] = often
            n.append(times)
    bands = probminhash.band_hashes(np.concatenate(owner), np.concatenate(hashes), np.concatenate(n), 2 * pairs)
    assert bands.shape == (2 * pairs, probminhash.BANDS)
    assert (bands[::2] == bands[1::2]).any(axis=1).mean() >= 0.99


def test_templates(spark, docs, empty):
    item = "the train leaves Paris at 10 km per hour and then meets Anna Smith after 30 minutes of slow travel"
    other = "the train leaves Rome at 25 km per hour and then meets Bob after 7 minutes of slow travel"
    broken = "the sum of 3 and 3 is then shared by 3 friends who each get 3 parts"
    items = spark.createDataFrame([(1, item), (2, broken), (3, None), (4, "too short")], "item_id bigint, text string")
    rows = [(100, f"before it. {item}, after it"), (101, f"more text here {other} end"), (102, broken.replace("3", "8")),
            (103, "the sum of 4 and 5 is then shared by 6 friends who each get 7 parts"), (104, "the train leaves")]
    more = docs.select("doc_id", "text").union(spark.createDataFrame(rows, "doc_id bigint, text string"))
    found = by_key(decontamination.judged(more, items))
    assert {i: r.item for i, r in found.items() if r.contaminated} == {100: 1, 101: 1, 102: 2}
    assert {r.doc_id for r in decontamination.drop_leaks(more, items).collect()} == set(found) - {100, 101, 102}
    assert decontamination.judged(empty, items).count() == 0
    assert decontamination.judged(docs, items.limit(0)).filter("contaminated").count() == 0


def test_templates_take_names_anywhere_and_any_case(spark):
    item = "Tom has 5 apples. Mary gives him 3 more apples, then asks: how many does he hold now?"
    fair = "the train leaves Paris at 10 km per hour and then meets Anna Smith after 30 minutes of slow travel"
    heading = "The Quick Brown Fox And Its Seven Lazy Friends Share A Small House"
    items = spark.createDataFrame([(1, item), (2, fair), (3, heading)], "item_id bigint, text string")
    other = item.replace("Tom", "Bob").replace("Mary", "Anna").replace("5", "8")
    rows = [(1, other), (2, f'He read: "{other}"'), (3, fair.title()), (4, fair.upper()), (5, fair.lower()), (6, heading.lower()),
            (7, "Many Other Words Stand Here In Title Case, And None Of Them Is Ever Asked About In Any Item"), (8, "Bob runs. Anna sings loud songs, then asks: who does he hold now?")]
    found = by_key(decontamination.judged(spark.createDataFrame(rows, "doc_id bigint, text string"), items))
    assert {i: r.item for i, r in found.items() if r.contaminated} == {1: 1, 2: 1, 3: 2, 4: 2, 5: 2, 6: 3}


def test_slots_outside_matched_windows_are_no_evidence(spark):
    item = ("a pipe of 5 km runs from the hill down to the old town where every house takes water for its own kitchen and bath and "
            "garden so that all of them use what another pipe of 5 km length would hold in the same time")
    rows = [(1, item.replace("old town", "very old town")), (2, item.replace("old town", "town")),
            (3, item.replace("5", "9").replace("old town", "very old town")), (4, item.replace("of 5", "of 7", 1).replace("old town", "mill town"))]
    items = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    found = by_key(decontamination.judged(spark.createDataFrame(rows, "doc_id bigint, text string"), items))
    assert {i for i, r in found.items() if r.contaminated} == {1, 2, 3}


def test_long_runs_of_names_and_numbers(spark):
    item = "the old train leaves Paris at 10 km per hour and then meets Anna Smith after 30 minutes of slow travel"
    runs = ["and " + "Aa " * 5000, "Aa " * 5000, "1.2," * 5000, "12 km " * 5000, "x" * 50_000, "1" * 50_000, "É" * 50_000]
    rows = [(i, f"{run} {item} {run}") for i, run in enumerate(runs)] + [(i + 100, run) for i, run in enumerate(runs)]
    items = spark.createDataFrame([(1, item), (2, "Aa " * 2000), (3, "1.2," * 5000), (4, "12 " * 2000)], "item_id bigint, text string")
    found = by_key(decontamination.judged(spark.createDataFrame(rows, "doc_id bigint, text string"), items))
    assert {i for i, r in found.items() if r.item == 1} == set(range(len(runs)))


def test_windows_of_placeholders_alone_say_nothing(spark):
    count = " ".join(str(i) for i in range(1, 13))
    items = spark.createDataFrame([("a", count), ("b", "Anna Bob 12 km Carl Dora 13 km Emil 14 kg"), (None, "take the third root of 12 and add 5 to it")], "item_id string, text string")
    rows = [(1, "the years 1901 1902 1903 1904 1905 1906 follow"), (2, f"count with me {count} and so on"), (3, "Rita Sam 1 km Tom Uwe 2 km Vera 3 kg"),
            (4, "they say Anna Bob 12 km Carl Dora 13 km Emil 14 kg"), (5, "take the third root of 99 and add 7 to it"), (6, " ".join(str(i * 7) for i in range(3000)))]
    found = by_key(decontamination.judged(spark.createDataFrame(rows, "doc_id bigint, text string"), items))
    assert {i: (r.item, r.similarity) for i, r in found.items() if r.contaminated} == {2: ("a", 1.0), 4: ("b", 1.0), 5: (None, 1.0)}
    assert {i for i, r in found.items() if r.similarity is not None} == {2, 4, 5}
    kept = decontamination.drop_leaks(spark.createDataFrame(rows, "doc_id bigint, text string"), items)
    assert {r.doc_id for r in kept.collect()} == {1, 3, 6}


def test_template_ids_may_repeat_or_be_null(spark):
    items = spark.createDataFrame([(1, "one item asks what the old man has seen"), (1, "another one asks where his dog has been"), (1, "one item asks what the old man has seen")], "item_id int, text string")
    rows = [(None, "here another one asks where his dog has been"), (None, "nothing of the kind"), (7, "one item asks what the old man has seen"), (8, None), (9, "")]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id int, text string, item int, form string")
    found = {(r.key, r.contaminated, r.item) for r in decontamination.judged(docs, items).collect()}
    assert found == {(None, True, 1), (7, True, 1), (8, False, None), (9, False, None)}
    kept = decontamination.drop_leaks(docs, items)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [8, 9]


def test_mix_follows_targets(docs, empty):
    rows = mixing.plan(docs).collect()
    assert all(0 <= r.copies <= 2 for r in rows) and sum(r.target for r in {r.source: r for r in rows}.values()) == pytest.approx(
        1.5 * sum(r.size for r in rows))
    most = max(r.size for r in rows)
    for source in {r.source for r in rows}:
        own = [r for r in rows if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 2 * most
    assert sorted(map(str, rows)) == sorted(map(str, mixing.plan(docs).collect()))
    mixed = mixing.mix(docs.union(docs.limit(5)))
    assert mixed.columns == docs.columns and mixed.count() > 0
    assert mixing.plan(empty).count() == 0 and mixing.mix(empty).count() == 0


def test_targets_share_the_excess(spark):
    sized = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 1000), (None, 0)], "source string, size bigint")
    found = {r.source: r.target for r in mixing.targets(sized).collect()}
    left = 1.5 * 2010 - 20
    assert found == {"a": 20, None: 0, "b": pytest.approx(left * 2 / 3), "c": pytest.approx(left / 3)}


def test_url_rules_and_parts(spark):
    rules = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1")]
    urls = ["HTTP://WWW.Example.ORG/en/1?x=/", "http://example.org/en/2#a/b", "https://notexample.org/es/", "example.org/es/", None,
            "http://a.org", "http://a.net?b=c", "http://a.net/" + "p/" * 5000]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    found = by_key(url_trees.judge(pages, rules, trees=2))
    assert [found[i].rule for i in range(8)] == ["example.org/en/1", "org/", "org/", None, None, None, None, None]
    assert (found[0].host, found[0].path) == ("www.example.org", "/en/1") and (found[5].host, found[5].path) == ("a.org", "")
    assert (found[3].host, found[4].path, found[6].path) == ("", "", "") and {r.verdict for r in found.values()} <= {"allow", "block"}
    assert url_trees.judge(pages.limit(0), rules).count() == 0


@pytest.mark.parametrize("most", [url_trees.BROADCAST, 0])
def test_url_suffix_rates_cover_all_judged_pages(spark, monkeypatch, most):
    monkeypatch.setattr(url_trees, "BROADCAST", most)
    rules = [("allow", "good.org/"), ("block", "bad.org/"), ("block", "bad.net/"), ("allow", "good.net/")]
    urls = [f"http://{host}/{i}" for host in ("good.org", "bad.org", "bad.net", "good.net") for i in range(60)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    rows = url_trees.by_rule(url_trees.parts(pages), rules).withColumn("label", (F.col("ruled") == "block").cast("double"))
    known = url_trees.block_rates(url_trees.lexical(rows), 0.5)
    assert {r.last_two: r.last_two_rate for r in known["last_two"].collect()} == {
        "good.org": pytest.approx(5 / 70), "bad.org": pytest.approx(65 / 70), "bad.net": pytest.approx(65 / 70), "good.net": pytest.approx(5 / 70)}
    seen, learn = [], url_trees.with_rates
    monkeypatch.setattr(url_trees, "with_rates", lambda df, rates, base: seen.append((rates, base)) or learn(df, rates, base))
    assert url_trees.judge(pages, rules, sample=3, trees=1).count() == len(urls)
    assert all(base == 0.5 and rates["last_two"].count() == 4 for rates, base in seen) and len(seen) == 2


def test_token_files_round_trip(docs, texts, empty):
    tokenizers = pytest.importorskip("tokenizers")
    public = pytest.importorskip("public_tokenizers")
    file = public.path("word_bpe_49k.json")
    whole = tokenizers.Tokenizer.from_file(file)
    found, start = by_key(wavelet.encode_documents(docs, file)), 0
    for i, t in sorted(texts.items()):
        ids = np.array([*whole.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        assert (found[i].start, found[i].n_tokens, found[i].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert wavelet.encode_documents(empty, file).count() == 0


def test_token_files_of_null_keys_repeated_rows_and_long_texts(spark):
    tokenizers = pytest.importorskip("tokenizers")
    file = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")
    whole = tokenizers.Tokenizer.from_file(file)
    rng = random.Random(6)
    odd = ["".join(rng.choice("aB'9<|>.é \n\x0b\x1fstΣ") for _ in range(60)) for _ in range(200)]
    odd += ["it's don't ''s a's,'s <|endoftext|> <| x<|startoftext|>y ABC'RE", "12a3 $5.00 !!..", "ﬁ\u00a0x\u2028y e\u0301"]
    rows = [(None, "no key"), (None, "nor here"), (1, "twin text"), (1, "twin text"), (2, "long text " * 2000), (3, "end")] + list(enumerate(odd, 10))
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id bigint, text string, shard string, n_tokens int").repartition(3)
    path = shared_folder(spark, "shards")
    wavelet.write_shards(docs, file, path, tokens=500)
    found, start = wavelet.read_documents(spark, path).orderBy("start").collect(), 0
    assert [r.key for r in found] == sorted((k for k, _ in rows), key=lambda k: (k is not None, k))
    want = {}
    for key, text in rows:
        ids = np.array([*whole.encode(text, add_special_tokens=False).ids, 1], "<u4")
        want.setdefault(key, []).append((len(ids), zlib.crc32(ids.tobytes())))
    got = {}
    for r in found:
        assert r.start == start
        start += r.n_tokens
        got.setdefault(r.key, []).append((r.n_tokens, r.ids_crc32))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}


def test_wavelet_access_count_and_lookup():
    ids = np.random.default_rng(3).integers(0, 37, 20_000).astype(np.uint32) * 1000
    shard = wavelet.Shard(wavelet.record(0, [1, None], np.array([5000, 15_000]), ids))
    assert (shard.tokens() == ids).all() and shard.nulls.tolist() == [False, True]
    assert [shard.access(i) for i in (0, 4096, 19_999)] == ids[[0, 4096, 19_999]].tolist()
    places = np.flatnonzero(ids == 5000)
    assert shard.count(5000) == len(places) and shard.count(5000, 9000) == (places < 9000).sum() and shard.count(7) == 0
    assert [shard.occurrence(5000, n) for n in (0, 100, len(places))] == [places[0], places[100], -1]


def test_language_learns_from_its_fold(spark, sf_dir, docs, empty):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    fold = held_out("doc_id", 4, 2)
    langs, matrix = language.learn(rows, ~fold)
    judged = language.predict(rows.filter(fold), langs, matrix)
    assert judged.filter("lang = lang_pred").count() >= 0.95 * judged.count()
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 !?"), (4, "der"), (5, "und " * 100_000)], "doc_id bigint, text string")
    found = by_key(language.predict(odd, langs, matrix), "doc_id")
    assert [found[i].lang_pred == "und" for i in range(1, 6)] == [True, True, True, False, False]
    assert all(0 <= r.score <= 1 for r in found.values())
    none, nothing = language.learn(empty, F.lit(True))
    assert none == [] and {r.lang_pred for r in language.predict(odd, none, nothing).collect()} == {"und"}


def test_toxicity_catches_gapped_words(spark, empty):
    rng = random.Random(1)
    clean = ["".join(rng.choice(["an", "er", "on", "th", "in", "ea", "st"]) for _ in range(3)) for _ in range(300)]
    rows = [(i, sentence(rng, 30, clean) + (" blockhead " if i % 4 == 0 else " ") + sentence(rng, 5, clean), int(i % 4 == 0)) for i in range(400)]
    model = toxicity.learn(spark.createDataFrame(rows, "doc_id bigint, text string, toxic int"))
    said = ["you blockhead", "b.l.o.c.k.h.e.a.d", "b l o c k h e a d", "blockxhead", sentence(rng, 50, clean), "", None]
    found = by_key(toxicity.score(spark.createDataFrame(list(enumerate(said)), "doc_id bigint, text string"), model), "doc_id")
    assert [found[i].predicted for i in range(7)] == [1, 1, 1, 1, 0, 0, 0]
    assert all(0 <= r.score <= 1 for r in found.values())
    flat = toxicity.learn(empty.select("doc_id", "text", F.lit(0).alias("toxic")))
    assert toxicity.score(empty.select("doc_id", "text"), flat).count() == 0


def test_pipeline_stages_keep_columns(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("row", F.lit(1)).withColumn("score", F.lit(2.0))
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near_dedup", "decontaminate", "mix", "tokenise"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf_dir).columns == docs.columns
