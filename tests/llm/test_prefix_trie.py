"""The prefix trie against brute force over rebuilt texts."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from transferlens.llm import prefix_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth string, rep int"


def brute_force(rows, base=lambda c: c - c % 20, head=lambda c: zlib.crc32(str(c).encode()) % 4):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [turn[2:] for turn in sorted(turns)] for c, turns in own.items()}
    whole = {c: own.get(base(c), [])[: head(c)] + turns[head(c) :] for c, turns in own.items()}
    members, children = defaultdict(list), defaultdict(int)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    for path in members:
        if path:
            children[path[:-1]] += 1
    saved, leaves = defaultdict(int), defaultdict(int)
    for path, found in members.items():
        cost = (len(found) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        for d in range(len(path) + 1):
            saved[path[:d]] += cost
            leaves[path[:d]] += not children[path] if path in children else 1
    out = set()
    for path, found in members.items():
        ends = ",".join(str(c) for c in sorted(found) if len(whole[c]) == len(path))
        parent = min(members[path[:-1]]) if path else None
        out.add((min(found), len(path), parent, len(found), children.get(path, 0), leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def found(spark, rows, **how):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)
    out = [tuple(r) for r in prefix_trie.trie(df, **how).drop("turn_conv", "turn_pos").collect()]
    assert len(out) == len(set(out))
    return set(out)


def conversations(rng, ids, words):
    rows = []
    for c in ids:
        for turn in range(rng.randint(1, 6)):
            rows.append((c, turn, rng.choice(["user", "assistant"]), " ".join(rng.choice(words) for _ in range(rng.randint(0, 2)))))
    return rows


def test_random_conversations_share_prefixes(spark):
    rng = random.Random(3)
    # Missing bases, many copies, texts and roles that only together differ.
    rows = conversations(rng, [c for c in range(200) if c % 20 or c % 40], ["a", "b", "user"])
    rows += [(1000 + c, t, "user", f"same {t}") for c in range(60) for t in range(4)]
    assert found(spark, rows) == brute_force(rows)


def test_edge_cases(spark):
    rows = [
        (20, None, None, None), (20, 0, "user", "hi there"), (20, 0, "user", "hi there"), (21, 0, "user", ""), (21, 1, "", "user"), (22, 5, "user", None),
        (None, 0, "user", "lost"), (45, 0, "u", "only one"), (-3, 0, "user", "x  y\tz"), (9_000_000_000_000_000_000, 1, "user", "x " * 5000), (23, 0, "ab", "c"), (24, 0, "a", "bc")]
    rows += [(c, t, "user", f"turn {t}") for c in (46, 47, 48, 49) for t in range(2)]
    assert {c for c in (45, 46, 47, 48, 49) if zlib.crc32(str(c).encode()) % 4 >= 2}  # some end at the root, without a turn

    def base(c):
        return c - (abs(c) % 20 if c >= 0 else -(abs(c) % 20))

    assert found(spark, rows) == brute_force(rows, base)
    assert prefix_trie.trie(spark.createDataFrame([], SCHEMA)).count() == 0
    assert prefix_trie.trie(spark.createDataFrame([(None, 1, "a", "b", "c", 1)], SCHEMA)).count() == 0


@pytest.mark.parametrize("piece", [prefix_trie.PIECE, 100])
def test_one_conversation_with_most_turns_is_split(spark, monkeypatch, piece):
    monkeypatch.setattr(prefix_trie, "PIECE", piece)
    rng = random.Random(4)
    rows = [(41, t if t % 7 else None, "user", f"{rng.randint(0, 50)}") for t in range(1200)]
    rows += [(c, t, "user", text) for c in (42, 61, 62) for t, (_, _, _, text) in enumerate(sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[3]))[: 30 * (c - 40)])]
    rows += conversations(rng, range(40, 70, 9), ["1", "2"])
    turns = prefix_trie.turns_of(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA), 0, "conv_id", "turn", "role", "text")
    placed = prefix_trie.placed_turns(turns.repartition(8), 0)
    assert sorted(r.pos for r in placed.filter("conv = 41").collect()) == list(range(1, 1201))
    # Among turns of one number the order is that of their fingerprints, so they are numbered here by it.
    order = {(r.conv, r.a, r.b): r.text for r in turns.select("conv", "a", "b", "text").collect()}
    rows = [(r.conv, r.pos, "user" if r.conv in (41, 42, 61, 62) else None, order[r.conv, r.a, r.b]) for r in placed.collect()]
    assert found(spark, rows) == brute_force(rows)


def test_own_base_and_head(spark):
    rows = conversations(random.Random(6), range(40), ["a", "b"])
    how = {"base": lambda c: F.lit(0).cast("long"), "head": lambda c: F.lit(2), "most": 2}
    assert found(spark, rows, **how) == brute_force(rows, lambda c: 0, lambda c: 2)
    plain = {"base": lambda c: c, "head": lambda c: F.lit(0), "most": 0}
    assert found(spark, rows, **plain) == brute_force(rows, lambda c: c, lambda c: 0)


def test_turn_references_lead_to_the_last_turn(spark):
    rows = [(c, t, "user", f"{c % 3} {t}") for c in range(40) for t in range(5)]
    nodes = prefix_trie.trie(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)).filter("depth > 0").collect()
    texts = {(c, t + 1): text for c, t, _, text in rows}
    for node in nodes:
        head = zlib.crc32(str(node.conv_id).encode()) % 4
        source = node.conv_id - node.conv_id % 20 if node.depth <= head else node.conv_id
        assert texts[node.turn_conv, node.turn_pos] == texts[source, node.depth]


def test_meeting_fingerprints_take_another_salt(spark, monkeypatch):
    rows = conversations(random.Random(8), range(60), ["a", "b", "c"])
    real = prefix_trie.turns_of

    def weak(conversations, salt, *names):
        turns = real(conversations, salt, *names)
        return turns.withColumns({"a": F.col("a") % 2, "b": F.lit(0).cast("long")}) if salt == 0 else turns

    monkeypatch.setattr(prefix_trie, "turns_of", weak)
    assert found(spark, rows) == brute_force(rows)
    monkeypatch.setattr(prefix_trie, "SALTS", 1)
    with pytest.raises(ValueError, match="salts"):
        found(spark, rows)


def test_meeting_prefixes_are_seen(spark):
    rows = "depth long, f1 long, f2 long, conv long, len long, words long, a long, b long, p1 long, p2 long, turn_conv long, turn_pos long"
    same, other = (1, 7, 8, 1, 1, 3, 5, 6, 0, 0, 1, 1), (1, 7, 8, 2, 1, 3, 5, 6, 0, 1, 2, 1)
    assert [r.same for r in prefix_trie.nodes_of(spark.createDataFrame([same, same], rows)).collect()] == [True]
    assert [r.same for r in prefix_trie.nodes_of(spark.createDataFrame([same, other], rows)).collect()] == [False]
