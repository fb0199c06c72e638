"""The prefix trie of conversations that are rebuilt from another one's first turns and their own rest.

Fingerprints are a monoid. A turn is four numbers modulo a prime (from two 64-bit hashes of role and text), and a sequence of turns is
the pair of its length n and the sums S of turn j times B^j, for four bases B; joining two sequences gives
(n1 + n2, S1 + B^n1 S2). So the fingerprints of all prefixes of a conversation are running sums, and that of a rebuilt prefix
is put together without rebuilding any text: the own prefix of length k, less the own first h turns, moved by the m turns that the
base gives, is ``S_base(m) + B^(m-h) (S_own(k) - S_own(h))``, one multiplication and one addition per conversation and turn. Rows hold
fingerprints, word counts and turn references; no text is shuffled but that of turns whose fingerprint occurs more than once.

Equality is verified. Rebuilt prefixes with one fingerprint and depth are a node if they also share the fingerprints of their last turn and of
the prefix before it; by induction they are then equal, provided that equal turn fingerprints mean equal turns.
For that, each fingerprint of a turn refers to the first turn that has it, and the texts of all turns that share one are held against each other.
On any difference all is done again with another salt.

Subtrees need no rounds. The smallest member of a node is the smallest member of one of its children or ends there, so nodes fall into chains, one
for each conversation that is the smallest member of any, running from a top down to the end of that conversation.
What a chain adds to the nodes above its top is one number per conversation, and their sum over the members of a node is an aggregate.

Long conversations. Turns are dealt out by range of conversation and turn, so a conversation of any length is spread over
tasks; running sums are taken within a task's share and moved by the shares before it, of which there are no more than tasks.
A chain is summed up in pieces of ``PIECE`` nodes. The digest of the members that end at a node is a SHA-256, which has no other order than its
own: their ids are sorted and joined 4,096 at a time in parallel, and one task streams those strings of a node in constant memory.

Defined cases: rows without a conversation id are left out; a null turn comes first, a null role or text is empty; turns with
one number stand in the order of their fingerprints, so rows in any order, repeated ones too, give one result; a base that is absent gives no
turns; a conversation without turns ends at the root; an empty table gives an empty result; other columns are not read. Conversations are
shorter than 2^32 turns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from transferlens.llm.common import WORDS, ship, staged

PRIME = (1 << 31) - 1
LANES = range(4)
PIECE = 1 << 16
IDS = 12
BROADCAST = 100_000
SALTS = 5
BLOCK, HEADS = 20, 3
NODE = ["depth", "f1", "f2"]
EMPTY = hashlib.sha256(b"").hexdigest()


def block_start(conv: Column) -> Column:
    return conv - conv % BLOCK


def head_length(conv: Column) -> Column:
    return F.crc32(conv.cast("string").cast("binary")) % (HEADS + 1)


def bases(salt: int) -> list[int]:
    return [int.from_bytes(hashlib.sha256(f"{salt}:{lane}".encode()).digest()[:8]) % (PRIME - 2) + 2 for lane in LANES]


def big(n: int) -> Column:
    return F.lit(n).cast("bigint")


def mul(a: Column, b: Column) -> Column:
    return a * b % big(PRIME)


def power(base: int, n: Column) -> Column:
    """``base`` to the power of n, for n below 2^32: the product of one entry of a table for each byte of n."""
    found = []
    for byte in range(4):
        table = [pow(base, k << 8 * byte, PRIME) for k in range(256)]
        entry = F.expr(f"array({', '.join(f'{x}L' for x in table)})")
        found.append(F.get(entry, F.shiftright(n, 8 * byte).bitwiseAND(F.lit(255)).cast("int")))
    return mul(mul(found[0], found[1]), mul(found[2], found[3]))


def numbers(a: Column, b: Column) -> list[Column]:
    """The four numbers of a turn."""
    return [part.bitwiseAND(big(PRIME)) for whole in (a, b) for part in (whole, F.shiftrightunsigned(whole, 31))]


def packed(high: Column, low: Column) -> Column:
    return F.shiftleft(high, 31).bitwiseOR(low)


def turns_of(conversations: DataFrame, salt: int, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """conv, turn, a and b (the fingerprint of the turn), words, role, text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    rows = conversations.filter(F.col(conv).isNotNull())
    rows = rows.select(F.col(conv).cast("long").alias("conv"), F.col(turn).alias("turn"), role.alias("role"), text.alias("text"))
    return rows.withColumns({"a": F.xxhash64(F.lit(2 * salt), "role", "text"), "b": F.xxhash64(F.lit(2 * salt + 1), "role", "text"),
                             "words": F.regexp_count("text", F.lit(WORDS)).cast("long")})


def same_turns(turns: DataFrame) -> bool:
    """Whether all turns with one fingerprint have the same role and text."""
    shared = staged(turns.groupBy("a", "b").agg(F.count("*").alias("n")).filter("n > 1").select("a", "b"), "shared_turns")
    few = F.broadcast(shared) if shared.count() <= BROADCAST else shared
    whole = F.struct("role", "text")
    both = turns.join(few, ["a", "b"], "left_semi").groupBy("a", "b").agg(F.min(whole).alias("first"), F.max(whole).alias("last"))
    return both.filter("first <> last").isEmpty()


def placed_turns(turns: DataFrame, salt: int) -> DataFrame:
    """conv, pos (from 1), a, b, words and s0 to s3, the sums of the conversation up to this turn."""
    by = ["conv", F.col("turn").asc_nulls_first(), "a", "b"]
    dealt = turns.select("conv", "turn", "a", "b", "words").repartitionByRange(*by).withColumn("part", F.spark_partition_id())
    within = Window.partitionBy("conv", "part").orderBy(*by[1:])
    up_to = within.rowsBetween(Window.unboundedPreceding, 0)
    ranked = dealt.withColumn("nth", F.row_number().over(within).cast("long"))
    terms = {f"t{i}": mul(t, power(base, F.col("nth"))) for i, t, base in zip(LANES, numbers(F.col("a"), F.col("b")), bases(salt), strict=True)}
    sums = {f"s{i}": F.sum(f"t{i}").over(up_to) % big(PRIME) for i in LANES}
    # The shares are written out: they are read twice and must be the same both times.
    ranked = staged(ranked.withColumns(terms).withColumns(sums).select("conv", "part", "nth", "a", "b", "words", *sums), "ranked_turns")
    shares = ranked.groupBy("conv", "part").agg(F.max("nth").alias("n"), *(F.max_by(f"s{i}", "nth").alias(f"own{i}") for i in LANES))
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shares = shares.withColumn("before", F.sum("n").over(earlier)).withColumns({f"power{i}": power(base, F.coalesce("before", big(0))) for i, base in zip(LANES, bases(salt), strict=True)})
    shares = shares.withColumns({f"moved{i}": mul(F.col(f"own{i}"), F.col(f"power{i}")) for i in LANES})
    shares = shares.withColumns({f"sum{i}": F.sum(f"moved{i}").over(earlier) % big(PRIME) for i in LANES}).filter("before > 0")
    # A task's share continues at most one conversation, so this is no more than one row per task.
    shares = staged(shares.select("conv", "part", "before", *(f"{x}{i}" for x in ("power", "sum") for i in LANES)), "continued_turns")
    rows = ranked.join(F.broadcast(shares), ["conv", "part"], "left")
    whole = {f"s{i}": (F.coalesce(f"sum{i}", big(0)) + F.coalesce(mul(F.col(f"s{i}"), F.col(f"power{i}")), F.col(f"s{i}"))) % big(PRIME) for i in LANES}
    return rows.select("conv", (F.col("nth") + F.coalesce("before", big(0))).alias("pos"), "a", "b", "words", *(c.alias(n) for n, c in whole.items()))


def conversations_of(placed: DataFrame, salt: int, base: Callable[[Column], Column], head: Callable[[Column], Column], most: int) -> DataFrame:
    """conv, h, m (turns that the base gives), len, heads (the base's first turns) and the affine map (add, times) from own to rebuilt sums."""
    first = F.struct("pos", "a", "b", "words", *(f"s{i}" for i in LANES))
    own = placed.groupBy("conv").agg(F.max("pos").alias("n"), F.sort_array(F.collect_list(F.when(F.col("pos") <= most, first))).alias("own"))
    own = staged(own, "conversation_heads")
    given = own.select(F.col("conv").alias("base"), F.col("n").alias("base_n"), F.col("own").alias("heads"))
    rows = own.withColumns({"base": base(F.col("conv")), "h": F.coalesce(head(F.col("conv")), F.lit(0)).cast("long")}).join(given, "base", "left")
    rows = rows.withColumn("m", F.least("h", F.coalesce("base_n", big(0))))
    rows = rows.withColumn("len", F.col("m") + F.greatest(F.col("n") - F.col("h"), big(0)))
    at = lambda heads, k, i: F.coalesce(F.get(heads, (F.col(k) - 1).cast("int"))[f"s{i}"], big(0))
    for i, b in zip(LANES, bases(salt), strict=True):
        inverse = pow(b, -1, PRIME)
        times = F.get(F.array(*(big(pow(inverse, k, PRIME)) for k in range(most + 1))), (F.col("h") - F.col("m")).cast("int"))
        rows = rows.withColumn(f"times{i}", times)
        rows = rows.withColumn(f"add{i}", F.pmod(at("heads", "m", i) - mul(F.col(f"times{i}"), at("own", "h", i)), big(PRIME)))
    return staged(rows.select("conv", "base", "h", "m", "len", "heads", *(f"{x}{i}" for x in ("add", "times") for i in LANES)), "conversations")


def rebuilt_prefixes(placed: DataFrame, convs: DataFrame, salt: int) -> DataFrame:
    """One row per rebuilt conversation and depth: conv, depth, len, f1 and f2, p1 and p2 (of the prefix before), a, b, words, turn_conv, turn_pos."""
    def row(sums: list[Column], before: list[Column], *others: Column) -> list[Column]:
        return [*others, *(packed(x[j], x[j + 1]).alias(n) for x, n, j in ((sums, "f1", 0), (sums, "f2", 2), (before, "p1", 0), (before, "p2", 2)))]

    zero = big(0)
    heads = convs.select("conv", "base", "len", "heads", F.explode(F.sequence(zero, F.col("m"))).alias("depth"))
    heads = heads.withColumns({"turn": F.get("heads", (F.col("depth") - 1).cast("int")), "above": F.get("heads", (F.col("depth") - 2).cast("int"))})
    given = heads.select(*row([F.coalesce(F.col("turn")[f"s{i}"], zero) for i in LANES], [F.coalesce(F.col("above")[f"s{i}"], zero) for i in LANES],
                              F.col("conv"), F.col("depth"), F.col("len"), *(F.coalesce(F.col("turn")[c], zero).alias(c) for c in ("a", "b", "words")),
                              F.when(F.col("depth") > 0, F.col("base")).alias("turn_conv"), F.col("turn")["pos"].alias("turn_pos")))
    rest = placed.join(convs.drop("base", "heads"), "conv").filter("pos > h")
    terms = [mul(t, power(b, F.col("pos"))) for t, b in zip(numbers(F.col("a"), F.col("b")), bases(salt), strict=True)]
    rest = rest.withColumns({f"t{i}": F.pmod(F.col(f"s{i}") - terms[i], big(PRIME)) for i in LANES})
    there = lambda c, i: (F.col(f"add{i}") + mul(F.col(f"times{i}"), F.col(f"{c}{i}"))) % big(PRIME)
    own = rest.select(*row([there("s", i) for i in LANES], [there("t", i) for i in LANES], F.col("conv"), (F.col("pos") - F.col("h") + F.col("m")).alias("depth"),
                           F.col("len"), F.col("a"), F.col("b"), F.col("words"), F.col("conv").alias("turn_conv"), F.col("pos").alias("turn_pos")))
    return staged(given.unionByName(own), "prefixes")


def nodes_of(prefixes: DataFrame) -> DataFrame:
    """depth, f1, f2, p1, p2, rep (the smallest member), n, ends, cost ((n - 1) times the words of the last turn), turn reference, same."""
    same = [F.min(c) == F.max(c) for c in ("a", "b", "p1", "p2")]
    found = prefixes.groupBy(*NODE).agg(
        F.min("conv").alias("rep"), F.count("*").alias("n"), F.sum((F.col("depth") == F.col("len")).cast("long")).alias("ends"), F.max("words").alias("words"),
        F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.min(F.struct("conv", "turn_conv", "turn_pos")).alias("turn"), (same[0] & same[1] & same[2] & same[3]).alias("same"))
    cost = (F.col("n") - 1) * F.col("words")
    return staged(found.select(*NODE, "p1", "p2", "rep", "n", "ends", cost.alias("cost"), "turn.turn_conv", "turn.turn_pos", "same"), "nodes")


def below_in_chain(nodes: DataFrame) -> DataFrame:
    """``nodes`` with below: their cost and that of the nodes under them in their chain."""
    rows = nodes.withColumn("piece", F.floor(F.col("depth") / PIECE))
    pieces = rows.groupBy("rep", "piece").agg(F.sum("cost").alias("whole"))
    deeper = Window.partitionBy("rep").orderBy(F.desc("piece")).rowsBetween(Window.unboundedPreceding, -1)
    pieces = staged(pieces.withColumn("deeper", F.sum("whole").over(deeper)).filter("deeper > 0").select("rep", "piece", "deeper"), "pieces")
    inside = Window.partitionBy("rep", "piece").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("within", F.sum("cost").over(inside)).join(pieces, ["rep", "piece"], "left")
    return rows.withColumn("below", F.col("within") + F.coalesce("deeper", big(0))).drop("piece", "within", "deeper")


def digests(prefixes: DataFrame) -> DataFrame:
    """The SHA-256 of the sorted ids of the conversations that end at a node, joined by commas."""
    ids = prefixes.filter("depth = len").withColumn("part", F.shiftright("conv", IDS)).groupBy(*NODE, "part").agg(F.array_sort(F.collect_list("conv")).alias("ids"))
    lists = ids.select(*NODE, "part", F.array_join(F.transform("ids", lambda c: c.cast("string")), ",").alias("ids"))
    return lists.repartition(*NODE).sortWithinPartitions(*NODE, "part").mapInArrow(stream_digests, "depth bigint, f1 bigint, f2 bigint, ends_sha256 string")


def stream_digests(batches):
    held, state = None, None
    for batch in batches:
        done = []
        for *node, ids in zip(*(batch.column(c).to_pylist() for c in (*NODE, "ids")), strict=True):
            if node == held:
                state.update(b"," + ids.encode())
                continue
            if held:
                done.append((*held, state.hexdigest()))
            held, state = node, hashlib.sha256(ids.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*done, strict=True)], [*NODE, "ends_sha256"])
    if held:
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*held, state.hexdigest())], [*NODE, "ends_sha256"])


def trie(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
         base: Callable[[Column], Column] = block_start, head: Callable[[Column], Column] = head_length, most: int = HEADS) -> DataFrame:
    """One row per node: conv_id (the smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, and
    turn_conv, turn_pos: where the node's last turn stands among the original turns.

    ``base`` and ``head`` give the conversation that a conversation starts with and how many of its turns, ``most`` at most.
    """
    ship(conversations.sparkSession)
    for salt in range(SALTS):
        turns = turns_of(conversations, salt, conv, turn, role, text)
        if not same_turns(turns):
            continue
        placed = placed_turns(turns, salt)
        prefixes = rebuilt_prefixes(placed, conversations_of(placed, salt, base, head, most), salt)
        nodes = nodes_of(prefixes)
        if nodes.filter("NOT same").isEmpty():
            return tree_of(prefixes, nodes)
    raise ValueError(f"fingerprints of different turns or prefixes met under each of {SALTS} salts")


def tree_of(prefixes: DataFrame, nodes: DataFrame) -> DataFrame:
    leaf = F.max(F.struct("depth", (F.col("n") == F.col("ends")).cast("long").alias("leaf")))["leaf"]
    chains = staged(nodes.groupBy("rep").agg(F.min("depth").alias("top"), F.sum("cost").alias("total"), leaf.alias("leaf")), "chains")
    # What chains add above their tops, the number of children and the digest of ends, in one row per node.
    up = prefixes.select(*NODE, F.col("conv").alias("rep")).join(chains, "rep").filter("depth < top")
    up = up.groupBy(*NODE).agg(F.sum("total").alias("total"), F.sum("leaf").alias("leaves"))
    children = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("f1"), F.col("p2").alias("f2")).agg(F.count("*").alias("children"))
    more = up.unionByName(children, allowMissingColumns=True).unionByName(digests(prefixes), allowMissingColumns=True)
    more = staged(more.groupBy(*NODE).agg(*(F.max(c).alias(f"up_{c}") for c in ("total", "leaves", "children", "ends_sha256"))), "above")
    found = staged(below_in_chain(nodes).join(chains, "rep").join(more, NODE, "left"), "nodes_below")
    root = nodes.filter("depth = 0").select("rep").first()
    # The parent of a chain's top belongs to another chain; that of a top under the root is known.
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("f1").alias("p1"), F.col("f2").alias("p2"), F.col("rep").alias("parent"))
    asked = (F.col("depth") == F.col("top")) & (F.col("depth") > 1)
    known = F.when(F.col("depth") == 0, F.lit(None)).when(F.col("depth") > F.col("top"), F.col("rep")).otherwise(F.lit(root and root["rep"]))
    both = found.filter(asked).join(parents, ["depth", "p1", "p2"]).unionByName(found.filter(~asked).withColumn("parent", known.cast("long")))
    zero = big(0)
    return both.select(
        F.col("rep").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"), F.coalesce("up_children", zero).alias("n_children"),
        (F.col("leaf") + F.coalesce("up_leaves", zero)).alias("n_leaves"), (F.col("below") + F.coalesce("up_total", zero)).alias("saved_tokens"),
        F.coalesce("up_ends_sha256", F.lit(EMPTY)).alias("ends_sha256"), "turn_conv", "turn_pos")
