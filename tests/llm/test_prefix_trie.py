"""The prefix trie against a dictionary of prefixes."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import Row

from skylens.llm.prefix_trie import ordered_turns, prefix_trie
from skylens.llm.queries import op12_prefix_trie

TURNS = "conv_id long, pos long, role string, text string"


def brute(convs):
    """Rows of the trie of {conv_id: [(role, text), ...]}, sorted."""
    members = defaultdict(list)
    for c, turns in sorted(convs.items()):
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(int)
    for prefix in members:
        if prefix:
            children[prefix[:-1]] += 1
    out = []
    for prefix, held in members.items():
        below = [p for p in members if p[:len(prefix)] == prefix]
        ends = ",".join(str(c) for c in held if len(convs[c]) == len(prefix))
        out.append((held[0], len(prefix), members[prefix[:-1]][0] if prefix else None, len(held), children[prefix],
                    sum(children[p] == 0 for p in below), sum((len(members[p]) - 1) * len(p[-1][1]) for p in below if p),
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def trie(spark, convs, **options):
    heads = spark.createDataFrame([(c,) for c in convs], "conv_id long")
    turns = spark.createDataFrame([(c, i, *t) for c, x in convs.items() for i, t in enumerate(x)], TURNS)
    return sorted(map(tuple, prefix_trie(heads, turns, **options).collect()), key=str)


@pytest.mark.parametrize("seed", range(4))
def test_any_conversations(spark, seed):
    rng = random.Random(seed)
    words = ["", "a", "éé", "long text"][:2 + seed]
    stems = [[("user", rng.choice(words)) for _ in range(rng.randrange(0, 12))] for _ in range(3)]
    convs = {rng.randrange(-50, 10 ** 6): [*rng.choice(stems)[:rng.randrange(0, 13)], *[(rng.choice(["user", "system"]), rng.choice(words)) for _ in range(rng.choice([0, 1, 3]))]]
             for _ in range(60)}
    assert trie(spark, convs, id_bucket=rng.choice([7, 1 << 16])) == brute(convs)


def test_depths_about_powers_of_two(spark):
    same = [("u", "x")] * 17
    convs = {i: same[:n] for i, n in enumerate([0, 1, 2, 3, 4, 5, 7, 8, 9, 15, 16, 17])}
    assert trie(spark, convs) == brute(convs)


@pytest.mark.parametrize("convs", [{}, {5: []}, {5: [], 6: []}, {5: [("a", "b")]}])
def test_small_tries(spark, convs):
    assert trie(spark, convs) == brute(convs)


def test_many_ends_are_digested_as_one_stream(spark):
    convs = {i * 3: [("u", "x")] for i in range(400)} | {7: [("u", "y")]}
    assert trie(spark, convs, id_bucket=10) == brute(convs)


def test_order_of_turns(spark):
    rows = [(1, 2, "b", "c"), (1, None, "z", "z"), (1, 2, "b", "c"), (1, 2, None, "c"), (1, 2, "b", None), (1, -5, "a", "a"), (None, 1, "no", "id"), (2, None, None, None)]
    df = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id long, turn long, role string, text string, pos string")
    for n in (1, 4):
        got = sorted(map(tuple, ordered_turns(df.repartition(n)).collect()))
        assert got == [(1, 0, "z", "z"), (1, 1, "a", "a"), (1, 2, "", "c"), (1, 3, "b", ""), (1, 4, "b", "c"), (1, 5, "b", "c"), (2, 0, "", "")]


def test_one_long_conversation_is_numbered_in_many_tasks(spark):
    df = spark.range(5000).selectExpr("if(id % 5 = 0, id, 3) AS conv_id", "id AS turn", "'u' AS role", "repeat('x', 50) AS text").repartition(8)
    got = {(r.conv_id, r.pos) for r in ordered_turns(df).select("conv_id", "pos").collect()}
    assert got == {(3, i) for i in range(4000)} | {(i, 0) for i in range(0, 5000, 5)}


def rebuilt(conversations):
    own = defaultdict(list)
    for c, turn, role, text in sorted(conversations, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        if c is not None:
            own[c].append((role or "", text or ""))
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    return out


def test_query(spark, tmp_path):
    rng = random.Random(9)
    rows = [(c, t, rng.choice(["user", "assistant", None]), rng.choice(["hi", "ho", None, ""])) for c in rng.sample(range(0, 420), 150) for t in range(rng.randrange(1, 9))]
    rows += [(100, t, "user", "hi") for t in range(40)] + [(None, 1, "user", "no id"), (405, None, "user", "first"), (405, 1, "user", "twice"), (405, 1, "user", "twice")]
    spark.createDataFrame([Row(conv_id=a, turn=b, role=c, text=d, n_convs=1) for a, b, c, d in rows],
                          "conv_id long, turn long, role string, text string, n_convs int").write.parquet(str(tmp_path / "conversations.parquet"))
    got = op12_prefix_trie(spark, str(tmp_path))
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rebuilt(rows))
