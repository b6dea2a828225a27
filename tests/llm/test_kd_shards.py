"""The k-d tree against one that is built in memory, and what holds for every result."""

import random
import zlib
from collections import defaultdict

import pytest
import xxhash

from skylens.llm.kd_shards import kd_shards
from skylens.llm.queries import op13_kd_shards

SCHEMA = "doc_id long, text string, n_chars long, lang string, shard string"


def _number(value):
    if value is None:
        return None
    if isinstance(value, str):
        return float(int.from_bytes(value.encode()[:6].ljust(6, b"\0"), "big"))
    return float(value)


def brute(rows, dims, shards, slack=0.01):
    """{place in rows: (shard, slot)}."""
    points = []
    for place, (doc_id, text, *meta) in enumerate(rows):
        data = (text or "").encode()
        copy = xxhash.xxh64(data, seed=42).intdigest()
        points.append((place, doc_id, len(data) + 1, copy - (1 << 64 if copy >> 63 else 0), [_number(meta[d]) for d in dims]))
    extent = lambda ps, i: max(v) - min(v) if (v := [p[4][i] for p in ps if p[4][i] is not None]) else 0
    widths = [extent(points, i) for i in range(len(dims))]
    limit, out = int(slack * sum(p[2] for p in points) / shards), {}
    low = lambda x: (x is not None, x if x is not None else 0)

    rounds = (shards - 1).bit_length()

    def split(ps, first, leaves, slots, depth=0):
        if leaves == 1:
            if depth < max(1, rounds):  # sorted once more with the nodes still to be cut, by text and id alone
                slots = sorted(slots, key=lambda p: (p[3], low(p[1]), p[0]))
            out.update({p[0]: (first, i) for i, p in enumerate(slots)})
            return
        shares = [extent(ps, i) / w if w else 0 for i, w in enumerate(widths)]
        at = shares.index(max(shares)) if any(shares) else None
        value = lambda p: low(p[4][at] if at is not None else None)
        ps = sorted(ps, key=lambda p: (value(p), p[3], low(p[1]), p[0]))
        ideal, left, spans = sum(p[2] for p in ps) * (leaves // 2) // leaves, 0, []
        for p in ps:
            spans.append((left, left + p[2], value(p), p[3]))
            left += p[2]
        cut = 0
        for a, b, v, c in spans:
            if a <= ideal < b:
                group = [s for s in spans if s[2:] == (v, c)]
                lo, hi = group[0][0], group[-1][1]
                edge = lo if ideal - lo <= hi - ideal else hi
                cut = edge if abs(edge - ideal) <= limit else (a if ideal - a <= b - ideal else b)
        one = [p for p, s in zip(ps, spans) if s[0] < cut]
        two = ps[len(one):]
        split(one, first, leaves // 2, one, depth + 1)
        split(two, first + leaves // 2, leaves - leaves // 2, two, depth + 1)

    split(points, 0, shards, points)
    return out


def documents(seed, n):
    rng = random.Random(seed)
    shared = ["copy " * 20, "", None]
    rows = []
    for i in range(n):
        text = rng.choice(shared) if rng.random() < 0.4 else "ü" * rng.randrange(400)
        same = random.Random(str(text))
        rows.append((i if rng.random() > 0.05 else None, text, same.choice([None, len(text or "")]), same.choice(["de", "en", None]), same.choice(["src1", "src2", "sss"])))
    return rows


@pytest.mark.parametrize("seed,n,shards", [(1, 300, 16), (2, 200, 5), (3, 7, 16), (4, 40, 1), (5, 120, 3)])
def test_same_tree_as_in_memory(spark, seed, n, shards):
    rows = [(i, *r[1:]) for i, r in enumerate(documents(seed, n))]
    got = kd_shards(spark.createDataFrame(rows, SCHEMA).coalesce(1), ["n_chars", "lang"], shards=shards)
    assert got.columns == ["doc_id", "size", "text_crc32", "shard", "slot"]
    assert {r.doc_id: (r.shard, r.slot) for r in got.collect()} == brute(rows, [0, 1], shards)


def test_results_hold_together(spark, tmp_path):
    rows = documents(8, 900) + [(5, "twice", 5, "en", "s")] * 2
    spark.createDataFrame(rows, "doc_id long, text string, n_chars long, lang string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    got = op13_kd_shards(spark, str(tmp_path)).collect()
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == sorted((str(i), len(d) + 1, zlib.crc32(d)) for i, t, *_ in rows for d in [(t or "").encode()])
    assert {(r.law, r.grown_shard) for r in got} == {("bytes", None)}
    held, slots = defaultdict(int), defaultdict(list)
    for r in got:
        held[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert sorted(held) == list(range(16)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    mean = sum(held.values()) / 16
    assert all(abs(h - mean) < 0.1 * mean for h in held.values())


def test_equal_texts_stay_together_where_they_fit(spark):
    rows = [(i, f"{i // 3:04d}" * 25, 1, "a") for i in range(3000)]
    got = kd_shards(spark.createDataFrame(rows, "doc_id long, text string, n_chars long, lang string"), ["n_chars", "lang"], shards=8, slack=0.02).collect()
    homes = defaultdict(set)
    for r in got:
        homes[r.doc_id // 3].add(r.shard)
    assert all(len(h) == 1 for h in homes.values())


def test_one_text_in_all_rows_is_still_split(spark):
    got = kd_shards(spark.range(1600).selectExpr("id AS doc_id", "'same' AS text", "4 AS n_chars"), ["n_chars"], shards=16).groupBy("shard").count().collect()
    assert {r["count"] for r in got} == {100}


def test_target_bytes_and_empty_tables(spark):
    docs = spark.range(100).selectExpr("id AS doc_id", "repeat('x', 9) AS text", "id AS n_chars", "1 AS node", "2 AS size")
    assert kd_shards(docs, ["n_chars"], target_bytes=100).select("shard").distinct().count() == 10
    assert kd_shards(docs.where("false"), ["n_chars"], shards=16).count() == 0
    assert kd_shards(docs.where("false"), ["n_chars"], target_bytes=16).count() == 0
    with pytest.raises(ValueError):
        kd_shards(docs, ["n_chars"])
