"""Exact and near dedup against brute force, on nulls, empty and long texts, ties, repeats and clashing columns."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from skylens.llm.common import connected_components
from skylens.llm.exact_dedup import exact_dedup
from skylens.llm import minhash
from skylens.llm.minhash import Signer, near_dedup, shingle_sets

SCHEMA = "doc_id long, text string, kept boolean, component_id string, name int, _row string"


def frame(spark, rows):
    """Extra columns have the names that the operators use themselves."""
    return spark.createDataFrame([(i, t, None, "x", 1, "y") for i, t in rows], SCHEMA)


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def test_exact_dedup_matches_brute_force(spark):
    long = "lorem ipsum " * 40
    rows = [(1, "a  b"), (2, "a\tb"), (3, " a b"), (4, None), (5, ""), (6, long), (7, long + "x"), (8, long.replace(" ", "\n")), (9, "a b"),
            (None, "a b"), (None, "only"), (3, "a b"), (3, "a b"), (10, "é" * 300), (11, "é" * 300), (12, "é" * 299 + "e"), (13, "  "), (14, " ")]
    got = exact_dedup(frame(spark, rows), block_bytes=16).collect()
    assert len(got) == len(rows)
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append(i)
    by_hash = {hashlib.sha256(k.encode()).hexdigest(): v for k, v in groups.items()}
    assert sorted(by_hash) == sorted({r.text_sha256 for r in got})
    for h, ids in by_hash.items():
        own = [r for r in got if r.text_sha256 == h]
        known = [i for i in ids if i is not None]
        assert {r.group_size for r in own} == {len(ids)} and {r.keep_id for r in own} == {min(known) if known else None}
        assert sum(r.kept for r in own) == 1 and next(r for r in own if r.kept).doc_id == (min(known) if known else None)


def test_exact_dedup_names_many_copies_over_many_tasks(spark):
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("copy " * 30)).otherwise(F.concat(F.lit("copy " * 30), F.col("id").cast("string"))).alias("text"))
    got = exact_dedup(rows.repartition(7), block_bytes=64)
    assert got.count() == 3000 and got.where("kept").count() == 2001 and got.agg(F.max("group_size")).first()[0] == 1000


@pytest.mark.parametrize("operator", [exact_dedup, near_dedup])
def test_empty_table(spark, operator):
    assert operator(frame(spark, [])).count() == 0


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group(0).lower(), text or ""))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def components(rows, k, percent):
    sets = [shingles(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(root(i), []).append(i)
    least = {}
    for members in groups.values():
        ids = [rows[i][0] for i in members if rows[i][0] is not None]
        for i in members:
            least[i] = min(ids) if ids else None
    return sets, least, len(groups)


def variants(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(12):
        base = rng.choices(words, k=rng.randint(5, 150))
        rows.append(" ".join(base))
        for _ in range(rng.randint(0, 8)):  # chains of edits, about the similarity asked for
            at = rng.randrange(len(base))
            base = base[:at] + rng.choices(words, k=rng.randint(0, 3)) + base[at + rng.randint(0, 3):]
            rows.append("  ".join(base).upper() if rng.random() < 0.3 else " ".join(base))
    rows += [rows[0]] * 5 + ["", None, " \n", "one", "One", "one two", rows[3].replace(" ", "\n")]
    ids = rng.sample(range(1000), len(rows))
    return list(zip(ids, rows))


@pytest.mark.parametrize("seed,k", [(1, 4), (2, 5), (3, 2)])
def test_near_dedup_matches_brute_force(spark, seed, k):
    rows = variants(seed) + [(None, "w1 w2 w3 w4 w5 w6 alone here"), (5000, "zz yy xx ww vv uu"), (5000, "zz yy xx ww vv uu")]
    sets, least, count = components(rows, k, 80)
    got = near_dedup(frame(spark, rows), k=k).orderBy("_row").collect()
    assert len(got) == len(rows)
    assert sorted((r.doc_id or -1, r.n_shingles, r.component_id or -1, r.kept) for r in got) == sorted(
        (i or -1, len(sets[n]), (i if not sets[n] else least[n]) or -1, i is not None and i == (i if not sets[n] else least[n])) for n, (i, _) in enumerate(rows))
    assert sum(r.first_of_group for r in got) == count


def test_links_between_members_that_their_centre_misses(spark):
    # the centre (smallest) shares most bands with both others, which are alike, but isn't linked with them
    base = [f"a{i}" for i in range(100)]
    rows = [(0, " ".join(base))]
    for s in range(1, 40):
        rows.append((s, " ".join(base[:86] + [f"b{i}" for i in range(13)] + [f"c{s}"])))
    _, least, _ = components(rows, 1, 80)
    got = {r.doc_id: r.component_id for r in near_dedup(frame(spark, rows), k=1).collect()}
    assert got == {rows[i][0]: c for i, c in least.items()}


def test_stars_join_a_family_about_the_threshold(spark):
    # edited copies whose similarities lie on both sides of 0.8: pairs compared stay linear, components come out
    rng = random.Random(9)
    base = [f"v{i}" for i in range(120)]
    rows = []
    for i in range(400):
        own = list(base)
        for at in rng.sample(range(120), rng.randint(5, 11)):
            own[at] = f"e{rng.randrange(10**9)}"
        rows.append((i, " ".join(own)))
    _, least, count = components(rows, 1, 80)
    got = {r.doc_id: r.component_id for r in near_dedup(frame(spark, rows), k=1).collect()}
    sizes = {c: list(least.values()).count(c) for c in set(least.values())}
    linked = [i for i in least if sizes[least[i]] > 1]
    assert all(least[got[i]] == least[i] for i in got)  # nothing is joined that has no links
    assert count > 1 and len(linked) > 100 and sum(got[i] == least[i] for i in linked) >= 0.95 * len(linked)


def test_a_round_of_stars_has_two_candidates_a_bucket_row(spark):
    rows = [(b, 10 * b + i, 10 * b + i, 100, 0, 0, 0, 0) for b in range(3) for i in range(10)] + [(9, 1, 0, 100, 0, 0, 0, 0), (9, 2, 0, 100, 0, 0, 0, 0)]
    placed = spark.createDataFrame(rows, "bucket long, _row long, c long, n long, k1 long, k2 long, k3 long, k4 long")
    none = spark.createDataFrame([], "low long, high long")
    opened, pairs = minhash._drawn_stars(placed, none, 0, 80)
    assert opened.count() == 30 and pairs.count() == 3 * (9 + 8)
    again = minhash._drawn_stars(opened, minhash._ends(pairs), 1, 80)[1]
    assert again.join(pairs, ["a", "b"]).count() == 0


def test_densified_bins_agree_like_the_sets(spark):
    sign = Signer(32, 5)
    a, b = shingle_sets([b" ".join(b"x%d" % i for i in range(20)), b" ".join(b"x%d" % i for i in range(2, 22))], 1)
    same = (sign.bins_of(a) == sign.bins_of(b)).mean()
    assert 0.6 < same < 1.0  # Jaccard 18 / 22


def test_sketches_at_the_threshold_are_never_too_far(spark):
    sign, rng, rows = Signer(32, 5), random.Random(3), []
    for size in (4, 8, 16, 24, 40, 100, 300, 1200):
        for _ in range(150):
            words = [b"y%d" % rng.randrange(10**9) for _ in range(size + size // 4)]
            one, two = shingle_sets([b" ".join(words[:size]), b" ".join(words)], 1)  # Jaccard 0.8
            rows.append((size, *sign(one)[1].tolist(), size + size // 4, *sign(two)[1].tolist()))
    df = spark.createDataFrame(rows, ", ".join(f"{side}{c} long" for side in ("l_", "") for c in ("n", *minhash.KEYS)))
    assert df.where(f"not ({minhash._plausible(80)})").count() == 0


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(200, 200), (300, 299)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[100 + i] == 100 for i in range(60)) and got[300] == 299 and 200 not in got


def test_rows_keep_their_keys_however_they_are_dealt(spark):
    from skylens.llm.common import keyed
    rows = spark.range(500).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"), F.lit(1).alias("x")).repartition(7)
    own = keyed(rows)
    assert own.select("_row", "doc_id").exceptAll(own.where("text <> '3'").select("_row", "doc_id")).count() == 1
    assert {r._row for r in own.select("_row").collect()} == {r._row for r in own.select("_row", "text").collect()}


def test_row_keys_hold_while_cores_come_and_go(spark, tmp_path):
    """Rows of nine files, read with another number of cores between planning and running."""
    from skylens.llm.common import ROW, keyed, with_rows
    path = str(tmp_path / "documents.parquet")
    spark.range(4000).selectExpr("id AS doc_id", "concat('text ', id % 1500) AS text").repartition(9).write.parquet(path)
    setting = "spark.sql.leafNodeDefaultParallelism"
    docs = spark.read.parquet(path)
    try:
        spark.conf.set(setting, "4")
        one = {r.doc_id: r[ROW] for r in keyed(docs).collect()}
        dedup = exact_dedup(docs)
        spark.conf.set(setting, "2")
        assert {r.doc_id: r[ROW] for r in keyed(docs).collect()} == one == {r.doc_id: r[ROW] for r in with_rows(docs).collect()}
        assert len(set(one.values())) == 4000
        assert {r.doc_id: r.keep_id for r in dedup.collect()} == {i: i % 1500 for i in range(4000)}
    finally:
        spark.conf.unset(setting)
    shuffled = docs.orderBy(F.rand()).where("doc_id % 2 = 0")  # not read row by row: written first
    assert keyed(shuffled).select(ROW).distinct().count() == 2000
