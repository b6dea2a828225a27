"""Periodic runs against a search of every period, and the transforms against plain convolution."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from skylens.llm import periodic_runs as pr
from skylens.llm.queries import op11_periodic_runs


def brute(words):
    """Every maximal stretch by definition: (start, length, period)."""
    best, n = {}, len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                best.setdefault((i, j + q), q)
            i = max(j, i) + 1
    return sorted((a, b - a, q) for (a, b), q in best.items())


def collapsed(words, runs):
    return " ".join(w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in runs))


def found(texts):
    sizes = np.array([len(t) for t in texts], np.int64)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    start, end, period = pr.find_runs(pr._words_numbered([w.encode() for t in texts for w in t], sizes), bounds)
    out = [[] for _ in texts]
    for a, b, q in zip(start, end, period):
        t = int(np.searchsorted(bounds, a, side="right") - 1)
        out[t].append((int(a - bounds[t]), int(b - a), int(q)))
    return out


@pytest.mark.parametrize("n", [1, 2, 8, 64])
def test_transform_is_a_cyclic_convolution(n):
    rng = np.random.default_rng(n)
    for prime, generator in pr.PRIMES:
        a, b = rng.integers(0, prime, (3, n)), rng.integers(0, prime, (3, n))
        got = pr.inverse(pr.transform(a, prime, generator) * pr.transform(b, prime, generator) % prime, prime, generator)
        want = [[sum(int(a[r, i]) * int(b[r, (k - i) % n]) for i in range(n)) % prime for k in range(n)] for r in range(3)]
        assert got.tolist() == want


def test_occurrences_take_as_many_primes_as_they_need():
    rng = np.random.default_rng(1)
    for top in (3, 40_000, 30_000_000):  # products of one, two and three primes
        windows = rng.integers(top - 2, top, (50, 16))
        blocks = windows[:, 3:11].copy()
        want = [[bool((blocks[r] == windows[r, e:e + 8]).all()) for e in range(8)] for r in range(50)]
        assert pr.occurrences(blocks, windows).tolist() == want
    # differences whose squares sum to a prime are no match
    assert not pr.occurrences(np.array([[44869, 1]]), np.array([[0, 1, 0, 0]]))[0, 0]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.text("ab", min_size=1, max_size=9), st.integers(1, 9)), max_size=8))
def test_any_repeated_pieces(pieces):
    words = [c for piece, times in pieces for c in piece * times]
    assert found([words, words[::-1], [], words]) == [brute(words), brute(words[::-1]), [], brute(words)]


@pytest.mark.parametrize("seed", range(12))
def test_long_periods_and_runs_inside_runs(seed):
    rng = random.Random(seed)
    texts = []
    for _ in range(6):
        words = []
        while len(words) < 700:
            piece = [str(rng.randrange(rng.choice([2, 30, 1000]))) for _ in range(rng.choice([1, 2, 3, 7, 16, 31, 33, 90]))]
            if rng.random() < 0.3:
                piece = piece[:1] * 7 + piece
            words += piece * rng.choice([1, 2, 3, 4, 5, 9]) + piece[:rng.randrange(len(piece))]
        texts.append(words)
    assert found(texts) == [brute(t) for t in texts]


def test_one_word_over_and_over():
    assert found([["a"] * 50_000, ["a"] * 5, ["a"] * 6]) == [[(0, 50_000, 1)], [], [(0, 6, 1)]]


def test_texts_that_repeat_each_other_stay_apart():
    assert found([list("abcd")] * 9) == [[]] * 9


def test_rows(spark):
    texts = [None, "", "  \n", "a b " * 9, "x y " * 7, "a b " * 9, "\x1c " * 6, "no run here", "z " * 20_000]
    rows = [(i if i != 4 else None, t, i) for i, t in enumerate(texts)] + [(3, "a b " * 9, 0)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, runs int")
    for size in (4, pr.GROUP_WORDS):
        got = sorted(map(str, pr.periodic_runs(df, group_words=size).collect()))
        want = []
        for i, t, _ in rows:
            words = [w.decode() for w in (t or "").encode().split()]
            runs = brute(words) if len(words) < 10_000 else [(0, 20_000, 1)]
            text = collapsed(words, runs) if len(words) < 10_000 else "z"
            want.append(pr_row(i, len(words), runs, text))
        assert got == sorted(map(str, want))
    assert pr.periodic_runs(df.where("false")).count() == 0


def pr_row(doc_id, n, runs, text):
    from pyspark.sql import Row
    return Row(doc_id=doc_id, n_words=n, runs=[Row(start=a, length=b, period=q) for a, b, q in runs], collapsed=text)


def test_query_rebuilds_and_digests(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice("abcdefghij") for _ in range(rng.randrange(0, 160))) + rng.choice(["", " \t", " q" * 9])) for i in range(250)]
    rows += [(None, "n " * 8), (7, None), (10 ** 12, "\n".join("uvw" * 30))]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {(r.doc_id, r.runs_sha256, r.collapsed_sha256): r.asDict() for r in op11_periodic_runs(spark, str(tmp_path)).collect()}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    for doc_id, text in rows:
        words = [w.decode() for w in (text or "").encode().split()]
        h, n = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1, len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
        runs = brute(words)
        top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        key = (doc_id, sha("".join(f"{a},{b},{q}\n" for a, b, q in runs)), sha(collapsed(words, runs)))
        row = got[key]
        assert row["n_runs"] == len(runs)
        assert (row["start"], row["length"], row["period"], row["exponent_milli"]) == ((*top, 1000 * top[1] // top[2]) if top else (None,) * 4)
