"""MinHash near-dedup: one-permutation hashing, optimal densification, bands, star-shaped candidates.

A document's set is its distinct word shingles. One hash function splits all shingle hashes over
``BINS`` bins and each bin keeps its smallest; an empty bin copies the bin that its own sequence of
pseudo-random probes meets first (the same sequence for every document). Bands of bins name
buckets; in a bucket every member is a candidate with the bucket's centre only, so candidates are
at most as many as bucket rows. One bit of every bin makes a sketch: candidates whose sketches
differ in more bits than a pair at J = 0.8 does (26 on average, and 5.5 standard deviations, which
depend on how many bins the smaller set fills; sets under 16 aren't judged by it), or whose sizes
can't reach the similarity, go no further. The others are confirmed on full sets.

A star compares no two members with each other, and its first centre is any of them. So ``STAR_ROUNDS``
more rounds follow. Links found so far contract the members of a bucket to components; one member
of each component is drawn by a hash, anew in each bucket and round, and two of those drawn are
centres: that of the bucket's largest component and that of another. Each is compared with the members
outside its own component, so a round has at most two candidates per bucket row, however alike a
family is. A pair at the similarity shares some ten buckets of 32, each with centres of its own. What
can be missed is a component whose only links lead to members that were never drawn; the share
found in families about the threshold is measured by a test and stated in the README.

Scale: equal sets are collapsed first (a group of copies is one row from then on); texts move once
for candidates, spread by (centre, share of its members), so a centre with very many members is
several tasks. Later rounds read only the texts of members whose buckets hold several components,
written once. At J = 0.8 a pair shares no band with probability below 4e-6 (32 bands of 5).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from skylens.llm import spans
from skylens.llm.common import ROW, connected_components, first_row, keyed, written

BANDS, ROWS, BINS = 32, 5, 256
STAR_ROUNDS = 4
# bits in which sketches may differ: of the smaller set's n shingles, {n} is put in
FAR = "if({n} < 16, 256, 26 + 5.5 * sqrt(128 * 128 * 0.16 / (256 * (1 - exp(-{n} / 256.0))) + 21))"
KEYS = ["k1", "k2", "k3", "k4"]  # the sketch
MEMBERS = 256  # members of a centre compared in one group
_SPREAD = np.random.default_rng(7).integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)


def shingle_sets(texts: list[bytes], k: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's k-word shingles (A-Z in lower case).

    With fewer than k words the whole sequence is one shingle; without words the set is empty.
    """
    buf, begins = spans.join_texts(texts)
    buf = spans.lowered(buf)
    starts, ends = spans.words(buf)
    word = spans.hashes(buf, starts, ends)
    first = np.searchsorted(starts, begins)
    count = np.diff(np.append(first, len(starts)))
    total = max(len(word) - k + 1, 0)
    rolled = np.zeros(total, np.uint64)
    for j in range(k):
        rolled += word[j:j + total] * _SPREAD[j]
    rolled = spans.mix(rolled)
    out = []
    for f, n in zip(first.tolist(), count.tolist()):
        if n >= k:
            out.append(np.unique(rolled[f:f + n - k + 1]))
        elif n:
            out.append(spans.mix((word[f:f + n] * _SPREAD[:n]).sum(keepdims=True) + np.uint64(n) * _SPREAD[-1:]))
        else:
            out.append(np.empty(0, np.uint64))
    return out


class Signer:
    """Band hashes and sketch of a shingle set; holds the probe order of every bin."""

    def __init__(self, bands: int, rows: int):
        if bands * rows > BINS:
            raise ValueError(f"{bands} bands of {rows} need more than {BINS} bins")
        self.bands, self.rows = bands, rows
        rng = np.random.default_rng(11)
        self.probes = np.argsort(rng.random((BINS, BINS)), axis=1).astype(np.int32)
        self.lower = np.arange(BINS, dtype=np.uint64) * np.uint64(2**64 // BINS)
        self.spread = rng.integers(1, 2**63, rows, dtype=np.uint64) | np.uint64(1)
        self.tag = spans.mix(np.arange(1, bands + 1, dtype=np.uint64))
        self.own = spans.mix(np.arange(1000, 1000 + BINS, dtype=np.uint64))

    def bins_of(self, sorted_set: np.ndarray) -> np.ndarray:
        at = np.searchsorted(sorted_set, self.lower)
        to = np.append(at[1:], len(sorted_set))
        full = to > at
        least = sorted_set[np.minimum(at, len(sorted_set) - 1)] - self.lower
        empty = np.flatnonzero(~full)
        if len(empty):
            order = self.probes[empty]
            donor = order[np.arange(len(empty)), full[order].argmax(axis=1)]
            least[empty] = least[donor]
        return least

    def __call__(self, sorted_set: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(a hash for each band, the sketch as four numbers)."""
        least = self.bins_of(sorted_set)
        grid = least[:self.bands * self.rows].reshape(self.bands, self.rows)
        hashes = spans.mix((grid * self.spread).sum(axis=1, dtype=np.uint64) + self.tag).view(np.int64)
        return hashes, np.packbits(spans.mix(least ^ self.own) & np.uint64(1) > 0).view(np.int64)


def _sign(k: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sign = Signer(bands, rows)
        for part, texts in spans.slices(batches, "text"):
            sets = shingle_sets(texts, k)
            signs = [sign(x) if len(x) else None for x in sets]
            yield pa.RecordBatch.from_arrays([
                part.column(ROW), part.column("doc_id"), pa.array([len(x) for x in sets], pa.int64()),
                pa.array([hashlib.blake2b(x.tobytes(), digest_size=16).digest() if len(x) else None for x in sets], pa.binary()),
                pa.array([x and x[0] for x in signs], pa.list_(pa.int64())),
                *[pa.array([x and x[1][i] for x in signs], pa.int64()) for i in range(4)],
            ], names=[ROW, "doc_id", "n", "digest", "bands", *KEYS])

    return run


def _compare(k: int):
    """Rows sorted by (a, share, centre first): each group's first text against the others'."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, centre = None, None
        for part, texts in spans.slices(batches, "text"):
            a, share, b, ca, cb = (part.column(c).to_pylist() for c in ("a", "share", "b", "ca", "cb"))
            found: tuple[list, ...] = ([], [], [], [], [], [])
            for i, own in enumerate(shingle_sets(texts, k)):
                if (a[i], share[i]) != group:
                    group, centre = (a[i], share[i]), own
                    continue
                both = len(np.intersect1d(centre, own, assume_unique=True))
                for column, value in zip(found, (a[i], b[i], both, len(centre) + len(own) - both, ca[i], cb[i])):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], names=["a", "b", "both", "either", "ca", "cb"])

    return run


def _compared(pairs: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """``pairs`` (a, b, and the components ca, cb) with the sizes of the intersection and union of their full sets."""
    sizes = written(pairs.groupBy("a").agg(F.expr(f"(count(*) + {MEMBERS - 1}) div {MEMBERS}").alias("shares")), "shares")
    # joins of tables that grow with the corpus are shuffles at every size
    spread = pairs.join(sizes.hint("merge"), "a").select("a", F.pmod(F.xxhash64("b"), "shares").alias("share"), "b", "ca", "cb", F.col("b").alias(ROW))
    centres = sizes.select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1)).alias("share"),
                           *[F.lit(None).cast("long").alias(c) for c in ("b", "ca", "cb")], F.col("a").alias(ROW))
    wanted = spread.unionByName(centres)
    texts = docs.select(ROW, "text").join(wanted.hint("merge"), ROW).select("a", "share", "b", "ca", "cb", "text")
    return (texts.repartition("a", "share").sortWithinPartitions("a", "share", F.col("b").asc_nulls_first())
            .mapInArrow(_compare(k), "a long, b long, both long, either long, ca long, cb long"))


def _alike(pairs: DataFrame, percent: int) -> DataFrame:
    return pairs.where(f"100 * both >= {percent} * either").select("a", "b", "ca", "cb")


def _plausible(percent: int, left: str = "l_", right: str = "") -> str:
    """SQL: neither sizes nor sketches rule the similarity out."""
    bits = " + ".join(f"bit_count({left}{x} ^ {right}{x})" for x in KEYS)
    return f"100 * least({left}n, {right}n) >= {percent} * greatest({left}n, {right}n) and {bits} <= {FAR.format(n=f'least({left}n, {right}n)')}"


def _stepped(members: DataFrame, step: DataFrame) -> DataFrame:
    """``members`` with their component, ``c``, after the merges of ``step`` (node, component)."""
    later = step.select(F.col("node").alias("c"), F.col("component").alias("later"))
    return members.join(later.hint("merge"), "c", "left").withColumn("c", F.coalesce("later", "c")).drop("later")


def _drawn_stars(placed: DataFrame, tried: DataFrame, number: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(open buckets' members, candidates (a: centre, b, ca, cb) of one round): ``placed`` is (bucket, _row, c, n, sketch)."""
    kept = [ROW, "c", "n", *KEYS]
    drawn = F.struct(F.xxhash64(ROW, "bucket", F.lit(number)), ROW)
    parts = placed.groupBy("bucket", "c").agg(F.count(F.lit(1)).alias("size"), F.max_by(F.struct(*kept), drawn).alias("x"))
    anew = F.struct(F.xxhash64("c", "bucket", F.lit(number)), "c")
    tops = parts.groupBy("bucket").agg(F.max_by("x", F.struct("size", "c")).alias("most"), F.max_by("x", anew).alias("one"), F.min_by("x", anew).alias("two"))
    tops = tops.where("one.c <> two.c").select("bucket", F.expr("array(most, if(one.c <> most.c, one, two))").alias("centres"))
    # a bucket of one component is done
    opened = written(placed.join(tops.hint("merge"), "bucket"), "open")
    stars = opened.select(*kept, F.explode("centres").alias("x")).select(*kept, *[F.col(f"x.{c}").alias(f"l_{c}") for c in kept])
    stars = stars.where(f"l_c <> c and {_plausible(percent)}")
    ends = [F.least(f"l_{ROW}", ROW).alias("low"), F.greatest(f"l_{ROW}", ROW).alias("high")]
    pairs = stars.groupBy(*ends).agg(F.max(F.struct(F.col(f"l_{ROW}").alias("a"), F.col(ROW).alias("b"), F.col("l_c").alias("ca"), F.col("c").alias("cb"))).alias("p"))
    pairs = pairs.join(tried.hint("merge"), ["low", "high"], "left_anti").select("p.*")
    return opened.drop("centres"), written(pairs, "pairs")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high"))


def _later_rounds(placed: DataFrame, tried: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame | None:
    """(a, b): links between components found by the rounds of drawn stars over ``placed`` (bucket, _row, c, n, sketch).

    Between rounds a component takes the name of the smallest that it has a link with, one step of a
    contraction; the names that remain serve the choice of centres alone, and all merges are united at the end.
    """
    tried, texts, merges = _ends(tried), None, None
    for number in range(STAR_ROUNDS):
        placed, pairs = _drawn_stars(placed, tried, number, percent)
        if texts is None:
            if placed.isEmpty():
                break
            texts = written(docs.select(ROW, "text").join(placed.select(ROW).distinct().hint("merge"), ROW), "texts")
        found = written(_alike(_compared(pairs, texts, k), percent).select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b")), "merges")
        merges = found if merges is None else merges.unionByName(found)
        if number + 1 < STAR_ROUNDS:
            tried = tried.unionByName(_ends(pairs))
            step = found.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("component"))
            placed = written(_stepped(placed, step), "placed")
    return merges


def near_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80,
               bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per input row: _row, doc_id, n_shingles, component_id, kept, first_of_group.

    Documents are linked where 100 * |A and B| >= percent * |A or B| on their full sets of k-word
    shingles; component_id is the smallest id reachable by links, itself included. ``kept`` is
    doc_id = component_id; ``first_of_group`` marks one row of each component also where ids are
    repeated. Null and empty texts, and texts without words, have an empty set and stand alone.
    Rows with a null id take part; component_id is null only where every id of a group is null, and
    ``kept`` is then false. Other columns are ignored; an empty table gives no rows.
    """
    docs = keyed(df, id_col, text_col)
    numbers = ", ".join(f"{x} long" for x in KEYS)
    signed = written(docs.mapInArrow(_sign(k, bands, rows), f"{ROW} long, doc_id long, n long, digest binary, bands array<long>, {numbers}"), "signed")
    classes = written(signed.where("n > 0").groupBy("digest").agg(F.min(first_row()).alias("rep")), "classes")
    own = signed.where("n > 0").join(classes.select(F.col("rep.row").alias(ROW)).hint("merge"), ROW)
    buckets = written(own.select(ROW, "n", *KEYS, F.explode("bands").alias("bucket")), "buckets")
    centres = written(buckets.groupBy("bucket").agg(F.min(F.struct(ROW, "n", *KEYS)).alias("c"), F.count(F.lit(1)).alias("size"))
                      .where("size > 1").select("bucket", F.col(f"c.{ROW}").alias("a"), *[F.col(f"c.{x}").alias(f"l_{x}") for x in ("n", *KEYS)]), "centres")
    stars = written(buckets.join(centres.hint("merge"), "bucket").where(f"{ROW} <> a")
                    .select("bucket", "a", F.col(ROW).alias("b"), "n", *KEYS, F.expr(_plausible(percent)).alias("plausible")), "stars")
    pairs = written(stars.where("plausible").select("a", "b", F.col("a").alias("ca"), F.col("b").alias("cb")).distinct(), "pairs")
    tried = written(_compared(pairs, docs, k), "tried")
    links = _alike(tried, percent)
    joined = connected_components(links)
    labels = written(_stepped(own.select(ROW, F.col(ROW).alias("c")), joined), "labels")
    sketch = ["n", *KEYS]
    members = (stars.select("bucket", F.col("b").alias(ROW), *sketch)
               .unionByName(centres.select("bucket", F.col("a").alias(ROW), *[F.col(f"l_{x}").alias(x) for x in sketch])))
    placed = written(members.join(labels.hint("merge"), ROW).select("bucket", ROW, "c", *sketch), "placed")
    merges = _later_rounds(placed, tried, docs, k, percent)
    if merges is not None:
        labels = written(_stepped(labels, connected_components(merges)), "labels")
    labels = labels.select(F.col(ROW).alias("node"), F.col("c").alias("component"))
    reps = classes.select("digest", F.col("rep.row").alias("node"), F.col("rep.doc_id").alias("rep_id"))
    grouped = written(reps.join(labels, "node").select("digest", "node", "rep_id", "component"), "grouped")
    firsts = written(grouped.groupBy("component").agg(F.min(first_row("rep_id", "node")).alias("first")), "firsts")
    named = written(grouped.join(firsts, "component").select("digest", "first"), "named")
    own_key = F.coalesce("digest", F.col(ROW).cast("string").cast("binary"))  # empty sets: a key each, none of them a digest
    return (signed.select(ROW, "doc_id", "n", own_key.alias("digest")).join(named, "digest", "left")
            .select(ROW, "doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("first.doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
                    F.coalesce(F.col("doc_id") == F.when(F.col("n") > 0, F.col("first.doc_id")).otherwise(F.col("doc_id")), F.lit(False)).alias("kept"),
                    ((F.col("n") == 0) | (F.col(ROW) == F.col("first.row"))).alias("first_of_group")))
