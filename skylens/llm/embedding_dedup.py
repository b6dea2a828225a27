"""Embedding near-dedup by random hyperplane cells, each compared whole.

In each pass vectors with the same ``bits_for`` hyperplane signs form a cell, and all pairs of a cell
are compared, however many it holds; pairs of all passes whose cosine is at least the threshold are
united. A pair at the threshold shares a cell of one pass with a probability that depends on the
number of bits alone, not on where other vectors lie; passes are so many that all miss it with
probability ``MISS`` at most.

Scale: equal vectors are one row. Bits follow the number of vectors, so that a cell of evenly spread
vectors holds about ``WINDOW``; a crowded cell is cut into blocks of about ``BLOCK`` rows and its pairs
of blocks are spread over tasks. A pair counts in the first pass that it shares a cell in, and tasks give
degrees and a spanning forest instead of pairs, so a dense family makes no table of all its links.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from skylens.llm.common import ROW, connected_components, first_row, with_rows, written

WINDOW, BLOCK, MOST_BITS, MISS = 64, 2048, 31, 1e-3


def passes_for(rows: int, threshold: float, window: int = WINDOW, miss: float = MISS) -> int:
    """Passes after which a pair at ``threshold`` is missed with probability ``miss`` at most."""
    same_bit = 1 - math.acos(min(threshold, 1.0)) / math.pi
    found = same_bit ** max(0.0, math.log2(max(rows, 1) / window))
    return 1 if found >= 1 - miss else math.ceil(math.log(miss) / math.log1p(-found))


def bits_for(rows: int, window: int = WINDOW) -> int:
    """Signs that name a cell: evenly spread vectors leave from ``window`` to twice as many in one."""
    return min(MOST_BITS, max(0, int(math.log2(max(rows, 1) / window)))) if rows > window else 0


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Names the valid vectors by their bytes (0.0 and -0.0 alike); others get no name."""
    for batch in batches:
        names = []
        for v in batch.column("v").to_pylist():
            x = np.array([np.nan if c is None else c for c in v], np.float64) + 0.0 if v else np.zeros(0)
            ok = len(x) and np.isfinite(x).all() and x.any()
            names.append(hashlib.blake2b(x.tobytes(), digest_size=16).digest() if ok else None)
        yield pa.RecordBatch.from_arrays([batch.column(ROW), batch.column("vec_id"), pa.array(names, pa.binary())], names=[ROW, "vec_id", "digest"])


def _matrix(column: pa.ListArray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Row numbers and unit vectors, by dimension."""
    sizes = np.asarray(column.value_lengths())
    flat, offsets = np.asarray(column.flatten(), np.float64), np.concatenate([[0], np.cumsum(sizes)])
    out = {}
    for d in np.unique(sizes):
        at = np.flatnonzero(sizes == d)
        x = flat[offsets[at][:, None] + np.arange(d)]
        x = x / np.abs(x).max(axis=1, keepdims=True)  # squares of very large or small parts stay finite
        out[int(d)] = (at, x / np.sqrt((x * x).sum(axis=1, keepdims=True)))
    return out


def _keys(passes: int, bits: int):
    """Each row's dimension and cells of all passes (int32, one after the other)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = 1 << np.arange(bits, dtype=np.int64)
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            for d, (at, x) in _matrix(batch.column("v")).items():
                if d not in planes:
                    planes[d] = np.random.default_rng([d, 5]).standard_normal((passes, d, bits))
                keys = np.stack([((x @ planes[d][p]) > 0) @ weights for p in range(passes)], axis=1).astype(">i4")
                rows = batch.take(pa.array(at))
                yield pa.RecordBatch.from_arrays([rows.column(ROW), rows.column("size"), rows.column("v"), pa.array(np.full(len(at), d, np.int32)),
                                                  pa.array([k.tobytes() for k in keys], pa.binary())], names=[ROW, "size", "v", "d", "keys"])

    return run


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest node that each of ``n`` nodes is joined with by the edges (a, b)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        if (label[a] == low).all() and (label[b] == low).all():
            return label
        for ends in (label[a], label[b]):
            np.minimum.at(label, ends, low)
        while (label[label] != label).any():
            label = label[label]


def _links(x: np.ndarray, keys: np.ndarray, own: int, first: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs at ``threshold`` or more that share no cell before pass ``own``: within one
    block, or between the rows marked ``first`` and the others."""
    left = np.flatnonzero(first)
    right = left if len(left) == len(x) else np.flatnonzero(~first)
    found = []
    for low in range(0, len(left), 512):
        part = left[low:low + 512]
        i, j = np.nonzero(x[part] @ x[right].T >= threshold)
        i, j = part[i], right[j]
        if right is left:
            i, j = i[i < j], j[i < j]
        for p in range(own):
            new = keys[i, p] != keys[j, p]
            i, j = i[new], j[new]
        found.append((i, j))
    return tuple(np.concatenate(side) if found else np.zeros(0, np.int64) for side in zip(*found))


def _compared(threshold: float, passes: int):
    """(a, b, others) of rows sorted by cell and pair of blocks: joined rows, or a row and what it links with."""

    def links(run: pa.Table) -> pa.RecordBatch:
        rows, sizes = np.asarray(run[ROW]), np.asarray(run["size"])
        (_, x), = _matrix(run["v"].combine_chunks()).values()
        keys = np.frombuffer(b"".join(run["keys"].to_pylist()), ">i4").reshape(len(rows), passes)
        i, j = _links(x, keys, run["pass"][0].as_py(), np.asarray(run["block"]) == run["i"][0].as_py(), threshold)
        others = np.bincount(i, sizes[j], len(rows)) + np.bincount(j, sizes[i], len(rows))
        label, linked = _forest(i, j, len(rows)), np.flatnonzero(others)
        child = np.flatnonzero(label != np.arange(len(rows)))
        a = np.concatenate([rows[child], rows[linked]])
        b = pa.concat_arrays([pa.array(rows[label[child]], pa.int64()), pa.nulls(len(linked), pa.int64())])
        n = np.concatenate([np.zeros(len(child), np.int64), np.rint(others[linked]).astype(np.int64)])
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), b, pa.array(n, pa.int64())], names=["a", "b", "others"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # rows of the last cell seen, which may go on

        def cell(batch: pa.RecordBatch, at: int) -> tuple:
            return tuple(batch.column(name)[at].as_py() for name in ("pass", "d", "key", "i", "j"))

        for batch in batches:
            if not batch.num_rows:
                continue
            names = np.stack([np.asarray(batch.column(name)).astype(np.int64) for name in ("pass", "d", "key", "i", "j")])
            cuts = [0, *(np.flatnonzero((names[:, 1:] != names[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for low, high in zip(cuts, cuts[1:]):
                if held and cell(held[0], 0) != cell(batch, low):
                    if sum(h.num_rows for h in held) > 1:
                        yield links(pa.Table.from_batches(held))
                    held.clear()
                held.append(batch.slice(low, high - low))
        if sum(h.num_rows for h in held) > 1:
            yield links(pa.Table.from_batches(held))

    return run


def linked(vectors: DataFrame, threshold: float, window: int = WINDOW, block: int = BLOCK, miss: float = MISS) -> DataFrame:
    """For ``vectors`` (_row, size, v: valid, no two equal): rows (a, b) whose components are those of all
    links found, and rows (a, null, others) whose sums are the sizes of all rows that a links with."""
    rows = vectors.count()
    passes, bits = passes_for(rows, threshold, window, miss), bits_for(rows, window)
    named = written(vectors.mapInArrow(_keys(passes, bits), f"{ROW} long, size long, v array<double>, d int, keys binary"), "cells")
    key = F.expr("conv(hex(substr(keys, 4 * pass + 1, 4)), 16, 10)").cast("int")
    cells = named.select(ROW, "d", "keys", F.explode(F.sequence(F.lit(0), F.lit(passes - 1))).alias("pass")).select(ROW, "d", "pass", key.alias("key"))
    cells = written(cells, "placed")
    counts = cells.groupBy("pass", "d", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    counts = written(counts.select("pass", "d", "key", F.expr(f"cast(ceil(n / {block}) as int)").alias("blocks")), "crowds")
    # a row of block b goes to the pairs of blocks (b, o) and (o, b); alone in its cell it goes nowhere
    placed = cells.join(counts, ["pass", "d", "key"]).withColumn("block", F.expr(f"cast(pmod(xxhash64({ROW}), blocks) as int)"))
    placed = placed.select(ROW, "pass", "key", "block", F.explode(F.expr("sequence(0, blocks - 1)")).alias("o"))
    placed = written(placed.select(ROW, "pass", "key", "block", F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j")), "blocks")
    order = ["pass", "d", "key", "i", "j"]
    dealt = placed.join(named, ROW).repartition(*order).sortWithinPartitions(*order)
    return dealt.select(*order, "block", ROW, "size", "v", "keys").mapInArrow(_compared(threshold, passes), "a long, b long, others long")


def embedding_dedup(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.95,
                    window: int = WINDOW, block: int = BLOCK, miss: float = MISS) -> DataFrame:
    """One row per input row: _row, vec_id, n_links, component_id, kept, first_of_group.

    Links are pairs found with a cosine of at least ``threshold`` in double precision; equal vectors
    are always found. Null vectors, empty and zero ones, and those with null or non-finite parts
    link with nothing; vectors of different lengths don't link. component_id is the smallest id
    reachable; with repeated or null ids it is the smallest id there is, and ``first_of_group``
    marks one row. Other columns are ignored; an empty table gives no rows.
    """
    df = with_rows(df.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("v")))
    rows = df.select(ROW, F.col("vec_id").cast("long").alias("vec_id"), F.col("v").cast("array<double>").alias("v"))
    named = written(rows.mapInArrow(_digests, f"{ROW} long, vec_id long, digest binary"), "named")
    classes = written(named.where("digest is not null").groupBy("digest").agg(F.min(first_row("vec_id")).alias("rep"), F.count(F.lit(1)).alias("size")), "classes")
    reps = classes.select("digest", F.col("rep.row").alias(ROW), F.col("rep.doc_id").alias("rep_id"), "size")
    vectors = written(rows.select(ROW, "v").join(reps.select(ROW, "size"), ROW), "vectors")
    links = written(linked(vectors, threshold, window, block, miss), "links")
    degrees = written(links.where("b is null").groupBy("a").agg(F.sum("others").alias("others")), "degrees")
    labels = connected_components(links.where("b is not null").select("a", "b")).withColumnRenamed("node", ROW)
    grouped = (reps.join(labels, ROW, "left").select("digest", ROW, "rep_id", "size", F.coalesce("component", ROW).alias("component")))
    grouped = written(grouped.join(degrees.withColumnRenamed("a", ROW), ROW, "left")
                      .select("digest", ROW, "rep_id", "component", (F.col("size") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")), "grouped")
    firsts = written(grouped.groupBy("component").agg(F.min(first_row("rep_id")).alias("first")), "firsts")
    facts = written(grouped.join(firsts, "component").select("digest", "n_links", "first"), "facts")
    own_key = F.coalesce("digest", F.col(ROW).cast("string").cast("binary"))
    component = F.when(F.col("first").isNull(), F.col("vec_id")).otherwise(F.col("first.doc_id"))
    return (named.select(ROW, "vec_id", own_key.alias("digest")).join(facts, "digest", "left")
            .select(ROW, "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"),
                    F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
                    (F.col("first").isNull() | (F.col(ROW) == F.col("first.row"))).alias("first_of_group")))
