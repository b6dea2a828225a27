"""Exact dedup by deterministic block naming.

Normalised texts are cut into blocks of a fixed number of bytes. Equal blocks get one integer name
by sorting all blocks of all documents; adjacent names are then paired and the pairs named the same
way, until each document has one name. Equal names mean equal bytes at every level (blocks and
pairs are compared themselves, a hash only orders them), so an identity is free of collisions.

Scale: one range shuffle of the text (hash, row, block number), which cuts a block that a third of
all documents share over many tasks; later levels move integers only and halve each time. What a
task knows of its first and last hash (one or two blocks) is all that is compared between tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from skylens.llm.common import ROW, first_row, keyed, one_space, written

BLOCK_BYTES = 4096
_NAMED = "_row long, doc_id long, sha binary, idx long, n long, name long, edge_h long, edge_key binary"


def _name_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Names rows sorted by (h, key): task number, then the rank of the key in the task.

    Extra rows without ``_row`` give the keys of the task's first and last hash, for ``_named``.
    """
    base = TaskContext.get().partitionId() << 40
    rank, last_h, last_key, first_h = -1, None, None, None
    first_run, run = [], []
    schema = None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        h, key = batch.column("h"), batch.column("key")
        new_h = np.ones(n, bool)
        new_h[1:] = pc.not_equal(h.slice(1), h.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        new = new_h.copy()
        new[1:] |= pc.not_equal(key.slice(1), key.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        if last_key is not None:
            new_h[0] = h[0].as_py() != last_h
            new[0] = new_h[0] or key[0].as_py() != last_key
        ranks = rank + np.cumsum(new)
        if first_h is None:
            first_h = h[0].as_py()
        heads = np.flatnonzero(new_h)
        begin = int(heads[-1]) if len(heads) else 0
        if len(heads):
            run = []
        of_first = pc.equal(h, first_h).to_numpy(zero_copy_only=False)
        named = lambda where: [(base + int(ranks[i]), h[int(i)].as_py(), key[int(i)].as_py()) for i in np.flatnonzero(where)]  # noqa: E731,B023
        first_run += named(new & of_first)
        run += named(new & (np.arange(n) >= begin))
        rank, last_h, last_key = int(ranks[-1]), h[n - 1].as_py(), key[n - 1].as_py()
        schema = schema or pa.schema([batch.schema.field(c) for c in ("_row", "doc_id", "sha", "idx", "n")]
                                     + [pa.field("name", pa.int64()), pa.field("edge_h", pa.int64()), pa.field("edge_key", pa.binary())])
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("_row", "doc_id", "sha", "idx", "n")]
                                         + [pa.array(base + ranks), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary())], schema=schema)
    if schema is not None:
        edges = list({name: (name, h, key) for name, h, key in first_run + run}.values())
        yield pa.RecordBatch.from_arrays([pa.nulls(len(edges), schema.field(i).type) for i in range(5)]
                                         + [pa.array([e[i] for e in edges], schema.field(5 + i).type) for i in range(3)], schema=schema)


def _named(items: DataFrame, level: int) -> DataFrame:
    """Names for ``items`` (_row, doc_id, sha, idx, n, key): equal keys, and only those, get equal names."""
    sorted_items = (items.withColumn("h", F.xxhash64("key")).repartitionByRange("h", ROW, "idx")
                    .sortWithinPartitions("h", "key"))
    out = written(sorted_items.mapInArrow(_name_runs, _NAMED), f"names{level}")
    # a key whose rows lie in several tasks takes its smallest name; two rows or so a task, joined by
    # shuffle where the tasks are so many that these pass Spark's own bound for broadcasts
    edges = out.where(F.col("edge_h").isNotNull()).select("name", "edge_h", "edge_key")
    least = edges.groupBy("edge_h", "edge_key").agg(F.min("name").alias("least"))
    renamed = written(edges.join(least, ["edge_h", "edge_key"]).where("name <> least").select("name", "least"), f"renamed{level}")
    return (out.where(F.col("edge_h").isNull()).join(renamed, "name", "left")
            .select(ROW, "doc_id", "sha", "idx", "n", F.coalesce("least", "name").alias("name")))


def identities(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(_row, doc_id, sha, level, name) for ``docs`` (_row, doc_id, text); (level, name) is the identity."""
    norm = docs.select(ROW, "doc_id", one_space(F.col("text")).alias("norm"))
    blocks = (norm.select(ROW, "doc_id", F.unhex(F.sha2("norm", 256)).alias("sha"), F.col("norm").cast("binary").alias("b"),
                          F.expr(f"greatest(1, ceil(octet_length(norm) / {block_bytes}))").cast("long").alias("n"))
              .select(ROW, "doc_id", "sha", "n", F.posexplode(F.expr(
                  f"transform(sequence(0, n - 1), i -> substring(b, int(i * {block_bytes} + 1), {block_bytes}))")).alias("idx", "key"))
              .select(ROW, "doc_id", F.when(F.col("idx") == 0, F.col("sha")).alias("sha"), F.col("idx").cast("long").alias("idx"), "n", "key"))
    names, level, done = _named(blocks, 0), 0, []
    longest = names.agg(F.max("n")).first()[0] or 1
    base = names.where("idx = 0").select(ROW, "doc_id", "sha")
    done.append(names.where("n = 1").select(ROW, "doc_id", "sha", F.lit(level).alias("level"), "name"))
    while longest > 1:
        level, longest = level + 1, (longest + 1) // 2
        as_bytes = lambda c: F.unhex(F.lpad(F.hex(c), 16, "0"))
        pairs = (names.where("n > 1").groupBy(ROW, F.expr("idx div 2").alias("idx"))
                 .agg(F.max(F.expr("if(idx % 2 = 0, name, null)")).alias("left_name"),
                      F.max(F.expr("if(idx % 2 = 1, name, null)")).alias("right_name"), F.expr("(max(n) + 1) div 2").alias("n"))
                 .select(ROW, F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("binary").alias("sha"), "idx", "n",
                         F.concat(as_bytes("left_name"), F.coalesce(as_bytes("right_name"), F.lit(b""))).alias("key")))
        names = _named(pairs, level)
        done.append(names.where("n = 1").select(ROW, F.lit(level).alias("level"), "name").join(base, ROW)
                    .select(ROW, "doc_id", "sha", "level", "name"))
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return written(out, "identities")


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per input row: _row, doc_id, keep_id, group_size, kept, text_sha256.

    Null text counts as empty, and all empty texts are one group. Of a group the row with the
    smallest id stays (a null id comes last; of repeated ids one row, by its place in the table).
    Texts of any length are compared whole. Other columns are ignored. An empty table gives no rows.
    """
    ids = identities(keyed(df, id_col, text_col), block_bytes)
    groups = written(ids.groupBy("level", "name").agg(F.min(first_row()).alias("keep"), F.count(F.lit(1)).alias("group_size")), "groups")
    return (ids.join(groups, ["level", "name"])
            .select(ROW, "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size",
                    (F.col(ROW) == F.col("keep.row")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256")))
