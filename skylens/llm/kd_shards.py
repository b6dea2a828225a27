"""Shards as the leaves of a k-d tree over document metadata.

All documents are one node at first. Each round splits every node that holds more than the target bytes at
once: along its widest dimension (the extent of its values relative to that of the whole table) at the
weighted median, so that both sides get bytes in the proportion of the leaves they are to hold. Rows
are sorted by (node, value, text, id) over many tasks; tasks sum their bytes, and the sums of the tasks
before tell each row how many bytes lie before it. A cut falls between two different texts where that
costs no more than ``slack`` of the target, so equal texts (whose metadata are equal) share a shard
unless their group is too large for that.

Scale: one range shuffle of narrow rows (id, size, check sum, hash, metadata; never the text) a round,
log2(shards) rounds. Equal rows differ in their place in the table, so a third of all rows with one
value or one text are cut over as many tasks as any others. The driver and broadcasts get a row for each node
or for each (task, node).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from skylens.llm.common import ship, written

#: Share of the target bytes by which a cut may miss the median to keep equal texts together.
SLACK = 0.01


def number(df: DataFrame, name: str) -> Column:
    """The column as a double in its own order; texts by their first six bytes. Nulls and NaN come before all."""
    column = F.col(name)
    if dict(df.dtypes)[name] in ("string", "binary"):
        column = F.conv(F.rpad(F.hex(F.substring(column.cast("binary"), 1, 6)), 12, "0"), 16, 10).cast("double")
    column = column.cast("double")
    return F.when(F.isnan(column), None).otherwise(column)


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes and rows of the task before each row of the same node; rows come sorted by node."""
    node, held, rows = None, 0, 0
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        nodes = batch.column("node").to_numpy()
        size = batch.column("size").to_numpy()
        before = np.cumsum(size) - size
        head = np.flatnonzero(np.r_[True, nodes[1:] != nodes[:-1]])
        start = np.repeat(head, np.diff(np.r_[head, n]))
        carried = nodes == node
        left = before - before[start] + np.where(carried, held, 0)
        index = np.arange(n) - start + np.where(carried, rows, 0)
        node, held, rows = nodes[-1], int(left[-1] + size[-1]), int(index[-1] + 1)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(left, pa.int64()), pa.array(index, pa.int64())], names=[*batch.schema.names, "left", "index"])


def _placed(points: DataFrame, widest: DataFrame, tag: str) -> DataFrame:
    """``points`` with ``left`` and ``index``, the bytes and rows of their node before each in sorted order."""
    order = ["node", "value", "copy", "doc_id", "row"]
    value = F.when(F.col("widest") >= 0, F.element_at("at", F.col("widest") + 1))
    laid = (points.join(F.broadcast(widest), "node").withColumn("value", value).drop("widest")
            .repartitionByRange(*order).withColumn("part", F.spark_partition_id()).sortWithinPartitions(*order))
    schema = StructType([*laid.schema.fields, StructField("left", LongType()), StructField("index", LongType())])
    laid = written(laid.mapInArrow(_running, schema), tag)
    sums = laid.groupBy("node", "part").agg(F.max(F.col("left") + F.col("size")).alias("held"), F.count(F.lit(1)).alias("rows"))
    earlier = Window.partitionBy("node").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select("node", "part", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("b"), F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("r"))
    before = written(before, f"{tag}-before")
    return (laid.join(F.broadcast(before), ["node", "part"])
            .withColumns({"left": F.col("left") + F.col("b"), "index": F.col("index") + F.col("r")}).drop("b", "r", "part"))


def _table(spark: SparkSession, values: dict[int, int], column: str) -> DataFrame:
    """A row for each node of the tree, of which there are no more than shards."""
    return spark.createDataFrame(list(values.items()), f"node long, {column}")


def _widest(extents: tuple, widths: list) -> int:
    """The dimension with the largest share of its whole width, -1 if a node's values agree in all."""
    shares = [(e or 0) / w if w else 0 for e, w in zip(extents, widths)]
    return max(range(len(shares)), key=shares.__getitem__) if any(shares) else -1


def _cuts(placed: DataFrame, ideal: DataFrame, slack: int) -> dict[int, int]:
    """Bytes on the lower side of each node: cut at the row boundary next to the ideal, or at the edge of the group of
    equal texts about it where that is at most ``slack`` bytes away. A row a node comes to the driver."""
    here = placed.join(F.broadcast(ideal), "node").where((F.col("left") <= F.col("ideal")) & (F.col("ideal") < F.col("left") + F.col("size")))
    hit = here.select("node", "ideal", "value", "copy", F.when(F.col("ideal") - F.col("left") <= F.col("left") + F.col("size") - F.col("ideal"), F.col("left"))
                      .otherwise(F.col("left") + F.col("size")).alias("near"))
    hit = written(hit, "hit")
    group = placed.select("node", "value", "copy", "left", "size").join(
        F.broadcast(hit.withColumnsRenamed({"node": "n", "value": "v", "copy": "c"})),
        (F.col("node") == F.col("n")) & F.col("value").eqNullSafe(F.col("v")) & (F.col("copy") == F.col("c")))
    edges = group.groupBy("node").agg(F.min("left").alias("low"), F.max(F.col("left") + F.col("size")).alias("high"), F.first("ideal").alias("ideal"), F.first("near").alias("near"))
    out = {}
    for r in edges.collect():
        edge = r.low if r.ideal - r.low <= r.high - r.ideal else r.high
        out[r.node] = edge if abs(edge - r.ideal) <= slack else r.near
    return out


def kd_shards(df: DataFrame, dimensions: list[str], target_bytes: int | None = None, shards: int | None = None, id_col: str = "doc_id",
              text_col: str = "text", slack: float = SLACK) -> DataFrame:
    """One row per input row: doc_id, size (bytes of the text in UTF-8 and 1), text_crc32, shard, slot.

    Shards are numbered from 0 in the order of the tree's leaves. Give ``target_bytes`` (as many shards as
    the table needs at that size) or their number. ``slot`` counts a shard's rows from 0 without gaps.

    A null text has size 1 and the check sum of the empty text. Null metadata come before all other values,
    null ids before all others; rows of equal ids are told apart by their place. Ties in the metadata are
    split by text and id, so shards are near equal however many rows agree; a node whose documents agree in
    every dimension is split by these alone. With fewer documents than shards some are empty. An
    empty table gives no rows. Columns that aren't named are ignored.
    """
    if (target_bytes is None) == (shards is None):
        raise ValueError("give target_bytes or shards")
    spark = ship(df.sparkSession)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    points = df.select(F.lit(0).cast("long").alias("node"), F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("copy"), F.array(*[number(df, c) for c in dimensions]).cast("array<double>").alias("at"))
    points = written(points.withColumn("row", F.monotonically_increasing_id()), "points")
    extents = [F.max(F.element_at("at", i + 1)) - F.min(F.element_at("at", i + 1)) for i in range(len(dimensions))]
    total, *widths = points.agg(F.sum("size"), *extents).first()
    leaves = max(1, shards if shards is not None else math.ceil((total or 0) / target_bytes))
    slack_bytes = int(slack * (total or 0) / leaves)
    tree = {0: (0, leaves)}  # node -> (first leaf, number of leaves)
    placed = _placed(points, _table(spark, {0: -1}, "widest int"), "placed") if leaves == 1 or not total else None
    while total and any(n > 1 for _, n in tree.values()):
        open_nodes = {k: n for k, (_, n) in tree.items() if n > 1}
        stats = {r[0]: r[1:] for r in points.groupBy("node").agg(F.sum("size"), *extents).collect()}
        widest = {k: _widest(stats[k][1:], widths) if k in open_nodes else -1 for k in stats}
        placed = _placed(points, _table(spark, widest, "widest int"), "placed")
        ideal = {k: stats[k][0] * (n // 2) // n for k, n in open_nodes.items() if k in stats}
        cuts = _cuts(placed, _table(spark, ideal, "ideal long"), slack_bytes)
        child = F.when(F.col("cut").isNull(), F.col("node")).otherwise(F.col("node") * 2 + F.when(F.col("left") < F.col("cut"), 1).otherwise(2))
        placed = placed.join(F.broadcast(_table(spark, cuts, "cut long")), "node", "left").withColumn("node", child).drop("cut")
        for k, n in open_nodes.items():
            first, _ = tree.pop(k)
            tree[2 * k + 1], tree[2 * k + 2] = (first, n // 2), (first + n // 2, n - n // 2)
        points = placed.drop("left", "index", "value")
    # a node that was just cut in two keeps its order, so its sides start at their smallest index
    starts = written(placed.groupBy("node").agg(F.min("index").alias("start")), "starts")
    shard = _table(spark, {k: first for k, (first, _) in tree.items()}, "shard int")
    return (placed.join(F.broadcast(starts.join(F.broadcast(shard), "node")), "node")
            .select("doc_id", "size", "text_crc32", "shard", (F.col("index") - F.col("start")).alias("slot")))
