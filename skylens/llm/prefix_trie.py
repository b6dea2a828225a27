"""Prefix trie of conversations by van Emde Boas recursion.

Every conversation is a sequence of turns after one common root symbol. The sequences are cut at half
their (power of two) depth: the part before a cut is named, equal parts of one trie getting one name,
and the sequences go on below the cut in the forest of that name. Upper tries and lower forests are
cut again in the same way, all at once, until pieces are one turn long; the name of a piece's forest
and its turn then name a node. Totals (leaves, saved tokens) are grafted upwards through the same
cuts: the totals of the lower forests of a cut are added to the ancestors of their roots that lie
between this cut and the one above it.

Names are exact: a name is the number of the last turn of one occurrence of the part, the least of all
equal parts, and parts are equal where the names of their halves are. So names of parts that end at
different depths differ, and forests of different cuts are never mixed up.

Scale: for conversations of up to 2^k turns there are k rounds up (names of aligned parts), k down and
k of grafting, each one grouping with partial sums before its shuffle; a round moves one row for each
part, so all rounds together move a few rows for each turn. Tables are written between rounds. A turn
that very many conversations share is one row for each map task after partial aggregation; names are
written before they are joined back to the conversations, so that the adaptive join can split a hot one. A
conversation that holds very many turns is ordered by a range sort over many tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from skylens.llm.common import ship, written

#: Ids of this many consecutive values are joined at once for the digest of a node's members.
ID_BUCKET = 1 << 16


def ordered_turns(df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, pos, role, text): turns numbered from 0 in the order of turn (null first), role and text.

    Rows are sorted by ranges, so one conversation may lie in many tasks; a row's place is its place in
    its task plus the rows of the conversation in earlier tasks.
    """
    turns = df.select(F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"),
                      *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((role_col, "role"), (text_col, "text"))])
    turns = written(turns.where("conv_id IS NOT NULL").withColumn("row", F.monotonically_increasing_id()), "turns")
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text", "row"]
    laid = written(turns.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "laid")
    sizes = laid.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("conv_id", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy(*order[1:])) - 1
    return (laid.withColumn("place", place).join(before, ["conv_id", "part"])
            .select("conv_id", (F.col("place") + F.col("before")).alias("pos"), "role", "text"))


def _symbols(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """(conv_id, at, tid, size, name): the root (at 0, name -1) and the turns of every conversation;
    equal turns have equal names, ``size`` is the length of their text, ``tid`` a number of the place."""
    rows = convs.select("conv_id", F.lit(0).cast("long").alias("at"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"))
    rows = rows.unionByName(turns.select("conv_id", (F.col("pos") + 1).cast("long").alias("at"), "role", "text"))
    rows = written(rows.withColumn("tid", F.monotonically_increasing_id()), "symbols")
    names = written(rows.where("at > 0").groupBy("role", "text").agg(F.min("tid").alias("name")), "turn-names")
    return written(rows.join(names, ["role", "text"], "left")
                   .select("conv_id", "at", "tid", F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("size"),
                           F.coalesce("name", F.lit(-1)).alias("name")), "named")


def _named_pairs(pairs: DataFrame, tag: str) -> DataFrame:
    """``pairs`` (a, b, tid, ...) with ``name``, the least tid of all rows of equal (a, b)."""
    names = written(pairs.groupBy("a", "b").agg(F.min("tid").alias("name")), f"{tag}-names")
    return written(pairs.join(names, ["a", "b"]).drop("a", "b"), tag)


def _parts(symbols: DataFrame, levels: int) -> list[DataFrame]:
    """Per level k < levels: (conv_id, part, tid, name), the names of the whole aligned parts of 2^k symbols."""
    out = [symbols.select("conv_id", F.col("at").alias("part"), "tid", "name")]
    for k in range(1, levels):
        half = out[-1]
        left = half.where("part % 2 = 0").select("conv_id", F.expr("part div 2").alias("part"), F.col("name").alias("a"))
        right = half.where("part % 2 = 1").select("conv_id", F.expr("part div 2").alias("part"), "tid", F.col("name").alias("b"))
        out.append(_named_pairs(left.join(right, ["conv_id", "part"]), f"parts{k}"))
    return out


def _nodes_of_places(symbols: DataFrame, levels: int) -> DataFrame:
    """(conv_id, at, tid, size, name) where ``name`` is the node that the first ``at`` turns lead to."""
    parts = _parts(symbols, levels)
    # forest of each piece of 2^k symbols; at first one piece, the whole sequence, in one forest
    forests = symbols.where("at = 0").select("conv_id", F.lit(0).cast("long").alias("piece"), F.lit(-1).cast("long").alias("forest"))
    lengths = written(symbols.groupBy("conv_id").agg(F.count(F.lit(1)).alias("length")), "lengths")
    for k in range(levels - 1, -1, -1):
        upper = forests.select("conv_id", (F.col("piece") * 2).alias("piece"), "forest")
        cut = (forests.join(lengths, "conv_id").where(F.col("length") > (F.col("piece") * 2 + 1) * (1 << k))
               .select("conv_id", (F.col("piece") * 2).alias("part"), F.col("forest").alias("a")))
        below = _named_pairs(cut.join(parts[k].withColumnRenamed("name", "b"), ["conv_id", "part"]), f"cut{k}")
        lower = below.select("conv_id", (F.col("part") + 1).alias("piece"), F.col("name").alias("forest"))
        forests = written(upper.unionByName(lower), f"forests{k}")
    places = symbols.withColumnRenamed("name", "b").join(forests.select("conv_id", F.col("piece").alias("at"), F.col("forest").alias("a")), ["conv_id", "at"])
    return _named_pairs(places, "places")


def _grafted(totals: DataFrame, places: DataFrame, levels: int) -> DataFrame:
    """(node, leaves, saved) of whole subtrees from ``totals`` (node, conv_id, depth, leaves, saved) of single nodes."""
    owners = totals.select("node", "conv_id", "depth")
    sums = totals.select("node", "leaves", "saved")
    for k in range(levels):
        # roots of the lower forests at the cut of every piece of 2^(k + 1), and the ancestors above it in their piece
        size, half = 1 << (k + 1), 1 << k
        roots = (owners.where(F.col("depth") % size == half).join(sums, "node")
                 .select("conv_id", F.expr(f"depth div {size}").alias("piece"), "leaves", "saved"))
        above = (places.where(F.col("at") % size < half)
                 .select("conv_id", F.expr(f"at div {size}").alias("piece"), F.col("name").alias("node")))
        grafts = above.join(roots, ["conv_id", "piece"]).select("node", "leaves", "saved")
        sums = written(sums.unionByName(grafts).groupBy("node").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")), f"grafted{k}")
    return sums


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's lists, which come in order, joined by commas."""
    node, state, nodes, digests = None, None, [], []
    for batch in batches:
        for n, ids in zip(batch.column("node").to_pylist(), batch.column("ids")):
            if n != node:
                if state is not None:
                    nodes.append(node)
                    digests.append(state.hexdigest())
                node, state = n, hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.as_py().encode())
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(digests, pa.string())], names=["node", "ends_sha256"])
        nodes, digests = [], []
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node], pa.int64()), pa.array([state.hexdigest()])], names=["node", "ends_sha256"])


def _ends(last: DataFrame, bucket: int) -> DataFrame:
    """(node, ends_sha256) of the nodes where conversations end, from ``last`` (node, conv_id).

    Ids are joined to lists bucket by bucket (at most ``bucket`` values each); nodes of several buckets
    are digested from these lists as a stream, in order and without holding them, since a SHA-256 of
    one text can't be computed in parts.
    """
    lists = (last.groupBy("node", F.floor(F.col("conv_id") / bucket).alias("bucket"))
             .agg(F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids")))
    lists = written(lists, "ids")
    counts = lists.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.first("ids").alias("ids"))
    counts = written(counts.select("node", "n", F.when(F.col("n") == 1, F.sha2("ids", 256)).alias("ends_sha256")), "lists")
    many = lists.join(counts.where("n > 1").select("node"), "node", "left_semi").select("node", "bucket", "ids")
    streamed = many.repartition("node").sortWithinPartitions("node", "bucket").mapInArrow(_digest, "node long, ends_sha256 string")
    return counts.where("n = 1").select("node", "ends_sha256").unionByName(streamed)


def prefix_trie(convs: DataFrame, turns: DataFrame, id_bucket: int = ID_BUCKET) -> DataFrame:
    """One row per node of the trie of conversations, the textless root included: conv_id (smallest
    member), depth, parent_conv_id (null for the root), n_convs, n_children, n_leaves (childless nodes of
    the subtree), saved_tokens (over the subtree, (n_convs - 1) times the code points of a node's last
    text), ends_sha256 (of the ids of the members that end there, ascending, comma-joined).

    ``convs`` (conv_id) names every conversation, ``turns`` (conv_id, pos, role, text) holds their turns,
    pos counting from 0 without gaps. Repeated and null ids of ``convs`` count once and not at all; a
    conversation without turns is a member of the root alone. Null roles and texts are empty ones; turns
    are equal if role and text are. Conversations of any length and texts of any length are compared
    whole. Other columns are ignored. Without conversations there are no rows.
    """
    ship(convs.sparkSession)
    convs = convs.select(F.col("conv_id").cast("long").alias("conv_id")).where("conv_id IS NOT NULL").distinct()
    turns = turns.select("conv_id", "pos", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    symbols = _symbols(convs, turns)
    deepest = symbols.agg(F.max("at")).first()[0] or 0
    levels = deepest.bit_length()  # so that 2^levels symbols hold the longest sequence with its root
    places = _nodes_of_places(symbols, levels)
    nodes = written(places.groupBy("name").agg(F.min("conv_id").alias("conv_id"), F.min("at").alias("depth"), F.count(F.lit(1)).alias("n_convs"),
                                               F.min("size").alias("size")).withColumnRenamed("name", "node"), "nodes")
    # the parent is one place up in the path of the smallest member
    up = places.select("conv_id", (F.col("at") + 1).alias("depth"), F.col("name").alias("parent"))
    linked = nodes.where("depth > 0").select("node", "conv_id", "depth").join(up, ["conv_id", "depth"]).select("node", "parent")
    linked = written(linked, "linked")
    children = linked.groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    parents = linked.join(nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id")), "parent").select("node", "parent_conv_id")
    nodes = written(nodes.join(children, "node", "left").join(parents, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "tree")
    single = nodes.select("node", "conv_id", "depth", (F.col("n_children") == 0).cast("long").alias("leaves"),
                          ((F.col("n_convs") - 1) * F.col("size")).alias("saved"))
    totals = _grafted(single, places, levels)
    stop = places.groupBy("conv_id").agg(F.max_by("name", "at").alias("node"))
    return (nodes.join(totals, "node").join(_ends(stop, id_bucket), "node", "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
                    F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256")))
