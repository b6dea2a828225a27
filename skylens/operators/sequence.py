"""Neighbours and places in an ordered sequence per key (lag, lead, row numbers), also of hot keys.

Rows are laid out once, by key; a window gives neighbours and places. Keys with very many rows are cut
into ranges of bounded row number (``operators.ranges``) and laid out by (key, range). What crosses a
cut is a summary row per range: its first and last row, found by ``min_by`` and ``max_by`` with partial
aggregation, or its number of rows. These summaries are linked by a window over a key's ranges and joined
back as a broadcast, so the rows themselves are sorted and scanned once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from skylens.operators.ranges import RANGE, ROWS, grouped, hot_ranges, known, only_hot, with_range
from skylens.session import written


def neighbours(df: DataFrame, keys: Sequence[str], order: str, carry: Sequence[str], *,
               newest_first: Sequence[str] = (), limit: int = ROWS,
               prev_prefix: str = "previous_", next_name: str | None = None) -> DataFrame:
    """Previous row's ``carry`` columns (``previous_<c>``) and the next ``order`` value, per key.

    Rows sharing one ``order`` value within a key collapse to one representative: the
    greatest by ``newest_first`` (descending).  Rows with a null key or order are dropped.

    Plan: one hash exchange, on the keys or, where a key has more than ``limit`` rows, on (keys, range).
    """
    keys = list(keys)
    rows = known(df, [*keys, order])
    hot = hot_ranges(rows, keys, order, limit=limit)
    ranged = with_range(rows, keys, order, hot)
    laid, part = grouped(ranged, keys, hot)
    if newest_first:
        same = Window.partitionBy(*part, order).orderBy(*[F.col(c).desc() for c in newest_first])
        laid = laid.withColumn("_rank", F.row_number().over(same)).where(F.col("_rank") == 1).drop("_rank")
    current = F.struct(*[F.col(c).alias(c) for c in carry])
    along = Window.partitionBy(*part).orderBy(order)
    out = laid.withColumn("_prev", F.lag(current).over(along)).withColumn("_next", F.lead(order).over(along))
    if hot is not None:
        newest = F.struct(F.col(order), *[F.col(c) for c in newest_first])
        ends = only_hot(ranged, keys, hot).groupBy(*keys, RANGE).agg(F.min(order).alias("_first"), F.max_by(current, newest).alias("_last"))
        ends = written(ends, "range-ends")
        link = Window.partitionBy(*keys).orderBy(RANGE)
        linked = written(ends.select(*keys, RANGE, F.lag("_last").over(link).alias("_before"), F.lead("_first").over(link).alias("_after")), "range-links")
        out = (out.join(F.broadcast(linked), [*keys, RANGE], "left")
               .withColumns({"_prev": F.coalesce("_prev", "_before"), "_next": F.coalesce("_next", "_after")}).drop("_before", "_after"))
    out = out.withColumns({prev_prefix + c: F.col(f"_prev.{c}") for c in carry})
    if next_name:
        out = out.withColumn(next_name, F.col("_next"))
    return out.drop("_prev", "_next", RANGE)


def row_numbers(df: DataFrame, keys: Sequence[str], order: Sequence[str], *, name: str = "row_number", total: str = "_key_rows",
                limit: int = ROWS) -> DataFrame:
    """1-based place of each row inside its key, ordered by ``order`` (a number first), and the key's rows.

    Rows with a null key or first order are dropped. Give a stored table: the histogram reads it first.
    """
    keys = list(keys)
    rows = known(df, [*keys, order[0]])
    hot = hot_ranges(rows, keys, order[0], limit=limit)
    ranged = with_range(rows, keys, order[0], hot)
    laid, part = grouped(ranged, keys, hot)
    out = laid.withColumns({name: F.row_number().over(Window.partitionBy(*part).orderBy(*order)).cast("long"),
                            total: F.count(F.lit(1)).over(Window.partitionBy(*part))})
    if hot is not None:
        sizes = written(only_hot(ranged, keys, hot).groupBy(*keys, RANGE).agg(F.count(F.lit(1)).alias("_n")), "range-sizes")
        earlier = Window.partitionBy(*keys).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
        offsets = written(sizes.select(*keys, RANGE, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"),
                                       F.sum("_n").over(Window.partitionBy(*keys)).alias("_whole")), "range-offsets")
        out = (out.join(F.broadcast(offsets), [*keys, RANGE], "left")
               .withColumns({name: F.col(name) + F.coalesce("_offset", F.lit(0)), total: F.coalesce("_whole", total)}).drop("_offset", "_whole"))
    return out.drop(RANGE)
