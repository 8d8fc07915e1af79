"""Dense ids 1..n in a given order, computed in parallel.

A global ``row_number()`` window would run on one task. Instead the table is range-
partitioned and sorted (``orderBy``), every row gets its partition and position from
``monotonically_increasing_id``, the tagged table is written once to the shared folder
(range boundaries are sampled, so it must not be computed twice), and a per-partition
count table -- one row per (partition, by-value), tiny -- gives each partition its offset."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sylva.session import materialize

_POS_BITS = 33


def number_groups(groups: DataFrame, order_cols: Sequence[str], start: int | str = 0,
                  by: Sequence[str] = (), id_col: str = "row_idx") -> DataFrame:
    """Add ``id_col`` = start + 1, start + 2, ... following ``order_cols`` (which should be
    unique within each ``by`` value, e.g. the group's first cohortID). With ``by``, ids
    restart for every ``by`` value. ``start`` may be a column name holding a per-row offset
    (constant within a ``by`` value)."""
    order_cols = list(order_cols)
    by = list(by)
    tagged = (
        groups.orderBy(*[F.col(c).asc_nulls_first() for c in by + order_cols])
        .withColumn("__tag", F.monotonically_increasing_id())
        .withColumn("__pid", F.shiftright(F.col("__tag"), _POS_BITS))
        .withColumn("__pos", F.col("__tag").bitwiseAND(F.lit((1 << _POS_BITS) - 1)))
        .drop("__tag")
    )
    tagged = materialize(tagged, "group-ids")
    counts = tagged.groupBy(*by, "__pid").agg(F.count(F.lit(1)).alias("__n"), F.min("__pos").alias("__p0"))
    w = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    if by:
        w = Window.partitionBy(*by).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("__off", F.coalesce(F.sum("__n").over(w), F.lit(0))).drop("__n")
    # one row per (partition, by-value): bounded by partitions + by-values, safe to broadcast
    out = tagged.join(F.broadcast(offsets), [*by, "__pid"], "inner")
    base = F.col(start) if isinstance(start, str) else F.lit(start)
    rank = F.col("__off") + (F.col("__pos") - F.col("__p0")) + F.lit(1)
    return out.withColumn(id_col, (base + rank).cast("long")).drop("__pid", "__pos", "__p0", "__off")
