"""Joins and groups in which one key holds a large share of the rows.

A key is heavy if it has more than 1 / (``PER_TASK`` x partitions) of all rows, so there are fewer than ``PER_TASK`` x partitions
heavy keys at any size of the data: their rows of the small side (one per key) may be broadcast. The big side's rows of
heavy keys are joined where they lie; only the others are shuffled, and no task gets more than its share of them. This
does not rely on the run-time splitting of skewed partitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sylva.functions.columns import dealt, null_safe_join
from sylva.session import materialize

#: Parts of a task's even share that one key may fill before it counts as heavy.
PER_TASK = 4
#: Rows of the big side that a task of a split join takes: larger tables are dealt to more tasks than the session's shuffles have.
ROWS_PER_TASK = 250_000
#: Buckets of keys per key that may be heavy.
BUCKETS = 16


def key_counts(big: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key (``__n``): one partial aggregation, a row per key and map task is shuffled."""
    return big.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))


def heavy_limit(total: int, partitions: int) -> int:
    """Rows from which a key is heavy."""
    return max(1, total // (PER_TASK * partitions) + 1)


def partitions_of(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def heavy_keys(big: DataFrame, keys: Sequence[str], limit: int, buckets: int) -> DataFrame:
    """The keys with ``limit`` rows or more. Rows are counted by bucket of keys first: a heavy key lies in a bucket that reaches the
    limit, and only the keys of such buckets are counted one by one. Neither count holds a row per key of the table."""
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets))
    rows = big.select(*keys, bucket.alias("__bucket"))
    full = rows.groupBy("__bucket").agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") >= limit).select("__bucket")
    counts = key_counts(rows.join(F.broadcast(full), "__bucket", "left_semi"), keys)
    return counts.where(F.col("__n") >= limit).select(*keys)


def split_join(big: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """``big`` joined on ``keys`` with ``small``, which has one row per key. ``how`` is inner or left. Both halves read
    ``big``, which should be a stored table. A NULL key matches nothing; with ``left`` such rows stay where they lie."""
    if how not in ("inner", "left"):
        raise ValueError(f"a split join is inner or left, not {how}")
    keys = list(keys)
    known = big.dropna(subset=keys)
    total = known.count()
    tasks = -(-total // ROWS_PER_TASK)
    partitions = max(tasks, partitions_of(big))
    # fewer than PER_TASK x partitions keys reach the limit, so this table is bounded
    heavy = materialize(heavy_keys(known, keys, heavy_limit(total, partitions), BUCKETS * PER_TASK * partitions), "heavy-keys")
    tasks = partitions if tasks > 1 else None
    tagged = big.join(F.broadcast(heavy.withColumn("__heavy", F.lit(True))), keys, "left")
    stays = F.col("__heavy").isNotNull()
    if how == "left":
        for k in keys:
            stays = stays | F.col(k).isNull()
    few = F.broadcast(small.join(F.broadcast(heavy), keys, "left_semi"))
    here = tagged.where(stays).drop("__heavy").join(few, keys, how)
    rest = dealt(tagged.where(~stays).drop("__heavy"), tasks, *keys).join(dealt(small, tasks, *keys), keys, how)
    return here.unionByName(rest)


def attach_group_ids(rows: DataFrame, groups: DataFrame, cols: Sequence[str], total: int, n_groups: int, small: int) -> DataFrame:
    """``rows`` with the row_idx of their group (all ``cols`` equal, NULL = NULL). ``groups`` has a row per group with its count
    ``__n``. Up to ``small`` groups are broadcast; beyond, the heavy ones are and the rest is shuffled."""
    ids = groups.select(*cols, "row_idx")
    if n_groups <= small:
        return null_safe_join(rows, F.broadcast(ids), cols, "inner")
    is_heavy = F.col("__n") >= heavy_limit(total, partitions_of(rows))
    tagged = null_safe_join(rows, F.broadcast(groups.where(is_heavy).select(*cols, "row_idx")), cols, "left")
    rest = tagged.where(F.col("row_idx").isNull()).drop("row_idx")
    rest = null_safe_join(rest, groups.where(~is_heavy).select(*cols, "row_idx"), cols, "inner")
    return tagged.where(F.col("row_idx").isNotNull()).unionByName(rest)
