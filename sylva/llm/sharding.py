"""Sharding by minimax contiguous partition of atomic groups.

Rows with equal texts form a group that no shard border may cut. Groups stand in the order of their
texts' digests; running totals give each group the bytes up to its end. The smallest capacity
that lets the groups be packed, in order, into the shards is found by binary search (a round tries
``TRIES`` capacities at once), each capacity checked greedily: from a border, the next one is the
furthest group end within the capacity. A greedy step is one aggregate over the stored group ends,
which are range-sorted, so that its filter skips all files but a few.

Plain greedy borders would fill the first shards and starve the last. The borders are therefore cut
as near to equal shares as the capacity allows: never past what the capacity holds, never before
what the remaining shards can still take.

Sizes are UTF-8 bytes plus 1; a NULL text has no bytes, its checksum is that of the empty text, and
all NULL texts form a group of their own. Repeated rows are rows of one group. Slots count the rows
of a shard in the order of digest and id. With fewer groups than shards, some shards are empty."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import partitions, read, running_totals, stored

SHARDS = 8
#: Capacities that one round of the search tries; each round divides the range by one more.
TRIES = 31


def group_key(text: Column) -> Column:
    """Place and identity of a text's group: its digest; NULL first, under a key no digest has."""
    return F.coalesce(F.md5(text.cast("binary")), F.lit(""))


def byte_size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def next_ends(ends: DataFrame, upto: list[int], longest: int) -> list[int]:
    """For each number, the last group end (or 0) that is not above it."""
    near = ends.where((F.col("end") <= max(upto)) & (F.col("end") > min(upto) - longest))
    got = near.agg(*[F.max(F.when(F.col("end") <= t, F.col("end"))).alias(f"t{k}") for k, t in enumerate(upto)]).first()
    return [x or 0 for x in got]


def smallest_capacity(ends: DataFrame, total: int, longest: int, shards: int) -> int:
    """Smallest capacity with which greedy packing needs at most ``shards`` shards."""
    low = max(-(-total // shards), longest)  # nothing below can do
    high = -(-total // shards) + longest  # always enough: a shard but the last is filled above a fair share
    while low < high:
        step = max(1, -(-(high - low) // (TRIES + 1)))
        caps = [c for c in (low + step * k for k in range(TRIES)) if c < high]
        borders = [0] * len(caps)
        for _ in range(shards):
            borders = next_ends(ends, [b + c for b, c in zip(borders, caps, strict=True)], longest)
        fits = [c for c, b in zip(caps, borders, strict=True) if b == total]
        fails = [c for c, b in zip(caps, borders, strict=True) if b != total]
        low, high = (max(fails) + 1 if fails else low), (min(fits) if fits else high)
    return high


def borders(ends: DataFrame, total: int, longest: int, shards: int) -> list[int]:
    """End of each shard but the last, in bytes."""
    capacity = smallest_capacity(ends, total, longest, shards)
    earliest, at = [], total  # of each border, going back: the rest must fit into the shards behind it
    for _ in range(shards - 1):
        least = at - capacity
        if least > 0:
            at = ends.where((F.col("end") >= least) & (F.col("end") < least + longest)).agg(F.min("end")).first()[0]
        else:
            at = 0
        earliest.append(at)
    cuts, at = [], 0
    for k, first in enumerate(reversed(earliest)):
        ideal = at + -(-(total - at) // (shards - k))
        near = ends.where((F.col("end") > ideal - longest) & (F.col("end") < ideal + longest)).agg(
            F.max(F.when(F.col("end") <= ideal, F.col("end"))), F.min(F.when(F.col("end") >= ideal, F.col("end")))).first()
        fit = [x for x in (first, *near, at) if x is not None and max(first, at) <= x <= at + capacity]
        at = min(fit, key=lambda x: (abs(x - ideal), x))
        cuts.append(at)
    return cuts


class ShardPlan:
    """Where the shards of a table end: per shard the last group key and the rows up to it."""

    def __init__(self, rows: DataFrame, shards: int = SHARDS):
        """``rows``: stored table with key, row_pos, size and bytes (size up to the row)."""
        spark = rows.sparkSession
        self.shards = shards
        groups = rows.groupBy("key").agg(F.max("bytes").alias("end"), (F.max("row_pos") + 1).alias("rows"), F.sum("size").alias("size"))
        ends = stored(groups.repartitionByRange(partitions(spark), "end").sortWithinPartitions("end"), "group-ends")
        total, longest = ends.agg(F.max("end"), F.max("size")).first()
        cuts = borders(ends, total, longest, shards) if total else [0] * (shards - 1)
        at = {r["end"]: (r["key"], r["rows"]) for r in ends.where(F.col("end").isin(cuts)).collect()} if total else {}
        self.cuts = [at.get(c, (None, 0)) for c in cuts]

    def shard(self, key: Column) -> Column:
        """Number of borders before the group ``key``; a border at 0 is before all."""
        past = [F.lit(1) if last is None else (key > F.lit(last)).cast("int") for last, _ in self.cuts]
        return sum(past, F.lit(0)).cast("int")

    def slot(self, shard: Column, row_pos: Column) -> Column:
        firsts = F.array(F.lit(0).cast("long"), *[F.lit(n).cast("long") for _, n in self.cuts])
        return (row_pos - F.element_at(firsts, shard + 1)).cast("long")


def place(docs: DataFrame) -> DataFrame:
    """Stored doc_id, size, text_crc32, key of each row with its place in group order."""
    rows = docs.select("doc_id", byte_size(F.col("text")).alias("size"),
                       F.crc32(F.coalesce("text", F.lit("")).cast("binary")).cast("long").alias("text_crc32"),
                       group_key(F.col("text")).alias("key"), F.monotonically_increasing_id().alias("tie"))
    return stored(running_totals(rows, [F.col("key"), F.col("doc_id"), F.col("tie")], {"size": "bytes"}, "shard-rows").drop("tie"), "shard-order")


def assign_shards(docs: DataFrame, shards: int = SHARDS, column: str = "shard") -> DataFrame:
    """``docs`` with the shard of each row in ``column`` (an input column of that name gives way)."""
    plan = ShardPlan(place(docs), shards)
    return docs.withColumn(column, plan.shard(group_key(F.col("text"))))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = place(read(spark, sf_dir, "documents"))
    plan = ShardPlan(rows)
    out = rows.withColumn("shard", plan.shard(F.col("key")))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                      plan.slot(F.col("shard"), F.col("row_pos")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
