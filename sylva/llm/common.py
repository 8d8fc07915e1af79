"""Pieces shared by the text operators: word patterns, stored intermediate tables, distributed
prefix sums, size-checked broadcasts and connected components.

Intermediate tables are written below ``spark.checkpoint.dir`` (see ``sylva.session``), so a lost
executor costs a re-read, never a recomputation of what came before."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from sylva.session import materialize as stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The word of most contracts: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

#: A table of at most so many rows, each of a few dozen bytes, may be broadcast.
BROADCAST_ROWS = 1_000_000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ascii_lower(c: Column) -> Column:
    """A-Z to lower case, everything else as it is. A text of ASCII alone takes the faster way."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def word_count(c: Column) -> Column:
    """Number of words (NULL text: 0)."""
    return F.coalesce(F.regexp_count(c, F.lit(WORD)), F.lit(0)).cast("long")


def crc_of_id(c: Column) -> Column:
    """crc32 of the id as text; a NULL id counts as the empty text."""
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary"))


def small(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if its counted ``rows`` are within ``limit``; a larger table
    is joined by a shuffle."""
    return F.broadcast(df) if rows <= limit else df


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def running_totals(df: DataFrame, order: list[Column], sums: dict[str, str], name: str) -> DataFrame:
    """``df`` in a global order with running totals, without one task seeing all rows.

    Rows are dealt out by range and sorted within partitions, and that order is stored. Each
    partition's totals (one row per partition) are summed up over the earlier partitions; a window
    inside each partition adds the rest. Adds ``row_pos`` (0-based place in the global order) and,
    for each ``{column: new name}`` in ``sums``, the total up to and including the row."""
    spark = df.sparkSession
    dealt = (df.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
             .withColumn("_at", F.monotonically_increasing_id()))
    rows = (stored(dealt, name).withColumn("_part", F.shiftright("_at", 33))
            .withColumn("_in_part", F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    of_part = rows.groupBy("_part").agg(F.count("*").alias("_n"), *[F.sum(c).alias(f"_t_{c}") for c in sums])
    starts = of_part.select("_part", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_b{c}")
                                       for c in ["_n", *[f"_t_{c}" for c in sums]]])
    inside = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    # one row per partition: the broadcast is bounded by the number of partitions
    out = rows.join(F.broadcast(starts), "_part").withColumn("row_pos", F.col("_b_n") + F.col("_in_part"))
    for c, new in sums.items():
        out = out.withColumn(new, F.col(f"_b_t_{c}") + F.sum(c).over(inside))
    return out.drop("_part", "_in_part", "_at", "_b_n", *[f"_b_t_{c}" for c in sums])


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """Connected components of undirected ``edges``: one row (node, root) per node that has an
    edge, root the smallest node reachable.

    Alternates large-star and small-star steps (each an aggregate per node and a join back), so
    that every round halves the depth of the trees; each round's edges are stored. Only the number
    of edges and a checksum of them come to the driver."""
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    e = stored(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc")

    def mark(t: DataFrame) -> tuple:
        return tuple(t.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    was = mark(e)
    for _ in range(max_rounds):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # large star: neighbours above u go to the smallest neighbour
        large = (both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        # small star: u and its smaller neighbours go to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small_star = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                      .union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        e = stored(small_star, "cc")
        now = mark(e)
        if now == was:
            break
        was = now
    else:
        raise RuntimeError("connected components did not settle")
    return (e.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .union(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()))


def fresh(name: str, taken: list[str]) -> str:
    """``name``, with underscores added until no column in ``taken`` has it."""
    while name.lower() in {t.lower() for t in taken}:
        name += "_"
    return name


def chunks(column: pa.Array, chars: int = 4_000_000, rows: int = 256) -> Iterator[list[str | None]]:
    """The texts of ``column`` in runs of about ``chars`` characters, to bound what a task holds as
    Python strings at once."""
    run, size = [], 0
    for begin in range(0, len(column), rows):
        for t in column.slice(begin, rows).to_pylist():
            run.append(t)
            size += len(t or "")
            if size >= chars:
                yield run
                run, size = [], 0
    if run:
        yield run


def map_texts(docs: DataFrame, added: dict[str, str], of_texts: Callable[[list[str | None]], dict[str, Any]],
              text: str = "text", chars: int = 4_000_000) -> DataFrame:
    """``docs`` with the columns ``added`` (name: SQL type), made by ``of_texts`` from runs of about
    ``chars`` characters of a batch's texts.

    Arrow passes the other columns through untouched. A column of ``docs`` that has the name of an
    added one gives way to it."""
    gone = {a.lower() for a in added}
    kept = [c for c in docs.columns if c.lower() not in gone]
    more = StructType.fromDDL(", ".join(f"`{name}` {kind}" for name, kind in added.items()))
    schema = StructType([*docs.select(*kept).schema.fields, *more.fields])
    kinds = to_arrow_schema(more).types
    reads_itself = text not in kept
    source = docs.select(*kept, *([F.col(text)] if reads_itself else []))

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begin = 0
            for texts in chunks(batch.column(batch.schema.get_field_index(text)), chars):
                made = of_texts(texts)
                part = batch.slice(begin, len(texts))
                begin += len(texts)
                columns = [part.column(i) for i in range(len(kept))]
                columns += [pa.array(made[a], type=k) for a, k in zip(added, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, *added])

    return source.mapInArrow(mapped, schema)
