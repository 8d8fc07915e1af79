"""Column expressions shared by the operators. All are built-in Spark functions, so they
stay inside whole-stage codegen; none is a Python UDF."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def strict_sum(col: str | Column) -> Column:
    """Sum that is NULL as soon as one input is NULL (R ``sum`` semantics, Q1).

    ``count(*) = count(x)`` is checked in the same aggregation, so it costs no extra pass
    and keeps the partial (map-side) aggregation of ``sum``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(F.count(F.lit(1)) == F.count(c), F.sum(c))


def null_safe_join(left: DataFrame, right: DataFrame, cols: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join on ``cols`` with NULL = NULL, keeping one copy of every key column
    (the left one), like a natural join on those names. Without a key it raises: the join would be a
    cross join."""
    if not cols:
        raise ValueError("a join needs a key: the tables share no column to join on")
    r = right.select(*[F.col(c).alias(f"__r_{c}") if c in cols else F.col(c) for c in right.columns])
    cond = None
    for c in cols:
        term = F.col(c).eqNullSafe(F.col(f"__r_{c}"))
        cond = term if cond is None else cond & term
    joined = left.join(r, cond, how)
    return joined.drop(*[f"__r_{c}" for c in cols])


def unique_rows(df: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
    """``df`` (a dimension) with one row per key; a key that comes more than once raises while the job
    runs (Q6), so that no join with it fans out. An aggregation of the dimension, no job of its own."""
    rest = [c for c in df.columns if c not in keys]
    key = F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys])
    per = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), *[F.first(c).alias(c) for c in rest])
    repeated = F.raise_error(F.concat(F.lit(f"the table of {name} repeats the key ({', '.join(keys)}) = ("), key, F.lit(")")))
    # the guard sits in a filter, so that it runs whichever columns are used
    return per.where(F.when(F.col("__n") > 1, repeated.cast("boolean")).otherwise(F.lit(True))).select(*df.columns)


#: Rows up to which a counted table may be broadcast.
BROADCAST_ROWS = 20_000


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (a dimension) with a broadcast hint if it has at most ``limit`` rows, which one bounded count
    tells; a larger one is joined as the planner likes."""
    return F.broadcast(df) if is_small(df, limit) else df


def is_small(df: DataFrame, limit: int = BROADCAST_ROWS) -> bool:
    return df.limit(limit + 1).count() <= limit


def dealt(df: DataFrame, tasks: int | None, *columns: str) -> DataFrame:
    """``df`` dealt by ``columns`` to ``tasks``; None leaves it to the planner, whose run-time coalescing gives a shuffle to one
    task per core as long as it is not very large, so that a task's memory grows with the input."""
    return df if tasks is None else df.repartition(tasks, *columns)


def fill_or_add(df: DataFrame, col: str, default, dtype: str | None = None) -> DataFrame:
    """B1: replace NULL by ``default`` if the column exists, otherwise add it."""
    lit = F.lit(default)
    if dtype:
        lit = lit.cast(dtype)
    if col in df.columns:
        src = F.col(col) if not dtype else F.col(col).cast(dtype)
        return df.withColumn(col, F.coalesce(src, lit))
    return df.withColumn(col, lit)


def typed_null(dtype: str) -> Column:
    return F.lit(None).cast(dtype)


def clamp_to(col: str | Column, upper: str | Column) -> Column:
    """``col`` capped at ``upper`` without ``least`` (which skips NULLs, so an unknown
    age would silently hit the last row of a curve)."""
    c = F.col(col) if isinstance(col, str) else col
    u = F.col(upper) if isinstance(upper, str) else upper
    return F.when(c > u, u).otherwise(c)


def unique_in_order(names: Iterable[str]) -> list[str]:
    return list(dict.fromkeys(names))


def result_columns(extra: Iterable[str] = ()) -> list[str]:
    """Products, Emissions, CO2, CH4, CO, then any requested flux, duplicates removed,
    order kept."""
    return unique_in_order(["Products", "Emissions", "CO2", "CH4", "CO", *extra])


def choose_column(df: DataFrame, preferred: str, fallback: str) -> str:
    """B2: name of the column to use: ``preferred`` if present, else ``fallback``."""
    return preferred if preferred in df.columns else fallback
