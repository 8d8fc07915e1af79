"""Cohort groups: building them (D1), counting them (D12), splitting disturbed cohorts into
new groups (C7, D2, D3), cloning and resetting group rows (C8, B5), appending (F2),
parameters from state (B6) and dropping inactive groups (C9)."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sylva.functions.columns import BROADCAST_ROWS, null_safe_join, typed_null
from sylva.operators.heavy import attach_group_ids
from sylva.operators.ids import number_groups
from sylva.session import materialize
from sylva.sources.schema import ID_COLUMNS

log = logging.getLogger(__name__)

GROUP_EXCLUDE = ("cohortID", "pixelIndex", "area")


def cohort_groups(cohort_stand: DataFrame, exclude: Sequence[str] = GROUP_EXCLUDE,
                  warn_ratio: float | None = None, small: int = BROADCAST_ROWS) -> tuple[DataFrame, DataFrame]:
    """A group is one combination of values in every column except ``exclude`` (NULL is
    a value). Groups are numbered 1..n by their first cohortID.

    Returns (key, groups): key = (cohortID, pixelIndex, row_idx) per cohort; groups = one
    row per row_idx with its attributes. The group table comes from a partial (map-side)
    aggregation, so a group holding a third of all cohorts costs one row per map task; ids
    are assigned in parallel (``number_groups``); the key is a null-safe equi-join back, in which
    the groups (or, if they are many, the heavy ones) are broadcast, so that no task gets a heavy
    group whole. The input, usually a join of two large tables, is stored once and read for both."""
    cols = [c for c in cohort_stand.columns if c not in exclude]
    if not cols:
        raise ValueError("the cohorts have no attribute columns to group by")
    cohort_stand = materialize(cohort_stand, "cohort-stands")
    groups = cohort_stand.groupBy(*cols).agg(F.min("cohortID").alias("__first"), F.count(F.lit(1)).alias("__n"))
    groups = number_groups(groups, ["__first"]).drop("__first")
    n_g, n_c = groups.agg(F.count(F.lit(1)), F.coalesce(F.sum("__n"), F.lit(0))).first()
    key_cols = [c for c in ("cohortID", "pixelIndex") if c in cohort_stand.columns]
    key = attach_group_ids(cohort_stand.select(*key_cols, *cols), groups, cols, n_c, n_g, small).select(*key_cols, "row_idx")
    groups = groups.select("row_idx", *cols)
    if warn_ratio is not None and n_c and n_g > warn_ratio * n_c:
        log.warning("cohort_groups: %d groups for %d cohorts; an extra per-stand column may split groups",
                    n_g, n_c)
    return key, groups


def group_census(key: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Live groups, greatest id, cohorts, largest group. Two partial aggregations."""
    per = key.groupBy(*by, "row_idx").agg(F.count(F.lit(1)).alias("__n"))
    return per.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_groups"),
        F.max("row_idx").alias("max_row_idx"),
        F.sum("__n").alias("n_cohorts"),
        F.max("__n").alias("max_group_cohorts"))


def disturbed_with_state(key: DataFrame, state: DataFrame, pools: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Disturbed cohorts INNER JOIN the state and pools of their group (cohort level)."""
    d = key.where(F.col("disturbance_type_id").isNotNull()).withColumnRenamed("row_idx", "row_idx_prev")
    s = _prev(state, by)
    p = _prev(pools, by)
    d = d.join(s, [c for c in s.columns if c in d.columns], "inner")
    return d.join(p, [c for c in p.columns if c in d.columns and c in ("row_idx_prev", *by)], "inner")


def _prev(table: DataFrame, by: Sequence[str]) -> DataFrame:
    return table.withColumnRenamed("row_idx", "row_idx_prev").select(
        "row_idx_prev", *[c for c in table.columns if c != "row_idx"])


def split_columns(state: DataFrame, pools: DataFrame, classifiers: Sequence[str]) -> list[str]:
    """D2 grouping columns (besides the disturbance type), in the reference order, keeping
    those that exist: spatial_unit_id, shared classifiers, age, delay, every pool."""
    have = set(state.columns) | set(pools.columns)
    cand = ["spatial_unit_id", *classifiers, "age", "delay",
            *[c for c in pools.columns if c not in ("row_idx", "year")]]
    out = []
    for c in cand:
        if c in have and c not in out and c not in ID_COLUMNS:
            out.append(c)
    return out


def group_counts(key: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by..., row_idx, disturbance_type_id, first_cohort, n) of a marked key: all that the split and
    the live groups need to know of its cohorts. One partial aggregation; store it if both are asked for."""
    return key.groupBy(*by, "row_idx", "disturbance_type_id").agg(
        F.min("cohortID").alias("first_cohort"), F.count(F.lit(1)).alias("n"))


@dataclass(frozen=True)
class Split:
    pairs: DataFrame       # (by..., row_idx_prev, disturbance_type_id) -> row_idx
    new_groups: DataFrame  # (by..., row_idx, row_idx_prev, disturbance_type)


def split_disturbed(key: DataFrame, state: DataFrame, pools: DataFrame, classifiers: Sequence[str] = (),
                    by: Sequence[str] = (), start: int | None = None, counts: DataFrame | None = None) -> Split:
    """D2 + D3: new groups for disturbed cohorts.

    Cohorts fall into one new group when they share the type and every grouping column
    (``split_columns``). All of those except the type are functions of the previous group,
    so the work runs on the distinct (row_idx_prev, type) pairs -- a partial aggregation of
    the disturbed key rows -- instead of on cohorts: one huge fire is one pair per group.
    New ids follow the first cohortID of each new group, after ``start`` (default: the
    greatest live row_idx). The representative (D3) is the previous group of the first
    cohort. ``counts`` are the ``group_counts`` of the key, if they are stored."""
    by = list(by)
    pairs = (group_counts(key, by) if counts is None else counts).where(F.col("disturbance_type_id").isNotNull()).select(
        *by, F.col("row_idx").alias("row_idx_prev"), "disturbance_type_id", F.col("first_cohort").alias("__first"))
    cols = split_columns(state, pools, classifiers)
    s = _prev(state, by).select("row_idx_prev", *[c for c in by if c in state.columns],
                                *[c for c in cols if c in state.columns])
    p = _prev(pools, by).select("row_idx_prev", *[c for c in by if c in pools.columns],
                                *[c for c in cols if c in pools.columns and c not in state.columns])
    attrs = (pairs.join(s, ["row_idx_prev", *[c for c in by if c in state.columns]], "inner")
             .join(p, ["row_idx_prev", *[c for c in by if c in pools.columns]], "inner"))
    # one row per (previous group, type): small, and read twice below (grouping and the
    # pair -> new id mapping), so it is written once instead of recomputing the key
    attrs = materialize(attrs, "split-pairs")
    gkeys = ["disturbance_type_id", *cols]
    new = attrs.groupBy(*by, *gkeys).agg(
        F.min("__first").alias("__first"),
        F.min_by("row_idx_prev", "__first").alias("__rep"))
    by_s = [c for c in by if c in state.columns]
    if start is None and by_s:
        # a panel of states: ids continue after each year's own greatest id
        offs = state.groupBy(*by_s).agg(F.max("row_idx").alias("__start"))
        new = new.join(offs, by_s, "left").withColumn("__start", F.coalesce(F.col("__start"), F.lit(0)))
        new = number_groups(new, ["__first"], start="__start", by=by).drop("__start")
    else:
        if start is None:
            start = state.agg(F.max("row_idx")).first()[0] or 0
        new = number_groups(new, ["__first"], start=int(start), by=by)
    mapping = null_safe_join(attrs.select(*by, "row_idx_prev", *gkeys),
                             new.select(*by, *gkeys, "row_idx"), [*by, *gkeys], "inner")
    pair_ids = mapping.select(*by, "row_idx_prev", "disturbance_type_id", "row_idx")
    new_groups = new.select(*by, "row_idx", F.col("__rep").alias("row_idx_prev"),
                            F.col("disturbance_type_id").alias("disturbance_type"))
    return Split(pairs=pair_ids, new_groups=new_groups)


def apply_split_to_key(key: DataFrame, split: Split, by: Sequence[str] = ()) -> DataFrame:
    """Key update: row_idx_prev = row_idx; disturbed cohorts take their new row_idx.

    Only the disturbed rows join the (small) pair table; all others pass through without a
    shuffle. ``key`` should be a stored table, since both halves read it."""
    by = list(by)
    p = split.pairs.withColumnRenamed("row_idx", "__new")
    columns = [c for c in key.columns if c != "row_idx_prev"]
    k = key.select(*columns).withColumn("row_idx_prev", F.col("row_idx"))
    hit = k.where(F.col("disturbance_type_id").isNotNull()).join(p, [*by, "row_idx_prev", "disturbance_type_id"], "left")
    hit = hit.withColumn("row_idx", F.coalesce(F.col("__new"), F.col("row_idx"))).select(*columns, "row_idx_prev")
    return k.where(F.col("disturbance_type_id").isNull()).unionByName(hit)


def live_groups(marked: DataFrame, split: Split, by: Sequence[str] = (), counts: DataFrame | None = None) -> DataFrame:
    """(by..., row_idx) of the groups that hold a cohort after the split: those with an undisturbed
    cohort or one whose pair got no new group, and the new groups. One partial aggregation of
    the marked key (or its stored ``counts``); the updated key is not needed."""
    by = list(by)
    per = group_counts(marked, by) if counts is None else counts
    pairs = split.pairs.select(*by, F.col("row_idx_prev").alias("row_idx"), "disturbance_type_id")
    kept = per.join(pairs, [*by, "row_idx", "disturbance_type_id"], "left_anti").select(*by, "row_idx")
    return kept.union(split.new_groups.select(*by, "row_idx")).distinct()


def clone_group_rows(new_groups: DataFrame, table: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """For each new group, the row of its representative previous group (LEFT JOIN)."""
    by_t = [c for c in by if c in table.columns]
    by_n = [c for c in by if c in new_groups.columns]
    src = table.withColumnRenamed("row_idx", "row_idx_prev")
    ng = new_groups.select(*by_n, "row_idx", "row_idx_prev")
    out = ng.join(src, [*by_t, "row_idx_prev"], "left")
    return out.select(*by_n, *[c for c in table.columns if c not in by_n])


STATE_RESET = {"age": ("int", 1), "time_since_last_disturbance": ("double", None),
               "time_since_land_use_change": ("double", None), "last_disturbance_type": ("double", None)}


def reset_disturbed_state(state_rows: DataFrame) -> DataFrame:
    """B5 on state: age 1, time since disturbance / land-use change and last type unknown."""
    out = state_rows
    for c, (t, v) in STATE_RESET.items():
        out = out.withColumn(c, typed_null(t) if v is None else F.lit(v).cast(
            dict(state_rows.dtypes).get(c, t)))
    return out


def reset_disturbed_pools(pool_rows: DataFrame) -> DataFrame:
    """B5 on pools: Input = 1."""
    t = dict(pool_rows.dtypes).get("Input", "double")
    return pool_rows.withColumn("Input", F.lit(1).cast(t))


def union_fill(old: DataFrame, new: DataFrame) -> DataFrame:
    """append rows; columns missing on either side become NULL. The new rows, few beside the
    old ones and used by several tables, are stored first: a union of two inputs that were
    hash-partitioned alike could otherwise be zipped partition by partition."""
    return old.unionByName(materialize(new, "new-rows"), allowMissingColumns=True)


def parameters_from_state(parameters: DataFrame, state: DataFrame, new_groups: DataFrame | None = None,
                          by: Sequence[str] = ()) -> DataFrame:
    """disturbance_type = 0 for existing groups, the event's type for new ones; age and
    mean_annual_temperature copied from state by row_idx (a join, never by position)."""
    by = list(by)
    p = parameters.withColumn("disturbance_type", F.lit(0).cast("int"))
    if new_groups is not None:
        p = union_fill(p, new_groups.select(*[c for c in by if c in new_groups.columns], "row_idx",
                                            F.col("disturbance_type").cast("int")))
    copy = [c for c in ("age", "mean_annual_temperature") if c in state.columns]
    p = p.drop(*copy)
    by_s = [c for c in by if c in state.columns and c in p.columns]
    return p.join(state.select(*by_s, "row_idx", *copy), [*by_s, "row_idx"], "left")


def drop_inactive(table: DataFrame, key: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Keep rows whose row_idx is still in the key (LEFT SEMI); ``key`` is the updated key or
    the table of ``live_groups``. Either way the ids come from a partial aggregation."""
    by_k = [c for c in by if c in table.columns and c in key.columns]
    live = key.select(*by_k, "row_idx").distinct()
    return table.join(live, [*by_k, "row_idx"], "left_semi")
