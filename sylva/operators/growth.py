"""Growth curves: spinup increments per group (B10, C4), the last row of each curve (D9),
the yearly lookup by curve and age with ages past a curve's end clamped to its last row
(C10), and the explicit extension of curves (F4) for users who want the rows."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sylva.functions.columns import clamp_to, is_small, null_safe_join, unique_rows
from sylva.operators.attributes import with_site
from sylva.sources.schema import ID_COLUMNS, require_columns, shared_classifiers

log = logging.getLogger(__name__)

INCREMENT_COLUMNS = ("merch_inc", "foliage_inc", "other_inc")
# Fixed value: years past the greatest cohort age that an explicit curve extension adds.
EXTENSION_YEARS = 250


def positive_ages(increments: DataFrame) -> DataFrame:
    """The spinup drops increments with age <= 0 (the yearly lookup keeps age 0)."""
    return increments.where(F.col("age") > 0)


def expand_increments(groups: DataFrame, increments: DataFrame) -> DataFrame:
    """C4: group INNER JOIN increments (age > 0) on gcID; a deliberate fan-out to
    (row_idx, age, three increments). No global sort: consumers join on (row_idx, age)."""
    require_columns(increments, "increments", ("gcID", "age", *INCREMENT_COLUMNS))
    g = groups.select("row_idx", "gcID")
    return g.join(positive_ages(increments), "gcID", "inner").select("row_idx", "age", *INCREMENT_COLUMNS)


def last_increment(increments: DataFrame) -> DataFrame:
    """Per curve, the row with the greatest age (gcID, max_age, three increments).
    ``max_by`` is a partial aggregation: one row per curve per map task before the shuffle."""
    return increments.groupBy("gcID").agg(
        F.max("age").alias("max_age"),
        *[F.max_by(c, "age").alias(c) for c in INCREMENT_COLUMNS])


def annual_increments(state: DataFrame, gcmeta: DataFrame, increments: DataFrame,
                      classifiers: Sequence[str] | None = None, age_col: str = "age",
                      units: DataFrame | None = None) -> DataFrame:
    """State INNER JOIN curves on admin_name, eco_id and shared classifiers, then the
    increment row at (gcID, age). A state that has spatial_unit_id alone takes admin_name and eco_id
    from ``units`` (Q17); one without any site raises, and so do two curves for one key. Ages above a curve's last age use that last row; gaps
    inside a curve and ages below its first give NULL (as the reference's lookup).

    The clamp is a join against the per-curve maximum (D9), not materialised rows. It uses
    CASE, not ``least`` (which skips NULLs, so an unknown age would hit the last row)."""
    require_columns(gcmeta, "growth curve metadata", ("gcID", "admin_name", "eco_id"))
    state = with_site(state, units)
    if classifiers is None:
        classifiers = shared_classifiers(state, gcmeta, exclude=(*ID_COLUMNS, "gcID", "sw", age_col))
    keys = list(dict.fromkeys(["admin_name", "eco_id", *classifiers]))
    meta = unique_rows(gcmeta.select(*keys, *([] if "gcID" in keys else ["gcID"])), "growth curve metadata", keys)
    s = state.drop("gcID") if "gcID" in state.columns and "gcID" not in keys else state
    # curves are a dimension: joined where the state lies, not shuffled to the curves' few keys
    s = null_safe_join(s, F.broadcast(meta) if is_small(gcmeta) else meta, keys, "inner")
    return increments_at_age(s, increments, age_col)


def increments_at_age(df: DataFrame, increments: DataFrame, age_col: str = "age") -> DataFrame:
    """The clamped (gcID, age) lookup of C10 for rows that already carry gcID. Increments that are small are broadcast."""
    hinted = F.broadcast if is_small(increments) else (lambda table: table)
    mx = last_increment(increments).select("gcID", "max_age")
    s = df.join(hinted(mx), "gcID", "left").withColumn("__lookup", clamp_to(F.col(age_col), F.col("max_age")))
    inc = increments.select("gcID", F.col("age").alias("__lookup"), *INCREMENT_COLUMNS)
    return s.join(hinted(inc), ["gcID", "__lookup"], "left").drop("__lookup", "max_age")


def extend_curves(increments: DataFrame, max_age: int | DataFrame) -> DataFrame:
    """for curves that end before ``max_age`` (greatest cohort age, a number or a
    one-column frame of ages), add rows last_age+1 .. max_age + 250 repeating the last
    row. ``sequence``/``explode`` per curve; one row per curve is joined, never a loop."""
    last = last_increment(increments)
    if isinstance(max_age, DataFrame):
        top = max_age.agg(F.max(max_age.columns[0])).first()[0]
    else:
        top = max_age
    if top is None:
        return increments
    top = int(top)
    log.info("curves that end before age %d are extended by their last increments", top)
    short = last.where(F.col("max_age") < F.lit(top))
    ext = short.select(
        "gcID", F.explode(F.sequence(F.col("max_age") + 1, F.lit(top + EXTENSION_YEARS))).alias("age"),
        *INCREMENT_COLUMNS)
    cols = increments.columns
    return increments.unionByName(ext.select(*[F.col(c).cast(dict(increments.dtypes)[c]) for c in cols]))


# ---- growth over spans of ages: prefix sums per curve instead of a row per year

def curve_sums(increments: DataFrame) -> DataFrame:
    """One row per curve: first_age, last_age, and per increment column an array of running sums over the
    ages first .. last and one of running counts of the ages that have a value (a gap has none). A
    curve's ages bound the arrays; NULL increments and missing ages add nothing to a sum, and its count tells."""
    require_columns(increments, "increments", ("gcID", "age", *INCREMENT_COLUMNS))
    rows = unique_rows(increments.select("gcID", "age", *INCREMENT_COLUMNS), "increments", ["gcID", "age"])
    by_age = Window.partitionBy("gcID").orderBy("age")
    upto = by_age.rowsBetween(Window.unboundedPreceding, 0)
    figures = {f"sum_{c}": F.sum(F.coalesce(c, F.lit(0.0))).over(upto) for c in INCREMENT_COLUMNS}
    figures |= {f"known_{c}": F.count(c).over(upto) for c in INCREMENT_COLUMNS}
    # a row holds until the curve's next age
    until = F.coalesce(F.lead("age").over(by_age) - 1, F.col("age"))
    dense = rows.select("gcID", "age", until.alias("__until"), *[x.alias(n) for n, x in figures.items()])
    dense = dense.withColumn("age", F.explode(F.sequence("age", "__until")))
    steps = F.array_sort(F.collect_list(F.struct("age", *figures)))
    out = dense.groupBy("gcID").agg(F.min("age").alias("first_age"), F.max("age").alias("last_age"), steps.alias("__steps"))
    return out.select("gcID", "first_age", "last_age", *[F.col(f"__steps.{n}").alias(n) for n in figures])


def _upto(array: F.Column, age: F.Column) -> F.Column:
    """The running figure at ``age``: 0 before the curve; behind it, its last step goes on (the flat tail of
    C10), in closed form."""
    first, last = F.col("first_age"), F.col("last_age")
    end = F.element_at(array, -1)
    step = end - F.when(F.size(array) > 1, F.element_at(array, -2)).otherwise(F.lit(0))
    inside = F.element_at(array, F.least(age, last) - first + 1)
    return F.when(age < first, F.lit(0)).when(age > last, end + (age - last) * step).otherwise(inside)


def growth_between(column: str, lowest: F.Column, highest: F.Column) -> F.Column:
    """Sum of an increment over the ages ``lowest`` .. ``highest`` of the row's curve (columns of
    ``curve_sums``): two lookups. NULL as soon as one of the ages has no increment (Q1), 0 for no age."""
    def between(array: F.Column) -> F.Column:
        return _upto(array, highest) - _upto(array, lowest - 1)
    whole = between(F.col(f"known_{column}")) == highest - lowest + 1
    # an unknown curve has no sums, and no growth is known
    return F.when(F.col("first_age").isNull(), F.lit(None).cast("double")).when(highest < lowest, F.lit(0.0)).when(whole, between(F.col(f"sum_{column}")))


def interval_growth(intervals: DataFrame, increments: DataFrame) -> DataFrame:
    """E3 -> C10 without a row per year: growth of each row of ``intervals`` (gcID, years, delay): the age is 1 in the
    year of the event, then 0 while the delay lasts, then 1, 2, ... (E3's lookup ages), so the sum is one year at age 1,
    min(years - 1, delay) at age 0 and the ages 1 .. years - 1 - delay. One join with one row per curve."""
    joined = intervals.join(curve_sums(increments), "gcID", "left")
    years, delay = F.col("years"), F.greatest(F.col("delay"), F.lit(0))
    waiting, grown = F.least(years - 1, delay), years - 1 - delay
    out = {}
    for c in INCREMENT_COLUMNS:
        at_zero = growth_between(c, F.lit(0), F.lit(0))
        out[c] = growth_between(c, F.lit(1), F.lit(1)) + F.when(waiting > 0, at_zero * waiting).otherwise(F.lit(0.0)) \
            + growth_between(c, F.lit(1), grown)
    return joined.select(*intervals.columns, *[v.alias(c) for c, v in out.items()])
