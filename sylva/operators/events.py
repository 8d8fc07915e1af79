"""Disturbance events: year filter (B9), typing (C5), contested stands (D10), one winner
per stand and year (E1), marking cohorts (C6) and the stand age panel (E3).

Every operator takes ``by`` (default ``("year",)``), so one job resolves a whole panel of
years; the annual loop passes a single year's events and the same code runs."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sylva.functions.columns import broadcast_if_small
from sylva.sources.schema import require_columns

log = logging.getLogger(__name__)

EVENT_COLUMNS = ("pixelIndex", "year", "eventID")
META_COLUMNS = ("eventID", "disturbance_type_id")


def year_filter(events: DataFrame, year: int) -> DataFrame:
    """The events of one year. The column is cast to int (never compared as text:
    a double year prints as "2000.0")."""
    require_columns(events, "events", EVENT_COLUMNS)
    return events.where(F.col("year").cast("int") == F.lit(int(year)))


def type_events(events: DataFrame, meta: DataFrame) -> DataFrame:
    """Events LEFT JOIN distinct (eventID, disturbance_type_id[, priority]). An unknown
    eventID keeps a NULL type and still competes in E1.

    The planner broadcasts the table of event kinds as long as it is small."""
    require_columns(events, "events", EVENT_COLUMNS)
    require_columns(meta, "event metadata", META_COLUMNS)
    keep = [c for c in ("eventID", "disturbance_type_id", "priority") if c in meta.columns]
    m = meta.select(*keep).distinct()
    return events.join(m, "eventID", "left")


def contested_stands(typed: DataFrame, by: Sequence[str] = ("year",)) -> DataFrame:
    """Stands with more than one event in a year (pixelIndex, year, n_events)."""
    return (typed.groupBy("pixelIndex", *by).agg(F.count(F.lit(1)).alias("n_events"))
            .where(F.col("n_events") > 1))


def _check_no_contest(typed: DataFrame, by: Sequence[str]) -> None:
    # Q3: without a priority column, two events in one stand (even equal rows) are an error
    if contested_stands(typed, by).limit(1).count() > 0:
        raise ValueError(
            "Two or more events hit one stand in the same year; give the event metadata a priority column to rank them.")


def resolve_events(typed: DataFrame, by: Sequence[str] = ("year",), check: bool = True,
                   keep: Sequence[str] = ()) -> DataFrame:
    """One event per stand and year. Lowest priority wins, a NULL priority first (Q2);
    ties go to the lowest eventID, then the lowest type. ``row_number() = 1`` lets Catalyst
    plan a WindowGroupLimit, which keeps one row per key *before* the shuffle as well, so a
    stand with a huge number of events does not land whole on one task. ``keep`` names more columns of
    the winning events."""
    by = list(by)
    if "priority" not in typed.columns:
        if check:
            _check_no_contest(typed, by)
        typed = typed.withColumn("priority", F.lit(None).cast("int"))
    w = Window.partitionBy("pixelIndex", *by).orderBy(
        F.col("priority").asc_nulls_first(), F.col("eventID").asc_nulls_first(),
        F.col("disturbance_type_id").asc_nulls_first())
    return (typed.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1)
            .select("pixelIndex", *by, "eventID", "disturbance_type_id", *keep))


def mark_cohorts(key: DataFrame, winners: DataFrame, by: Sequence[str] = ("year",)) -> DataFrame:
    """Every cohort takes its stand's winning type (NULL if none). ``winners`` has at most
    one row per (pixelIndex, by), so this LEFT JOIN never fans out."""
    by = [c for c in by if c in key.columns]
    w = winners.select("pixelIndex", *by, "disturbance_type_id")
    k = key.drop("disturbance_type_id") if "disturbance_type_id" in key.columns else key
    return k.join(w, ["pixelIndex", *by], "left")


def stand_histories(events: DataFrame, meta: DataFrame) -> DataFrame:
    """C5 -> E1 -> one row per stand: (pixelIndex, types), the winning type of each of its years as a map. On
    events clustered by stand neither the ranking nor the grouping shuffles. The map holds at most one entry a year; a
    winner without a type has no entry, as its cohorts count as undisturbed, and an event without a year is never read."""
    winners = resolve_events(type_events(events, broadcast_if_small(meta)))
    known = winners.where(F.col("year").isNotNull() & F.col("disturbance_type_id").isNotNull())
    entries = F.collect_list(F.struct("year", "disturbance_type_id"))
    return known.groupBy("pixelIndex").agg(F.map_from_entries(entries).alias("types"))


def mark_by_history(key: DataFrame, events: DataFrame, meta: DataFrame) -> DataFrame:
    """C6 on clustered tables, for a key with a year: equal to ``mark_cohorts``, joined on the stand alone so that the layout of
    both sides serves; the year is looked up in the stand's map."""
    k = key.drop("disturbance_type_id") if "disturbance_type_id" in key.columns else key
    marked = k.join(stand_histories(events, meta), "pixelIndex", "left")
    year = F.col("year").cast(events.schema["year"].dataType)
    kind = F.when(year.isNotNull(), F.element_at("types", year))
    return marked.select(*k.columns, kind.alias("disturbance_type_id"))


def prep_disturbances(key: DataFrame, events: DataFrame | None, meta: DataFrame | None,
                      year: int | None = None, by: Sequence[str] = ()) -> DataFrame:
    """B9 -> C5 -> D10 -> E1 -> C6 for one year (``year``) or a panel (``by=("year",)``)."""
    if events is None:
        log.info("no events: no cohort is disturbed")
        return key.withColumn("disturbance_type_id", F.lit(None).cast("int"))
    ev = year_filter(events, year) if year is not None else events
    if meta is None:
        raise ValueError("events need their metadata table")
    winners = resolve_events(type_events(ev, meta), by=by)
    return mark_cohorts(key, winners, by=by)


def age_panel(winners: DataFrame, end_year: int, cohorts: DataFrame | None = None,
              delay_col: str = "delay", default_delay: int = 0) -> DataFrame:
    """Stand age for every year from each stand's first event in the horizon to
    ``end_year``, without a year loop.

    For stand-years after an event: t = year - last_event_year + 1; age at year end =
    greatest(0, t - delay); the age used for the growth lookup is 1 in an event year and the
    previous year-end age otherwise. Rows are generated per stand from its first event only,
    so the panel grows with the events, not with stands x years. A stand's panel is at most
    the horizon long, so the per-stand window is bounded.

    ``winners`` is E1 output; rows with a NULL type mean "undisturbed" and are ignored.
    With ``cohorts`` (cohortID, pixelIndex, delay column) the result is per cohort."""
    ev = (winners.where(F.col("disturbance_type_id").isNotNull())
          .select("pixelIndex", F.col("year").cast("int").alias("event_year")).distinct()
          .where(F.col("event_year") <= F.lit(int(end_year))))
    first = ev.groupBy("pixelIndex").agg(F.min("event_year").alias("first_year"))
    panel = first.select("pixelIndex", F.explode(F.sequence(F.col("first_year"), F.lit(int(end_year)))).alias("year"))
    panel = panel.join(ev.withColumnRenamed("event_year", "year").withColumn("__hit", F.col("year")),
                       ["pixelIndex", "year"], "left")
    w = Window.partitionBy("pixelIndex").orderBy("year").rowsBetween(Window.unboundedPreceding, 0)
    panel = panel.withColumn("last_event_year", F.max("__hit").over(w)).drop("__hit")
    panel = panel.withColumn("t", F.col("year") - F.col("last_event_year") + 1)
    if cohorts is not None:
        d = F.coalesce(F.col(delay_col).cast("int"), F.lit(int(default_delay))) if delay_col in cohorts.columns \
            else F.lit(int(default_delay))
        c = cohorts.select("cohortID", "pixelIndex", d.alias("delay"))
        out = panel.join(c, "pixelIndex", "inner")
    else:
        out = panel.withColumn("delay", F.lit(int(default_delay)))
    t, d = F.col("t"), F.col("delay")
    age = F.when(t - d > 0, t - d).otherwise(F.lit(0))
    prev = F.when(t - 1 - d > 0, t - 1 - d).otherwise(F.lit(0))
    out = out.withColumn("age", age.cast("int")).withColumn(
        "lookup_age", F.when(t == 1, F.lit(1)).otherwise(prev).cast("int"))
    cols = (["cohortID"] if cohorts is not None else []) + ["pixelIndex", "year", "last_event_year", "delay",
                                                            "lookup_age", "age"]
    return out.select(*cols)


def event_intervals(winners: DataFrame, end_year: int, cohorts: DataFrame, delay_col: str = "delay",
                    default_delay: int = 0) -> DataFrame:
    """The same horizon as ``age_panel``, one row per cohort and event instead of one per cohort and year: the
    ``years`` from an event to the year before the stand's next one, or to ``end_year``. The columns of
    ``cohorts`` stay; its delay becomes ``delay``. ``age`` is the age at the end of the interval."""
    ev = (winners.where(F.col("disturbance_type_id").isNotNull())
          .select("pixelIndex", F.col("year").cast("int").alias("event_year")).distinct()
          .where(F.col("event_year") <= F.lit(int(end_year))))
    following = F.lead("event_year").over(Window.partitionBy("pixelIndex").orderBy("event_year"))
    ev = ev.withColumn("years", (F.coalesce(following, F.lit(int(end_year) + 1)) - F.col("event_year")).cast("int"))
    d = F.coalesce(F.col(delay_col).cast("int"), F.lit(int(default_delay))) if delay_col in cohorts.columns else F.lit(int(default_delay))
    kept = [c for c in cohorts.columns if c not in (delay_col, "delay", "event_year", "years")]
    out = ev.join(cohorts.select(*kept, d.alias("delay")), "pixelIndex", "inner")
    grown = F.col("years") - F.col("delay")
    return out.select(*kept, "event_year", "years", "delay", F.when(grown > 0, grown).otherwise(F.lit(0)).cast("int").alias("age_at_end"))
