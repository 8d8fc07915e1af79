"""C14: rows that would turn into NULLs, disappear or fan out without a word. Every check is an
anti join or a grouped count, and all of them run in one job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sylva.sources.schema import ID_COLUMNS, shared_classifiers


def _count(name: str, df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("check"), "n")


def _repeated(name: str, df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows beyond the first of each key (a join with them would fan out)."""
    per = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
    return per.agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).cast("long").alias("n")).select(F.lit(name).alias("check"), "n")


def orphans(stands: DataFrame, cohorts: DataFrame | None = None, events: DataFrame | None = None,
            meta: DataFrame | None = None, gcmeta: DataFrame | None = None, units: DataFrame | None = None,
            group_units: DataFrame | None = None) -> DataFrame:
    """(check, n) rows: cohorts without stand, stands without cohort, events without stand, events
    without metadata, cohorts without growth curve, groups without spatial unit, and repeated
    keys of stands, event metadata, curve metadata and spatial units."""
    parts = [_repeated("repeated_stands", stands, ["pixelIndex"])]
    if meta is not None:
        parts.append(_repeated("repeated_event_meta", meta.distinct(), ["eventID"]))
    if gcmeta is not None:
        parts.append(_repeated("repeated_curves", gcmeta, [c for c in gcmeta.columns if c not in ("gcID", "sw")]))
    if units is not None:
        parts.append(_repeated("repeated_units", units, ["spatial_unit_id"]))
        if group_units is not None:
            parts.append(_count("groups_without_unit", group_units.join(units, "spatial_unit_id", "left_anti")))
    if cohorts is not None:
        parts.append(_count("cohorts_without_stand", cohorts.join(stands, "pixelIndex", "left_anti")))
        parts.append(_count("stands_without_cohort", stands.join(cohorts, "pixelIndex", "left_anti")))
    if events is not None:
        parts.append(_count("events_without_stand", events.join(stands, "pixelIndex", "left_anti")))
        if meta is not None:
            parts.append(_count("events_without_meta", events.join(meta.select("eventID"), "eventID", "left_anti")))
    if cohorts is not None and gcmeta is not None:
        cs = cohorts.join(stands.select("pixelIndex", *[c for c in stands.columns if c not in cohorts.columns]),
                          "pixelIndex", "left")
        keys = shared_classifiers(cs, gcmeta, exclude=ID_COLUMNS)
        cond = None
        for k in keys:
            t = cs[k].eqNullSafe(gcmeta[k])
            cond = t if cond is None else cond & t
        parts.append(_count("cohorts_without_curve", cs.join(gcmeta, cond, "left_anti")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
