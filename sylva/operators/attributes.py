"""Attaching attributes and parameters to cohorts and groups: stands (C1), growth curves
(C2), spatial units (A2, C3, C13), species and softwood flags (A3, B3, B4), defaults
(B1, B2, B8) and the regeneration-delay gate (B7)."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sylva.functions.columns import fill_or_add, null_safe_join, unique_rows
from sylva.sources.schema import ID_COLUMNS, require_columns, shared_classifiers

log = logging.getLogger(__name__)

# The species names whose ids stand for generic softwood / hardwood.
SOFTWOOD_SPECIES_NAME = "Unspecified softwood species"
HARDWOOD_SPECIES_NAME = "Unspecified hardwood species"


def cohorts_with_stands(cohorts: DataFrame, stands: DataFrame) -> DataFrame:
    """Cohort LEFT JOIN stand on pixelIndex. Both are large; they shuffle (or, when
    stored bucketed by pixelIndex, co-locate) on that key."""
    require_columns(cohorts, "cohorts", ("cohortID", "pixelIndex"))
    require_columns(stands, "stands", ("pixelIndex",))
    return cohorts.join(stands, "pixelIndex", "left").select(
        *cohorts.columns, *[c for c in stands.columns if c not in cohorts.columns])


def spatial_units(spatial_unit: DataFrame, spinup_parameter: DataFrame, admin_boundary_tr: DataFrame,
                  locale_id: int = 1) -> DataFrame:
    """A2: spatial units with their spinup parameters and admin names in one locale.
    Output: spatial_unit_id, admin_boundary_id, admin_name, eco_id, mean_annual_temperature
    (if present) and the spinup parameter columns."""
    su = spatial_unit.withColumnRenamed("id", "spatial_unit_id")
    sp = spinup_parameter.withColumnRenamed("id", "spinup_parameter_id")
    names = (admin_boundary_tr.where(F.col("locale_id") == locale_id)
             .select("admin_boundary_id", F.col("name").alias("admin_name")))
    out = su.join(sp, "spinup_parameter_id", "inner").join(names, "admin_boundary_id", "inner")
    return out.withColumnRenamed("eco_boundary_id", "eco_id")


def species_ids(species: DataFrame) -> DataFrame:
    """A3: one row (sw_species_id, hw_species_id) from the species table. A table without one of
    the two generic names raises when the row is read."""
    name, sid = F.col("species_name"), F.col("species_id")

    def of(wanted: str) -> F.Column:
        found = F.max(F.when(name == wanted, sid))
        return F.when(found.isNull(), F.raise_error(F.lit(f"the species table has no '{wanted}'")).cast("int")).otherwise(found)
    return species.agg(of(SOFTWOOD_SPECIES_NAME).alias("sw_species_id"), of(HARDWOOD_SPECIES_NAME).alias("hw_species_id"))


def softwood_flags(df: DataFrame, sw_species_id, hw_species_id, mode: str = "spinup") -> DataFrame:
    """Sw TRUE -> sw_hw 0, FALSE -> 1, NULL -> NULL; sw is dropped; species is the
    generic softwood or hardwood id. In spinup a NULL sw gives a NULL species; in the annual
    step a NULL sw_hw gives species 0. The ids are scalars or column names."""
    sw_id = F.col(sw_species_id) if isinstance(sw_species_id, str) else F.lit(sw_species_id)
    hw_id = F.col(hw_species_id) if isinstance(hw_species_id, str) else F.lit(hw_species_id)
    if "sw" in df.columns and "sw_hw" not in df.columns:
        df = df.withColumn("sw_hw", (~F.col("sw")).cast("int")).drop("sw")
    flag = F.col("sw_hw")
    if mode == "spinup":
        species = F.when(flag == 0, sw_id).when(flag == 1, hw_id)
    else:
        species = F.when(flag == 0, sw_id).when(flag.isNotNull(), hw_id).otherwise(F.lit(0))
    if mode == "spinup" or "species" not in df.columns:
        df = df.withColumn("species", species.cast("int"))
    return df


def default_sw_hw(state: DataFrame, parameters: DataFrame) -> DataFrame:
    """NULL sw_hw -> 0, but it is an error when such a group has a non-zero increment
    (NULL increments count as zero, Q15). One aggregation job guards it."""
    incs = [c for c in ("merch_inc", "foliage_inc", "other_inc") if c in parameters.columns]
    if incs:
        bad = (state.where(F.col("sw_hw").isNull()).select("row_idx")
               .join(parameters.select("row_idx", *incs), "row_idx", "inner")
               .where(" or ".join(f"coalesce({c}, 0) != 0" for c in incs)))
        if bad.limit(1).count() > 0:
            raise ValueError("a growing group has no wood type: set sw_hw for every group with an increment")
    return state.withColumn("sw_hw", F.coalesce(F.col("sw_hw"), F.lit(0)).cast("int"))


def attach_curves(groups: DataFrame, gcmeta: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """LEFT JOIN growth-curve metadata on every shared column name (NULL = NULL). Two curves for one
    key raise (Q6)."""
    require_columns(gcmeta, "growth curve metadata", ("gcID", "sw"))
    keys = list(keys) if keys is not None else shared_classifiers(groups, gcmeta, exclude=ID_COLUMNS)
    if not keys:
        raise ValueError("the growth curve metadata share no column with the cohorts")
    right = gcmeta.select(*keys, *[c for c in gcmeta.columns if c not in keys and c not in groups.columns])
    return null_safe_join(groups, unique_rows(right, "growth curve metadata", keys), keys, "left")


def with_site(state: DataFrame, units: DataFrame | None) -> DataFrame:
    """``state`` with admin_name and eco_id, which are derived from spatial_unit_id by the table of spatial
    units (A2) where they are absent (Q17). A unit that the table does not know has a NULL site."""
    pair = ["admin_name", "eco_id"]
    missing = [c for c in pair if c not in state.columns]
    if not missing:
        return state
    if "spatial_unit_id" not in state.columns:
        raise ValueError("no site: give admin_name and eco_id, or spatial_unit_id (lacking " + ", ".join(missing) + ")")
    if units is None:
        raise ValueError("a state with spatial_unit_id alone needs the table of spatial units to find its curves")
    require_columns(units, "spatial units", ("spatial_unit_id", *pair))
    sites = unique_rows(units.select("spatial_unit_id", *missing), "spatial units", ["spatial_unit_id"])
    return state.join(sites, "spatial_unit_id", "left")


def spatial_unit_keys(df: DataFrame) -> list[str]:
    if "spatial_unit_id" in df.columns:
        return ["spatial_unit_id"]
    if "admin_name" in df.columns and "eco_id" in df.columns:
        return ["admin_name", "eco_id"]
    raise ValueError("no spatial unit: give spatial_unit_id, or admin_name together with eco_id")


def attach_spatial_unit(groups: DataFrame, units: DataFrame) -> DataFrame:
    """LEFT JOIN spatial units (A2) on spatial_unit_id if present, else (admin_name,
    eco_id). Right-side columns already on the left are dropped before the join (left
    wins). Two units for one key raise (Q6)."""
    keys = spatial_unit_keys(groups)
    right = units.select(*keys, *[c for c in units.columns if c not in groups.columns and c not in keys])
    return null_safe_join(groups, unique_rows(right, "spatial units", keys), keys, "left")


def fill_spatial_unit(state: DataFrame, units: DataFrame, parameters: DataFrame | None = None):
    """Set spatial_unit_id from (admin_name, eco_id) when the column is absent, then
    add mean_annual_temperature where absent (state, and parameters by row_idx)."""
    su = units.select("spatial_unit_id", "admin_name", "eco_id", "mean_annual_temperature")
    if "spatial_unit_id" not in state.columns:
        spatial_unit_keys(state)
        state = null_safe_join(state, su.select("admin_name", "eco_id", "spatial_unit_id"),
                               ["admin_name", "eco_id"], "left")
    mat = su.select("spatial_unit_id", "mean_annual_temperature")
    if "mean_annual_temperature" not in state.columns:
        state = state.join(mat, "spatial_unit_id", "left")
    if parameters is not None and "mean_annual_temperature" not in parameters.columns:
        parameters = parameters.join(state.select("row_idx", "mean_annual_temperature"), "row_idx", "left")
    return state, parameters


def per_hectare(groups: DataFrame) -> DataFrame:
    """Spinup groups are 1 ha densities."""
    return groups.withColumn("area", F.lit(1).cast("int"))


def spinup_defaults(groups: DataFrame, age_col: str = "age", delay_col: str = "delay", default_delay: int = 0,
                    default_historical: int = 1, default_last_pass: int = 1) -> DataFrame:
    """B2 + B1 for the spinup: the spinup age column becomes ``age`` (the real age is kept
    as ``age_in``), the spinup delay column becomes ``delay``; NULL or absent delay and
    disturbance types get their defaults (logged when a whole column is missing)."""
    for name, default in ((delay_col, default_delay), ("historical_disturbance_type", default_historical),
                          ("last_pass_disturbance_type", default_last_pass)):
        if name not in groups.columns:
            log.info("no column %s: every group takes the default %s", name, default)
    if age_col != "age" and age_col in groups.columns:
        if "age" in groups.columns:
            groups = groups.withColumnRenamed("age", "age_in")
        groups = groups.withColumnRenamed(age_col, "age")
    if delay_col != "delay" and delay_col in groups.columns:
        groups = groups.withColumnRenamed(delay_col, "delay")
    groups = fill_or_add(groups, "delay", default_delay, "int")
    groups = fill_or_add(groups, "historical_disturbance_type", default_historical, "int")
    groups = fill_or_add(groups, "last_pass_disturbance_type", default_last_pass, "int")
    return groups


def regen_delay_gate(state: DataFrame, parameters: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Where time_since_last_disturbance is NULL or <= delay, state.age = 0 and the
    parameters' age and three increments = 0. Runs after the year's transfers."""
    tsld = F.col("time_since_last_disturbance")
    gate = tsld.isNull() | (tsld <= F.col("delay"))
    st = state.withColumn("__gate", gate)
    new_state = st.withColumn("age", F.when(F.col("__gate"), F.lit(0)).otherwise(F.col("age")).cast(
        dict(state.dtypes)["age"])).drop("__gate")
    flags = st.select("row_idx", "__gate")
    p = parameters.join(flags, "row_idx", "left")
    for c in ("age", "merch_inc", "foliage_inc", "other_inc"):
        if c in p.columns:
            p = p.withColumn(c, F.when(F.col("__gate"), F.lit(0)).otherwise(F.col(c)).cast(dict(parameters.dtypes)[c]))
    return new_state, p.drop("__gate").select(*parameters.columns)
