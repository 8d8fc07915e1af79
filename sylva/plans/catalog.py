"""Registered queries: every operator of the inventory run on the driver tables mapped by
``sylva.sources.fixtures`` (whole tables, every year at once as a panel). Each entry takes
(spark, sf_dir) and returns a DataFrame whose columns match ``sylva.plans.oracle``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sylva.functions.columns import choose_column, fill_or_add, is_small
from sylva.operators import attributes as at
from sylva.operators import events as ev
from sylva.operators import groups as gr
from sylva.operators import growth as gw
from sylva.operators import quality as qa
from sylva.operators import reports as rp
from sylva.operators import transfers as tr
from sylva.operators.watch import Watch
from sylva.plans import annual as an
from sylva.session import materialize, shared_dir
from sylva.sources import snapshots as sn
from sylva.sources.clustered import clustered
from sylva.sources.delimited import SCHEMAS, read_delimited
from sylva.sources.fixtures import GROUP_KINDS, Fixtures
from sylva.sources.schema import CarbonTables, shared_classifiers
from sylva.streaming.events import ingest_events
from sylva.streaming.winners import merge_events, read_winners, start_winner_updates

Y = ("year",)
DIGITS = 9
#: Last year of the event horizon (the event years are days of a month).
HORIZON = 30


# ---- shared building blocks -------------------------------------------------------------

def _c1(fx: Fixtures) -> DataFrame:
    return at.cohorts_with_stands(fx.cohort, fx.stand)


def _d1(fx: Fixtures):
    return gr.cohort_groups(_c1(fx))


def _spu(fx: Fixtures) -> DataFrame:
    return at.spatial_units(fx.spatial_unit, fx.spinup_parameter, fx.admin_tr)


def _winners(fx: Fixtures) -> DataFrame:
    return ev.resolve_events(ev.type_events(fx.events, fx.distmeta), by=Y)


def _marked(fx: Fixtures) -> DataFrame:
    return ev.mark_cohorts(fx.key, _winners(fx), by=Y)


def _classifiers(fx: Fixtures) -> list[str]:
    return shared_classifiers(fx.cohort, fx.gcmeta, exclude=("cohortID", "pixelIndex", "gcID", "sw", "age"))


def _split(fx: Fixtures):
    marked = materialize(_marked(fx), "marked-key")
    return marked, gr.split_disturbed(marked, fx.state, fx.pools, classifiers=_classifiers(fx), by=Y)


def _areas(fx: Fixtures) -> DataFrame:
    return rp.group_area(fx.key, fx.stand, Y)


def _group_units(fx: Fixtures) -> DataFrame:
    """A spatial unit per group; every thirteenth group has none."""
    n = fx.spatial_unit.count()
    unit = F.when(F.col("row_idx") % 13 != 0, (F.col("row_idx") % n + 1).cast("int"))
    return fx.state.select("row_idx", unit.alias("spatial_unit_id"))


def _group_types(df: DataFrame) -> DataFrame:
    return df.withColumn("disturbance_type_id", (F.col("row_idx") % 5).cast("int"))


def _state_increments(fx: Fixtures) -> DataFrame:
    increments = gw.increments_at_age(fx.state.select("row_idx", "gcID", "age"), fx.increments)
    return fx.dealt(increments.select("row_idx", *gw.INCREMENT_COLUMNS), "row_idx")


def _units(fx: Fixtures) -> DataFrame:
    return fx.spatial_unit.select(F.col("id").alias("spatial_unit_id"), "mean_annual_temperature")


def _r(col: str) -> F.Column:
    return F.round(F.col(col), DIGITS).alias(col)


# ---- queries ------------------------------------------------------------------------------

def q_spatial_units(spark, d):
    return _spu(Fixtures(spark, d)).select("spatial_unit_id", "admin_name", "eco_id", "mean_annual_temperature",
                                           "return_interval")


def q_read_snapshots(spark, d):
    """Years 1, 3, 5, 7 and a spinup year 0 that has fewer pools."""
    fx = Fixtures(spark, d)
    root = sn.open_store(spark, shared_dir(spark, "snapshots"))
    sn.write_panel(fx.pools, root, "pools")
    spinup = fx.pools.where("year = 1").drop("Products", "year")
    sn.write_snapshot({"pools": spinup}, root, 0, spinup=True)
    years = sn.save_years(1, 2, 7, spinup=True)
    return sn.read_snapshots(spark, root, "pools", years).select("year", "row_idx", "Merch", "Products")


def q_write_snapshot(spark, d):
    """The tables and years that each set of save options leaves in a store."""
    fx = Fixtures(spark, d)
    tables = {"key": fx.key, "parameters": fx.key.select("year", "row_idx").distinct(), "pools": fx.pools, "flux": fx.flux}
    out = None
    for option, kw in (("default", {}), ("save_all", {"save_all": True})):
        root = sn.open_store(spark, shared_dir(spark, "store"))
        for name in sn.write_years(tables, root, 2, 3, 7, **kw):
            rows = sn.read_snapshots(spark, root, name).groupBy("year").agg(F.count("*").alias("n")).select(
                F.lit(option).alias("option"), F.lit(name).alias("name"), "year", "n")
            out = rows if out is None else out.unionByName(rows)
    return out


def q_append_year(spark, d):
    """each year's totals added to the results one by one, one of them twice, read back."""
    years = (*range(1, 8), 2)
    fx = Fixtures(spark, d)
    root = sn.open_store(spark, shared_dir(spark, "results"))
    totals = materialize(rp.products_stock(fx.pools, _areas(fx), Y), "totals")
    for y in years:
        sn.append_year(totals.where(F.col("year") == y), root, "yearly")
    return sn.read_snapshots(spark, root, "yearly").select("year", "products_stock")


def q_year_filter(spark, d):
    events = Fixtures(spark, d).events.withColumn("year", F.col("year").cast("double"))
    return ev.year_filter(events, 12).select("pixelIndex", F.col("year").cast("int").alias("year"), "eventID")


def q_spinup_parameters(spark, d):
    """B8 + B2 + B1 on cohort groups with their own spinup age column and no delay column."""
    fx = Fixtures(spark, d)
    _, groups = _d1(fx)
    groups = at.per_hectare(groups).withColumn("ageSpinup", F.col("age") + 100)
    out = at.spinup_defaults(groups, age_col=choose_column(groups, "ageSpinup", "age"),
                             delay_col=choose_column(groups, "delaySpinup", "delay"), default_delay=3)
    return out.select("row_idx", "area", "age", "age_in", "delay", "historical_disturbance_type", "last_pass_disturbance_type")


def _wood(fx: Fixtures) -> DataFrame:
    """Wood type by group: 0, 1 or unknown."""
    return fx.state.withColumn("sw_hw", F.when(F.col("row_idx") % 3 < 2, (F.col("row_idx") % 3).cast("int")))


def q_default_sw_hw(spark, d):
    fx = Fixtures(spark, d)
    state = _wood(fx)
    still = F.when(F.col("row_idx") % 3 < 2, 1.0).otherwise(F.when(F.col("row_idx") % 2 == 0, 0.0))
    params = fx.state.select("row_idx", still.alias("merch_inc"))
    return at.default_sw_hw(state, params).select("row_idx", "sw_hw")


def q_softwood_flags_step(spark, d):
    fx = Fixtures(spark, d)
    ids = at.species_ids(fx.species).first()
    out = at.softwood_flags(_wood(fx), ids["sw_species_id"], ids["hw_species_id"], mode="step")
    return out.select("row_idx", "sw_hw", F.col("species").alias("species_id"))


def q_fill_spatial_unit_parameters(spark, d):
    """C13 where the unit ids are there already, with the parameters filled by row_idx."""
    fx = Fixtures(spark, d)
    state, params = at.fill_spatial_unit(_group_units(fx), _spu(fx), fx.state.select("row_idx", "age"))
    return params.join(state.select("row_idx", "spatial_unit_id"), "row_idx", "inner")


def q_clone_flux(spark, d):
    fx = Fixtures(spark, d)
    _, split = _split(fx)
    return gr.clone_group_rows(split.new_groups, fx.flux, Y)


def q_emissions_products_extra(spark, d):
    """Two more flux columns, one of them named twice, in the order asked for."""
    fx = Fixtures(spark, d)
    extra = (Fixtures.EMISSION_FLUX[3], Fixtures.NPP_FLUX[0], Fixtures.EMISSION_FLUX[3], "CO2")
    return rp.emissions_products(fx.key, fx.stand, fx.flux, fx.pools, extra_columns=extra)


def _prepared(fx: Fixtures) -> an.PreparedGroups:
    state = materialize(fx.state.join(_group_sites(fx), "row_idx", "left").drop("gcID"), "state")  # read by every table
    inputs = an.Inputs(stands=fx.stand, cohorts=fx.cohort, gcmeta=fx.gcmeta, increments=fx.increments)
    t = CarbonTables(key=_marked(fx), parameters=state.select("row_idx"), state=state, pools=fx.pools, flux=fx.flux)
    return an.prepare_groups(t, inputs, ["species"], Y)


def _group_sites(fx: Fixtures) -> DataFrame:
    """admin_name, eco_id and species of a group: those of the curve that its number names."""
    curves = fx.gcmeta.withColumn("k", F.row_number().over(Window.orderBy("gcID")) - 1)  # a dimension
    n = fx.gcmeta.count()
    return fx.state.select("row_idx").withColumn("k", F.col("row_idx") % GROUP_KINDS % n).join(
        F.broadcast(curves) if is_small(fx.gcmeta) else curves, "k", "left").select("row_idx", "admin_name", "eco_id", "species")


def q_prepare_groups_key(spark, d):
    return _prepared(Fixtures(spark, d)).key.select("year", "cohortID", "row_idx_prev", "row_idx")


def q_prepare_groups_state(spark, d):
    return _prepared(Fixtures(spark, d)).state.select("year", "row_idx", "age", "delay", "admin_name", "eco_id", "species")


def q_prepare_groups_pools(spark, d):
    return _prepared(Fixtures(spark, d)).pools


def q_prepare_groups_flux(spark, d):
    return _prepared(Fixtures(spark, d)).flux


def q_prepare_groups_parameters(spark, d):
    return _prepared(Fixtures(spark, d)).parameters.select("year", "row_idx", "disturbance_type", "age", *gw.INCREMENT_COLUMNS)


def q_fill_or_add(spark, d):
    s = Fixtures(spark, d).stand
    s = fill_or_add(s, "historical_disturbance_type", 1, "int")
    return fill_or_add(s, "last_pass_disturbance_type", 1, "int")


def q_softwood_flags(spark, d):
    fx = Fixtures(spark, d)
    ids = at.species_ids(fx.species).first()  # two scalars from the species dimension
    out = at.softwood_flags(fx.gcmeta.drop("species"), ids["sw_species_id"], ids["hw_species_id"])
    return out.select("gcID", "sw_hw", F.col("species").alias("species_id"))


def _gate_inputs(fx: Fixtures):
    tsld = F.when(F.col("row_idx") % 4 == 0, F.lit(None).cast("double")).otherwise((F.col("row_idx") % 5).cast("double"))
    state = fx.state.withColumn("time_since_last_disturbance", tsld)
    inc = fx.increments.select("gcID", (F.col("age") - 1).alias("delay"), *gw.INCREMENT_COLUMNS)
    params = fx.state.join(inc, ["gcID", "delay"], "left").select("row_idx", "age", *gw.INCREMENT_COLUMNS)
    return state, params


def q_regen_delay_gate(spark, d):
    fx = Fixtures(spark, d)
    state, params = _gate_inputs(fx)
    s2, p2 = at.regen_delay_gate(state, params)
    return s2.select("row_idx", "delay", "time_since_last_disturbance", "age").join(
        p2.withColumnRenamed("age", "param_age"), "row_idx", "inner")


def q_parameters_from_state(spark, d):
    fx = Fixtures(spark, d)
    s = fx.state
    params = s.select("row_idx", F.col("delay").alias("disturbance_type"))
    new = s.select((F.col("row_idx") + 100).alias("row_idx"), (F.col("row_idx") % 4 + 1).cast("int").alias(
        "disturbance_type"))
    st = s.select("row_idx", "age", "gcID").unionByName(
        s.select((F.col("row_idx") + 100).alias("row_idx"), F.lit(1).cast("int").alias("age"), "gcID"))
    st = st.join(fx.spatial_unit.select((F.col("id") - 1).alias("gcID"), "mean_annual_temperature"), "gcID", "left")
    return gr.parameters_from_state(params, st, new).select("row_idx", "disturbance_type", "age",
                                                            "mean_annual_temperature")


def q_expand_increments(spark, d):
    fx = Fixtures(spark, d)
    _, groups = _d1(fx)
    g = at.attach_curves(groups, fx.gcmeta)
    return gw.expand_increments(g, fx.increments)


def q_cohorts_with_stands(spark, d):
    return _c1(Fixtures(spark, d))


def q_attach_curves(spark, d):
    fx = Fixtures(spark, d)
    return at.attach_curves(_c1(fx), fx.gcmeta).select("cohortID", "gcID", "sw")


def q_attach_spatial_unit(spark, d):
    fx = Fixtures(spark, d)
    return at.attach_spatial_unit(_c1(fx), _spu(fx)).select("cohortID", "spatial_unit_id",
                                                            "mean_annual_temperature", "return_interval")


def q_fill_spatial_unit(spark, d):
    fx = Fixtures(spark, d)
    _, groups = _d1(fx)
    state, _ = at.fill_spatial_unit(groups, _spu(fx))
    return state.select("row_idx", "spatial_unit_id", "mean_annual_temperature")


def q_type_events(spark, d):
    fx = Fixtures(spark, d)
    return ev.type_events(fx.events, fx.distmeta).select("pixelIndex", "year", "eventID", "disturbance_type_id",
                                                         "priority")


def q_contested_stands(spark, d):
    fx = Fixtures(spark, d)
    return ev.contested_stands(ev.type_events(fx.events, fx.distmeta), Y)


def q_resolve_events(spark, d):
    return _winners(Fixtures(spark, d))


def q_mark_cohorts(spark, d):
    return _marked(Fixtures(spark, d)).select("year", "cohortID", "disturbance_type_id")


def q_cohort_groups(spark, d):
    key, _ = _d1(Fixtures(spark, d))
    return key.select("cohortID", "row_idx")


def q_group_census(spark, d):
    return gr.group_census(Fixtures(spark, d).group_key, Y)


def q_split_disturbed(spark, d):
    fx = Fixtures(spark, d)
    marked, split = _split(fx)
    key = gr.apply_split_to_key(marked, split, Y)
    return key.where(F.col("disturbance_type_id").isNotNull()).select("year", "cohortID", "row_idx_prev", "row_idx")


def q_group_representative(spark, d):
    _, split = _split(Fixtures(spark, d))
    return split.new_groups


def q_disturbed_with_state(spark, d):
    fx = Fixtures(spark, d)
    out = gr.disturbed_with_state(_marked(fx), fx.state, fx.pools, Y)
    return out.select("year", "cohortID", "row_idx_prev", "disturbance_type_id", "age", "delay", "Merch")


def q_clone_group_rows(spark, d):
    fx = Fixtures(spark, d)
    _, split = _split(fx)
    rows = gr.clone_group_rows(split.new_groups, fx.state, Y)
    return gr.reset_disturbed_state(rows)


def _union_pools(fx: Fixtures, split):
    new = gr.reset_disturbed_pools(gr.clone_group_rows(split.new_groups, fx.pools, Y))
    return gr.union_fill(fx.pools, new)


def q_union_fill(spark, d):
    fx = Fixtures(spark, d)
    _, split = _split(fx)
    return _union_pools(fx, split)


def q_drop_inactive(spark, d):
    fx = Fixtures(spark, d)
    counts = materialize(gr.group_counts(_marked(fx), Y), "group-counts")
    split = gr.split_disturbed(fx.key, fx.state, fx.pools, classifiers=_classifiers(fx), by=Y, counts=counts)
    return gr.drop_inactive(_union_pools(fx, split), gr.live_groups(fx.key, split, Y, counts), Y)


def q_last_increment(spark, d):
    return gw.last_increment(Fixtures(spark, d).increments)


def q_annual_increments(spark, d):
    fx = Fixtures(spark, d)
    out = gw.annual_increments(_c1(fx), fx.gcmeta, fx.increments)
    return out.select("cohortID", "gcID", "age", *gw.INCREMENT_COLUMNS)


def q_annual_increments_unit(spark, d):
    """C10 for a state that has the spatial unit only: its site comes from the unit (Q17)."""
    fx = Fixtures(spark, d)
    state = at.attach_spatial_unit(_c1(fx), _spu(fx)).select("cohortID", "species", "age", "spatial_unit_id")
    out = gw.annual_increments(state, fx.gcmeta, fx.increments, units=_spu(fx))
    return out.select("cohortID", "spatial_unit_id", "gcID", "age", *gw.INCREMENT_COLUMNS)


def q_extend_curves(spark, d):
    fx = Fixtures(spark, d)
    return gw.extend_curves(fx.increments, fx.cohort.select("age"))


def q_cohorts_with_area(spark, d):
    fx = Fixtures(spark, d)
    return rp.cohorts_with_area(fx.key, fx.stand)


def q_group_area(spark, d):
    """Every fiftieth stand has no known area."""
    fx = Fixtures(spark, d)
    stands = fx.stand.withColumn("area", F.when(F.col("pixelIndex") % 50 != 0, F.col("area")))
    return rp.group_area(fx.key, stands, Y)


def q_flux_totals(spark, d):
    fx = Fixtures(spark, d)
    return rp.flux_totals(fx.flux, _areas(fx), Y)


def q_emission_gases(spark, d):
    fx = Fixtures(spark, d)
    return rp.emission_gases(rp.flux_totals(fx.flux, _areas(fx), Y)).select("year", "CO2", "CH4", "CO", "Emissions")


def q_products_stock(spark, d):
    fx = Fixtures(spark, d)
    return rp.products_stock(fx.pools, _areas(fx), Y)


def q_products_by_year(spark, d):
    fx = Fixtures(spark, d)
    return rp.products_by_year(rp.products_stock(fx.pools, _areas(fx), Y)).select("year", "Products")


def q_emissions_products(spark, d):
    fx = Fixtures(spark, d)
    return rp.emissions_products(fx.key, fx.stand, fx.flux, fx.pools)


def q_cohort_flux(spark, d):
    fx = Fixtures(spark, d)
    return rp.cohort_flux(fx.key.select("year", "cohortID", "row_idx"), fx.flux, Y)


def q_npp_by_year(spark, d):
    fx = Fixtures(spark, d)
    return rp.npp_by_year(fx.group_key, fx.flux, Y)


def q_npp_by_year_area(spark, d):
    fx = Fixtures(spark, d)
    return rp.npp_by_year(fx.key, fx.flux, Y, areas=_areas(fx))


def q_npp_by_stand(spark, d):
    fx = Fixtures(spark, d)
    return rp.npp_by_stand(fx.group_key, fx.flux, Y, tasks=fx.tasks)


def q_pool_proportions(spark, d):
    fx = Fixtures(spark, d)
    return rp.pool_proportions(fx.pools, _areas(fx), fx.pool_class, Y, DIGITS)


def q_total_carbon_by_stand(spark, d):
    fx = Fixtures(spark, d)
    return rp.total_carbon_by_stand(fx.group_key, fx.group_pools, Y, tasks=fx.tasks)


def q_age_panel(spark, d):
    fx = Fixtures(spark, d)
    winners = ev.resolve_events(ev.type_events(fx.sparse_events, fx.distmeta), by=Y)
    return ev.age_panel(winners, HORIZON, cohorts=fx.cohort, delay_col="delayRegen")


def q_age_panel_all(spark, d):
    """E3 over all events of all stands."""
    fx = Fixtures(spark, d)
    return ev.age_panel(_winners(fx), HORIZON, cohorts=fx.cohort, delay_col="delayRegen")


def q_interval_growth(spark, d):
    """E3 -> C10: what each cohort has grown between its events, over all events."""
    fx = Fixtures(spark, d)
    curves = at.attach_curves(_c1(fx), fx.gcmeta).select("cohortID", "pixelIndex", "delayRegen", "gcID")
    spans = ev.event_intervals(_winners(fx), HORIZON, curves, delay_col="delayRegen")
    return gw.interval_growth(spans, fx.increments).drop("pixelIndex", "delay")


def q_ingest_events(spark, d):
    fx = Fixtures(spark, d)
    table = shared_dir(spark, "events-table")
    return ingest_events(spark, fx.sf_dir, table, schema=fx.raw("events").schema,
                         transform=Fixtures.events_from_raw, glob_filter="events.parquet")


def q_winners_by_batch(spark, d):
    """A7 + E1: the events come in four batches of a stream, one of which is merged again."""
    fx = Fixtures(spark, d)
    source, root = shared_dir(spark, "event-files"), shared_dir(spark, "winners")
    parts = fx.events.withColumn("part", F.pmod(F.xxhash64("pixelIndex", "year", "eventID"), F.lit(4)))
    for k in range(4):
        parts.where(F.col("part") == k).drop("part").coalesce(1).write.mode("append").parquet(source)
    query = start_winner_updates(spark, source, fx.distmeta, root, glob_filter="*.parquet", files_per_batch=1)
    query.awaitTermination()
    merge_events(parts.where("part = 0").drop("part"), fx.distmeta, root, 0)
    return read_winners(spark, root)


def q_orphans(spark, d):
    fx = Fixtures(spark, d)
    twice = F.explode(F.when(F.col("pixelIndex") % 37 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    stands = fx.stand.withColumn("__copy", twice).drop("__copy")
    meta = fx.distmeta.unionByName(fx.distmeta.where("eventID = 2").withColumn("priority", F.lit(9)))
    curves = fx.gcmeta.unionByName(fx.gcmeta.where("gcID % 10 = 3").withColumn("gcID", F.col("gcID") + 1000))
    units = _units(fx).unionByName(_units(fx).where("spatial_unit_id = 4"))
    return qa.orphans(stands, fx.cohort, fx.events, meta, curves, units, _group_units(fx))


def q_temp_modifier(spark, d):
    fx = Fixtures(spark, d)
    lp = rp.pools_long(fx.pools, None, Y)
    out = tr.temp_modifiers(lp, _group_units(fx), _units(fx), fx.decay, Y)
    return out.select("year", "row_idx", "pool", _r("temp_mod"))


def q_stand_modifier(spark, d):
    fx = Fixtures(spark, d)
    return tr.stand_modifiers(fx.pools, _group_units(fx), fx.stand_coefficients, Y).select("year", "row_idx", _r("stand_mod"))


def q_decay_rates(spark, d):
    fx = Fixtures(spark, d)
    lp = rp.pools_long(fx.pools, None, Y)
    out = tr.decay_rates(lp, fx.pools, _group_units(fx), _units(fx), fx.decay, fx.stand_coefficients, Y)
    return out.select("year", "row_idx", "pool", _r("decay_rate"))


def q_root_split(spark, d):
    fx = Fixtures(spark, d)
    p = fx.pools.join(_wood(fx).select("row_idx", "sw_hw"), "row_idx", "left")
    out = tr.root_split(p, "sw_hw", fx.roots)
    return out.select("year", "row_idx", _r("total_root"), _r("fine_roots"), _r("coarse_roots"))


def q_apply_transfers(spark, d):
    fx = Fixtures(spark, d)
    lp = _group_types(rp.pools_long(fx.pools, None, Y))
    return tr.apply_transfers(lp, fx.matrix, "disturbance_type_id", Y)


def q_transfer_flux(spark, d):
    fx = Fixtures(spark, d)
    lp = _group_types(rp.pools_long(fx.pools, None, Y))
    return tr.transfer_flux(lp, fx.matrix, fx.flux_map, "disturbance_type_id", Y)


def q_apply_transfers_wide(spark, d):
    fx = Fixtures(spark, d)
    return tr.apply_transfers_wide(_group_types(fx.pools), fx.matrix, by=Y).drop("disturbance_type_id")


def q_transfer_flux_wide(spark, d):
    fx = Fixtures(spark, d)
    return tr.transfer_flux_wide(_group_types(fx.pools), fx.matrix, fx.flux_map, by=Y)


def _composed(fx: Fixtures) -> DataFrame:
    """Disturbance, turnover and mixing of a year as one matrix per disturbance type; 0 and 4 are types
    without a disturbance matrix."""
    types = fx.distmeta.select("disturbance_type_id").union(fx.spark.createDataFrame([(0,)], "disturbance_type_id int")).distinct()
    first = tr.complete(fx.matrix, fx.POOL_NAMES, types)
    then = tr.complete(fx.yearly_turnover, fx.POOL_NAMES)
    last = tr.complete(fx.yearly_mixing, fx.POOL_NAMES)
    keys = ("disturbance_type_id",)
    return tr.conserving(tr.compose(tr.compose(first, then, keys), last, keys), keys)


def q_composed_matrix(spark, d):
    """The product as a table, for the types that groups of the panel have."""
    fx = Fixtures(spark, d)
    used = _group_types(fx.pools.select("row_idx")).select("disturbance_type_id").distinct()
    return _composed(fx).join(used, "disturbance_type_id", "left_semi").where("proportion <> 0")


def q_composed_transfers(spark, d):
    """Three matrices multiplied first, then applied in one pass over the pools."""
    fx = Fixtures(spark, d)
    return tr.apply_transfers_wide(_group_types(fx.pools), _composed(fx), by=Y).drop("disturbance_type_id")


def q_half_growth(spark, d):
    fx = Fixtures(spark, d)
    w = tr.half_growth(fx.pools, _state_increments(fx), Y)
    return rp.pools_long(w, ["Merch", "Foliage", "Other"], Y)


def q_overmature_decline(spark, d):
    fx = Fixtures(spark, d)
    return tr.overmature_decline(fx.pools, _state_increments(fx), fx.turnover, Y)


def q_slow_mixing(spark, d):
    fx = Fixtures(spark, d)
    return tr.slow_mixing(rp.pools_long(fx.pools, None, Y), source="StemSnags", sink="MediumSoil", by=Y)


def q_overmature_decline_wide(spark, d):
    fx = Fixtures(spark, d)
    return tr.overmature_decline_wide(fx.pools, _state_increments(fx), fx.turnover, Y)


def q_slow_mixing_wide(spark, d):
    return tr.slow_mixing_wide(Fixtures(spark, d).pools, source="StemSnags", sink="MediumSoil")


# ---- options, layouts and guards -----------------------------------------------------------

def q_group_area_shared(spark, d):
    """Q5: the area of a stand dealt to its cohorts. Shares are no binary fractions, so they are rounded."""
    fx = Fixtures(spark, d)
    out = rp.group_area(fx.key, fx.stand, Y, equal_split=True, tasks=fx.tasks)
    return out.select("year", "row_idx", F.round("area_m2", 3).alias("area_m2"), F.round("area_ha", 7).alias("area_ha"))


def q_products_by_year_initial(spark, d):
    """Q11: the stock of the first year was there before."""
    fx = Fixtures(spark, d)
    return rp.products_by_year(rp.products_stock(fx.pools, _areas(fx), Y), initial_year=1).select("year", "Products")


def q_clustered_cohorts_with_stands(spark, d):
    """C1 on tables clustered by stand."""
    fx = Fixtures(spark, d)
    return at.cohorts_with_stands(clustered(fx.cohort, "cohorts"), clustered(fx.stand, "stands"))


def q_clustered_mark_cohorts(spark, d):
    """C5 -> E1 -> C6 on tables clustered by stand."""
    fx = Fixtures(spark, d)
    marked = ev.mark_by_history(clustered(fx.key, "key"), clustered(fx.events, "events"), fx.distmeta)
    return marked.select("year", "cohortID", "disturbance_type_id")


def q_clustered_cohorts_with_area(spark, d):
    """C11 on tables clustered by stand."""
    fx = Fixtures(spark, d)
    return rp.cohorts_with_area(clustered(fx.key, "key"), clustered(fx.stand, "stands"))


def q_cohort_groups_hot(spark, d):
    """D1 where a third of all cohorts is one group; only heavy groups are broadcast."""
    key, _ = gr.cohort_groups(Fixtures(spark, d).hot_cohort_stands, small=0)
    return key.select("cohortID", "row_idx")


def q_cohort_flux_hot(spark, d):
    fx = Fixtures(spark, d)
    return rp.cohort_flux(fx.hot_key.select("year", "cohortID", "row_idx"), fx.hot_flux, Y, heavy=True)


def q_npp_by_stand_hot(spark, d):
    fx = Fixtures(spark, d)
    return rp.npp_by_stand(fx.dealt(fx.hot_key, "year", "pixelIndex"), fx.hot_flux, Y, heavy=True, tasks=fx.tasks)


def q_total_carbon_by_stand_hot(spark, d):
    fx = Fixtures(spark, d)
    return rp.total_carbon_by_stand(fx.dealt(fx.hot_key, "year", "pixelIndex"), fx.hot_pools, Y, heavy=True, tasks=fx.tasks)


def q_run_warnings(spark, d):
    """Q18: counts that ride along while the typed events, the increments and the areas of a run are written."""
    fx = Fixtures(spark, d)
    watch = Watch()
    materialize(watch.events(ev.type_events(fx.events, fx.distmeta)), "typed-events")
    cohorts = at.attach_curves(_c1(fx), fx.gcmeta).select("cohortID", "gcID", "age")
    materialize(watch.increments(gw.increments_at_age(cohorts, fx.increments), fx.increments), "increments")
    stands = fx.stand.withColumn("area", F.when(F.col("pixelIndex") % 50 != 0, F.col("area")))
    materialize(watch.areas(rp.cohorts_with_area(fx.key, stands)), "areas")
    return spark.createDataFrame(sorted(watch.counts().items()), "check string, n long")


def q_read_delimited(spark, d):
    """The cohort table by way of CSV files in which some fields are empty or no numbers."""
    fx = Fixtures(spark, d)
    age = F.when(F.col("cohortID") % 97 == 0, "old").otherwise(F.col("age").cast("string"))
    species = F.when(F.col("cohortID") % 89 != 0, F.col("species"))
    path = shared_dir(spark, "cohorts-csv")
    fx.cohort.select("cohortID", "pixelIndex", species.alias("species"), age.alias("age")).write.csv(path, header=True)
    return read_delimited(spark, path, SCHEMAS["cohorts"], required=("cohortID", "species"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "spatial_units": q_spatial_units,
    "read_snapshots": q_read_snapshots,
    "write_snapshot": q_write_snapshot,
    "append_year": q_append_year,
    "year_filter": q_year_filter,
    "spinup_parameters": q_spinup_parameters,
    "default_sw_hw": q_default_sw_hw,
    "softwood_flags_step": q_softwood_flags_step,
    "fill_spatial_unit_parameters": q_fill_spatial_unit_parameters,
    "clone_flux": q_clone_flux,
    "emissions_products_extra": q_emissions_products_extra,
    "prepare_groups_key": q_prepare_groups_key,
    "prepare_groups_state": q_prepare_groups_state,
    "prepare_groups_pools": q_prepare_groups_pools,
    "prepare_groups_flux": q_prepare_groups_flux,
    "prepare_groups_parameters": q_prepare_groups_parameters,
    "fill_or_add": q_fill_or_add,
    "softwood_flags": q_softwood_flags,
    "regen_delay_gate": q_regen_delay_gate,
    "parameters_from_state": q_parameters_from_state,
    "expand_increments": q_expand_increments,
    "cohorts_with_stands": q_cohorts_with_stands,
    "attach_curves": q_attach_curves,
    "attach_spatial_unit": q_attach_spatial_unit,
    "fill_spatial_unit": q_fill_spatial_unit,
    "type_events": q_type_events,
    "contested_stands": q_contested_stands,
    "resolve_events": q_resolve_events,
    "mark_cohorts": q_mark_cohorts,
    "cohort_groups": q_cohort_groups,
    "group_census": q_group_census,
    "disturbed_with_state": q_disturbed_with_state,
    "split_disturbed": q_split_disturbed,
    "group_representative": q_group_representative,
    "clone_group_rows": q_clone_group_rows,
    "union_fill": q_union_fill,
    "drop_inactive": q_drop_inactive,
    "last_increment": q_last_increment,
    "annual_increments": q_annual_increments,
    "annual_increments_unit": q_annual_increments_unit,
    "extend_curves": q_extend_curves,
    "cohorts_with_area": q_cohorts_with_area,
    "group_area": q_group_area,
    "flux_totals": q_flux_totals,
    "emission_gases": q_emission_gases,
    "products_stock": q_products_stock,
    "products_by_year": q_products_by_year,
    "emissions_products": q_emissions_products,
    "cohort_flux": q_cohort_flux,
    "npp_by_year": q_npp_by_year,
    "npp_by_year_area": q_npp_by_year_area,
    "npp_by_stand": q_npp_by_stand,
    "pool_proportions": q_pool_proportions,
    "total_carbon_by_stand": q_total_carbon_by_stand,
    "age_panel": q_age_panel,
    "age_panel_all": q_age_panel_all,
    "interval_growth": q_interval_growth,
    "winners_by_batch": q_winners_by_batch,
    "orphans": q_orphans,
    "ingest_events": q_ingest_events,
    "temp_modifier": q_temp_modifier,
    "stand_modifier": q_stand_modifier,
    "decay_rates": q_decay_rates,
    "root_split": q_root_split,
    "apply_transfers": q_apply_transfers,
    "transfer_flux": q_transfer_flux,
    "half_growth": q_half_growth,
    "overmature_decline": q_overmature_decline,
    "slow_mixing": q_slow_mixing,
    "apply_transfers_wide": q_apply_transfers_wide,
    "transfer_flux_wide": q_transfer_flux_wide,
    "composed_matrix": q_composed_matrix,
    "composed_transfers": q_composed_transfers,
    "overmature_decline_wide": q_overmature_decline_wide,
    "slow_mixing_wide": q_slow_mixing_wide,
    "group_area_shared": q_group_area_shared,
    "products_by_year_initial": q_products_by_year_initial,
    "clustered_cohorts_with_stands": q_clustered_cohorts_with_stands,
    "clustered_mark_cohorts": q_clustered_mark_cohorts,
    "clustered_cohorts_with_area": q_clustered_cohorts_with_area,
    "cohort_groups_hot": q_cohort_groups_hot,
    "cohort_flux_hot": q_cohort_flux_hot,
    "npp_by_stand_hot": q_npp_by_stand_hot,
    "total_carbon_by_stand_hot": q_total_carbon_by_stand_hot,
    "run_warnings": q_run_warnings,
    "read_delimited": q_read_delimited,
}
