"""Transfers: carbon conservation, unmatched sources, the year's chain."""

import pytest
from pyspark.sql import functions as F

from sylva.operators import reports as rp
from sylva.operators import transfers as tr
from sylva.sources.fixtures import Fixtures
from conftest import SF_SMALL


def test_conservation_and_unmatched_source(spark):
    pools = spark.createDataFrame([(1, 1, 4.0, 2.0, 1.0), (1, 2, 8.0, 0.0, 0.0)],
                                  "year int, row_idx long, Merch double, Foliage double, StemSnags double")
    lp = rp.pools_long(pools).withColumn("disturbance_type_id", F.when(F.col("row_idx") == 1, 1).otherwise(9))
    m = spark.createDataFrame([(1, "Merch", "CO2", 0.25), (1, "Merch", "Products", 0.75)],
                              "disturbance_type_id int, source string, sink string, proportion double")
    out = {(r["row_idx"], r["pool"]): r["value"] for r in tr.apply_transfers(lp, m).collect()}
    assert out[(1, "Merch")] == 0.0 and out[(1, "CO2")] == 1.0 and out[(1, "Products")] == 3.0
    assert out[(1, "Foliage")] == 2.0 and out[(2, "Merch")] == 8.0  # no matrix: nothing moves
    total_in = {1: 7.0, 2: 8.0}
    for rid, tot in total_in.items():
        assert sum(v for (r, _), v in out.items() if r == rid) == tot
    flux = tr.transfer_flux(lp, m, spark.createDataFrame([("Merch", "CO2", "BioCO2")], "source string, sink string, "
                                                                                         "flux string")).collect()
    assert sorted((r["row_idx"], r["flux"], r["value"]) for r in flux) == [(1, "BioCO2", 1.0), (1, tr.UNMAPPED, 3.0)]


def test_slow_mixing_rate(spark):
    pools = spark.createDataFrame([(1, 1, 1000.0)], "year int, row_idx long, AboveGroundSlowSoil double")
    out = {r["pool"]: r["value"] for r in tr.slow_mixing(rp.pools_long(pools)).collect()}
    assert out["BelowGroundSlowSoil"] == pytest.approx(6.0)
    assert out["AboveGroundSlowSoil"] == pytest.approx(994.0)


def test_nothing_disappears(spark):
    pools = spark.createDataFrame([(1, 1, 4.0, None, 1.0)], "year int, row_idx long, Merch double, Foliage double, Other double")
    lp = rp.pools_long(pools).withColumn("disturbance_type_id", F.lit(1))
    m = spark.createDataFrame([(1, "Merch", "CO2", 0.5), (1, "Merch", "Products", 0.5), (1, "Foliage", "Products", 1.0)],
                              "disturbance_type_id int, source string, sink string, proportion double")
    out = {r["pool"]: r["value"] for r in tr.apply_transfers(lp, m).collect()}
    assert out == {"Merch": 0.0, "CO2": 2.0, "Products": None, "Foliage": None, "Other": 1.0}  # NULL stays NULL
    names = spark.createDataFrame([("Merch", "CO2", "BioCO2")], "source string, sink string, flux string")
    flux = {r["flux"]: r["value"] for r in tr.transfer_flux(lp.where("pool = 'Merch'"), m, names).collect()}
    assert flux == {"BioCO2": 2.0, tr.UNMAPPED: 2.0}
    with pytest.raises(Exception, match="more than one flux name"):
        tr.transfer_flux(lp, m, names.union(names.select("source", "sink", F.lit("Other")))).collect()
    inc = spark.createDataFrame([(1, -1.0, 0.5, -0.25)], "row_idx long, merch_inc double, foliage_inc double, other_inc double")
    turnover = spark.createDataFrame([("Merch", "Snags", 1.0)], "source string, sink string, proportion double")
    out = {r["pool"]: r["value"] for r in tr.overmature_decline(pools, inc, turnover).collect()}
    assert out["Merch"] == 3.0 and out["Snags"] == 1.0 and out["Other"] == 0.75 and out[tr.UNMAPPED] == 0.25
    assert out["Foliage"] is None


def test_groups_without_a_unit_keep_their_rows(spark):
    lp = spark.createDataFrame([(1, 1, "Soil", 1.0), (1, 2, "Soil", 1.0)], "year int, row_idx long, pool string, value double")
    units = spark.createDataFrame([(5, 10.0)], "spatial_unit_id int, mean_annual_temperature double")
    of = spark.createDataFrame([(1, 5)], "row_idx long, spatial_unit_id int")
    par = spark.createDataFrame([("Soil", 0.5, 10.0, 2.0)], "pool string, base_rate double, ref_temp double, q10 double")
    out = {r["row_idx"]: r["temp_mod"] for r in tr.temp_modifiers(lp, of, units, par).collect()}
    assert out == {1: 1.0, 2: None}


def test_shares_count_unmapped_pools(spark):
    pools = spark.createDataFrame([(1, 1, 2.0, 2.0, 6.0)], "year int, row_idx long, Merch double, Foliage double, MediumSoil double")
    areas = spark.createDataFrame([(1, 1, 10000.0)], "year int, row_idx long, area_m2 double")
    classes = spark.createDataFrame([("Merch", "Biomass"), ("Foliage", "Biomass")], "pool string, pool_class string")
    got = {r["pool_class"]: (r["carbon"], r["share"]) for r in rp.pool_proportions(pools, areas, classes).collect()}
    assert got == {"Biomass": (4.0, 0.4), "unmapped": (6.0, 0.6)}


def test_unknown_result_columns_raise(spark):
    fx = Fixtures(spark, SF_SMALL)
    with pytest.raises(ValueError, match="NoSuchFlux"):
        rp.emissions_products(fx.key, fx.stand, fx.flux, fx.pools, extra_columns=["NoSuchFlux"])


def test_root_split_and_modifiers(spark):
    pools = spark.createDataFrame([(1, 1, 1.0, 1.0, 0), (1, 2, 1.0, 1.0, 1), (1, 3, 1.0, 1.0, None)],
                                  "year int, row_idx long, Merch double, Foliage double, sw_hw int")
    roots = spark.createDataFrame([(0, 1.0, 1.0, 0.5, 0.0, 1.0, 1.0), (1, 1.0, 1.0, 0.5, 0.0, 1.0, 1.0)],
                                  "sw_hw int, hw_a double, hw_b double, sw_a double, frp_a double, frp_b double, frp_c double")
    out = {r["row_idx"]: r for r in tr.root_split(pools, "sw_hw", roots).collect()}
    assert out[1]["total_root"] == 2.0 and out[2]["total_root"] == 4.0 and out[3]["total_root"] is None
    assert out[1]["fine_roots"] + out[1]["coarse_roots"] == pytest.approx(2.0)
    of = spark.createDataFrame([(1, 1), (2, 2)], "row_idx long, spatial_unit_id int")
    c = spark.createDataFrame([(1, 0.0, 2.0), (2, 4.0, 1.0)], "spatial_unit_id int, max_bio double, max_r double")
    sm = {r["row_idx"]: r["stand_mod"] for r in tr.stand_modifiers(pools, of, c).collect()}
    assert sm == {1: None, 2: 1.0, 3: None}  # max_bio 0: NULL, no division error
