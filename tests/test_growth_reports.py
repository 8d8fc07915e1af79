"""Growth lookup edge cases (C10, F4), areas and totals (Q1, Q4, Q5, E2), schema helpers."""

import pytest

from sylva.functions.columns import result_columns
from sylva.operators import growth as gw
from sylva.operators import reports as rp
from sylva.sources.schema import require_columns

INC = "gcID int, age int, merch_inc double, foliage_inc double, other_inc double"


def _incs(spark):
    # curve 1: ages 1, 3, 4 (gap at 2); curve 2: no rows
    return spark.createDataFrame([(1, 1, 1.0, 0.0, 0.0), (1, 3, 3.0, 0.0, 0.0), (1, 4, 4.0, 0.0, 0.0)], INC)


def test_annual_lookup_clamp_gap_below_and_null(spark):
    meta = spark.createDataFrame([(1, "A", 1, "x", True), (2, "A", 1, "y", True)],
                                 "gcID int, admin_name string, eco_id int, sp string, sw boolean")
    state = spark.createDataFrame(
        [(1, "A", 1, "x", 9), (2, "A", 1, "x", 2), (3, "A", 1, "x", 0), (4, "A", 1, "x", None),
         (5, "A", 1, "x", 3), (6, "A", 1, "y", 5)],
        "row_idx long, admin_name string, eco_id int, sp string, age int")
    got = {r["row_idx"]: r["merch_inc"] for r in gw.annual_increments(state, meta, _incs(spark)).collect()}
    assert got == {1: 4.0, 2: None, 3: None, 4: None, 5: 3.0, 6: None}


def test_extend_curves(spark):
    out = gw.extend_curves(_incs(spark), 6).collect()
    ages = sorted(r["age"] for r in out)
    assert ages == [1, 3] + list(range(4, 6 + 250 + 1))
    assert all(r["merch_inc"] == 4.0 for r in out if r["age"] >= 4)


def test_positive_ages_and_expand(spark):
    incs = spark.createDataFrame([(1, 0, 0.0, 0.0, 0.0), (1, 1, 1.0, 0.0, 0.0), (1, 2, 2.0, 0.0, 0.0)], INC)
    groups = spark.createDataFrame([(1, 1), (2, 1), (3, 9)], "row_idx long, gcID int")
    assert gw.expand_increments(groups, incs).count() == 4


def test_null_area_makes_totals_null_and_missing_area_is_one_hectare(spark):
    key = spark.createDataFrame([(2000, 1, 1, 1), (2000, 2, 2, 1)], "year int, cohortID long, pixelIndex long, row_idx long")
    stands = spark.createDataFrame([(1, 900.0), (2, None)], "pixelIndex long, area double")
    areas = rp.group_area(key, stands).collect()
    assert areas[0]["area_m2"] is None
    with pytest.warns(UserWarning):
        a2 = rp.group_area(key, stands.drop("area")).collect()
    assert a2[0]["area_ha"] == 2.0  # each cohort counts its whole stand: 2 x 1 ha (Q4, Q5)


def test_products_by_year_telescopes_and_propagates_null(spark):
    stock = spark.createDataFrame([(1, 10.0), (2, 15.0), (3, None), (4, 20.0)], "year int, products_stock double")
    got = {r["year"]: r["Products"] for r in rp.products_by_year(stock).collect()}
    assert got == {1: 10.0, 2: 5.0, 3: None, 4: None}


def test_npp_counts_cohorts(spark):
    key = spark.createDataFrame([(1, 1, 1, 1), (1, 2, 1, 1), (1, 3, 2, 2)],
                                "year int, cohortID long, pixelIndex long, row_idx long")
    cols = rp.NPP_FLUX
    flux = spark.createDataFrame([(1, 1, *[1.0] * 7), (1, 2, *[0.5] * 7)],
                                 "year int, row_idx long, " + ", ".join(f"{c} double" for c in cols))
    assert rp.npp_by_year(key, flux).collect()[0]["NPP"] == 2 * 7.0 + 3.5
    by_stand = {r["pixelIndex"]: r["NPP"] for r in rp.npp_by_stand(key, flux).collect()}
    assert by_stand == {1: 14.0, 2: 3.5}


def test_schema_helpers(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError, match="cohorts lacks b"):
        require_columns(df, "cohorts", ["a", "b"])
    with pytest.raises(ValueError, match="stands is needed"):
        require_columns(None, "stands", ["a"])
    assert result_columns(["CO2", "DecayDOMCO2Emission"]) == ["Products", "Emissions", "CO2", "CH4", "CO",
                                                              "DecayDOMCO2Emission"]
