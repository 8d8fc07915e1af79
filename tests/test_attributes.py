"""Attribute helpers on hand-made frames (B1-B4, B7, B8, C3, C13; Q13, Q15, Q17)."""

import pytest

from sylva.operators import attributes as at


def test_spinup_defaults_with_age_spinup_and_delay(spark):
    g = spark.createDataFrame([(1, 50, 30, None), (2, 40, 20, 3)], "row_idx long, age int, ageSpinup int, delaySpinup int")
    out = {r["row_idx"]: r for r in at.spinup_defaults(g, "ageSpinup", "delaySpinup", default_delay=7).collect()}
    assert out[1]["age"] == 30 and out[1]["age_in"] == 50  # Q13: the run starts from ageSpinup
    assert out[1]["delay"] == 7 and out[2]["delay"] == 3
    assert out[1]["historical_disturbance_type"] == 1 and out[1]["last_pass_disturbance_type"] == 1
    assert at.per_hectare(g).first()["area"] == 1


def test_softwood_flags_spinup_and_step(spark):
    g = spark.createDataFrame([(1, True), (2, False), (3, None)], "gcID int, sw boolean")
    sp = {r["gcID"]: (r["sw_hw"], r["species"]) for r in at.softwood_flags(g, 11, 22).collect()}
    assert sp == {1: (0, 11), 2: (1, 22), 3: (None, None)}
    st = spark.createDataFrame([(1, 0), (2, 1), (3, None)], "row_idx long, sw_hw int")
    step = {r["row_idx"]: r["species"] for r in at.softwood_flags(st, 11, 22, mode="step").collect()}
    assert step == {1: 11, 2: 22, 3: 0}


def test_default_sw_hw_guard(spark):
    st = spark.createDataFrame([(1, None), (2, 1)], "row_idx long, sw_hw int")
    ok = spark.createDataFrame([(1, None, 0.0, None), (2, 1.0, 1.0, 1.0)],
                               "row_idx long, merch_inc double, foliage_inc double, other_inc double")
    assert {r["row_idx"]: r["sw_hw"] for r in at.default_sw_hw(st, ok).collect()} == {1: 0, 2: 1}
    bad = spark.createDataFrame([(1, 0.5, 0.0, 0.0)], "row_idx long, merch_inc double, foliage_inc double, other_inc double")
    with pytest.raises(ValueError, match="sw_hw"):
        at.default_sw_hw(st, bad)


def test_spatial_unit_keys_and_fill(spark):
    units = spark.createDataFrame([(7, "A", 1, 2.5)], "spatial_unit_id int, admin_name string, eco_id int, "
                                                       "mean_annual_temperature double")
    g = spark.createDataFrame([(1, "A", 1), (2, "B", 1)], "row_idx long, admin_name string, eco_id int")
    out = {r["row_idx"]: (r["spatial_unit_id"], r["mean_annual_temperature"])
           for r in at.attach_spatial_unit(g, units).collect()}
    assert out == {1: (7, 2.5), 2: (None, None)}
    with pytest.raises(ValueError, match="spatial_unit_id"):
        at.attach_spatial_unit(g.drop("eco_id"), units)
    params = spark.createDataFrame([(1,), (2,)], "row_idx long")
    st, pa = at.fill_spatial_unit(g, units, params)
    assert {r["row_idx"]: r["mean_annual_temperature"] for r in pa.collect()} == {1: 2.5, 2: None}


def test_regen_delay_gate(spark):
    st = spark.createDataFrame([(1, 5, 2, None), (2, 5, 2, 2.0), (3, 5, 2, 3.0)],
                               "row_idx long, age int, delay int, time_since_last_disturbance double")
    pa = spark.createDataFrame([(r, 5, 1.0, 1.0, 1.0) for r in (1, 2, 3)],
                               "row_idx long, age int, merch_inc double, foliage_inc double, other_inc double")
    s2, p2 = at.regen_delay_gate(st, pa)
    assert {r["row_idx"]: r["age"] for r in s2.collect()} == {1: 0, 2: 0, 3: 5}
    assert {r["row_idx"]: r["merch_inc"] for r in p2.collect()} == {1: 0.0, 2: 0.0, 3: 1.0}


def test_null_classifier_matches_null_curve(spark):
    g = spark.createDataFrame([(1, "A", None), (2, "A", "x"), (3, "B", "x")], "row_idx long, admin_name string, sp string")
    meta = spark.createDataFrame([(10, "A", None, True), (11, "A", "x", False)],
                                 "gcID int, admin_name string, sp string, sw boolean")
    got = {r["row_idx"]: r["gcID"] for r in at.attach_curves(g, meta).collect()}
    assert got == {1: 10, 2: 11, 3: None}  # R joins NA to NA


def test_extra_classifier_splits_groups_and_optional_columns_default(spark):
    from sylva.operators import groups as gr
    from sylva.plans import annual as an
    cs = spark.createDataFrame([(1, 1, 5, "x"), (2, 2, 5, "y")], "cohortID long, pixelIndex long, age int, extra string")
    _, groups = gr.cohort_groups(cs)
    assert groups.count() == 2
    _, groups2 = gr.cohort_groups(cs.drop("extra"))
    assert groups2.count() == 1
    # only required columns: defaults for delay and disturbance types are added
    stands = spark.createDataFrame([(1, "A", 1), (2, "A", 1)], "pixelIndex long, admin_name string, eco_id int")
    cohorts = spark.createDataFrame([(1, 1, 1, 5), (2, 2, 1, 5)], "cohortID long, pixelIndex long, gcID int, age int")
    meta = spark.createDataFrame([(1, "A", 1, True)], "gcID int, admin_name string, eco_id int, sw boolean")
    incs = spark.createDataFrame([(1, 1, 1.0, 1.0, 1.0)], "gcID int, age int, merch_inc double, foliage_inc double, "
                                                          "other_inc double")
    key, g, inc = an.spinup_inputs(an.Inputs(stands=stands, cohorts=cohorts, gcmeta=meta, increments=incs))
    row = g.collect()[0]
    assert g.count() == 1 and key.count() == 2 and inc.count() == 1
    assert (row["delay"], row["historical_disturbance_type"], row["last_pass_disturbance_type"], row["sw_hw"]) == \
        (0, 1, 1, 0)
    from sylva.operators import reports as rp
    with pytest.warns(UserWarning):
        area = rp.group_area(key, stands, by=())
    assert area.collect()[0]["area_ha"] == 2.0  # no area column: 1 ha per stand, two stands
