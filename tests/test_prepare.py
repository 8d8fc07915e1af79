"""Group tables before the first year and the preparation of a year's cohort groups."""

import pytest
from pyspark.sql import functions as F

from sylva.plans import annual as an
from sylva.plans.catalog import QUERIES
from sylva.sources.schema import CarbonTables

from conftest import SF_SMALL


def _inputs(spark):
    stands = spark.createDataFrame([(1, "Saskatchewan", 9, 900.0), (2, "Saskatchewan", 9, 900.0)],
                                   "pixelIndex long, admin_name string, eco_id int, area double")
    cohorts = spark.createDataFrame([(1, 1, 1, 10, 0), (2, 2, 1, 10, 2)],
                                    "cohortID long, pixelIndex long, gcID int, age int, delayRegen int")
    gcmeta = spark.createDataFrame([(1, "Saskatchewan", 9, True)], "gcID int, admin_name string, eco_id int, sw boolean")
    rows = [(1, a, a / 128.0, a / 128.0, a / 128.0) for a in range(0, 101)]
    incs = spark.createDataFrame(rows, "gcID int, age int, merch_inc double, foliage_inc double, other_inc double")
    return an.Inputs(stands=stands, cohorts=cohorts, gcmeta=gcmeta, increments=incs)


def test_spinup_inputs(spark):
    key, groups, incs = an.spinup_inputs(_inputs(spark))
    assert key.count() == 2 and groups.count() == 2
    assert incs.count() == 200  # two groups x ages 1..100 (age 0 dropped, B10)
    row = groups.first().asDict()
    assert row["area"] == 1 and row["sw_hw"] == 0 and row["delay"] == 0 and row["historical_disturbance_type"] == 1


def test_disturbed_groups_restart_and_tables_stay_aligned(spark):
    inputs = _inputs(spark)
    key = spark.createDataFrame([(1, 1, 1, 7), (2, 2, 2, 7), (3, 3, 3, None), (4, 4, 2, None)],
                                "cohortID long, pixelIndex long, row_idx long, disturbance_type_id int")
    state = spark.createDataFrame([(i, "Saskatchewan", 9, 1, 10, 0) for i in (1, 2, 3)],
                                  "row_idx long, admin_name string, eco_id int, gcID int, age int, delay int")
    pools = spark.createDataFrame([(1, 5.0, 4.0), (2, 5.0, 4.0), (3, 5.0, None)], "row_idx long, Input double, Merch double")
    t = an.prepare_groups(CarbonTables(key=key, parameters=state.select("row_idx"), state=state, pools=pools), inputs, ["gcID"])
    ids = {r["cohortID"]: r["row_idx"] for r in t.key.collect()}
    assert ids == {1: 4, 2: 4, 3: 3, 4: 2}  # equal parents merge; group 1 is gone
    for table in (t.state, t.pools, t.parameters):
        assert sorted(r["row_idx"] for r in table.collect()) == [2, 3, 4]
    assert {r["row_idx"]: (r["disturbance_type"], r["age"], r["merch_inc"]) for r in t.parameters.collect()} == {
        2: (0, 10, 10 / 128), 3: (0, 10, 10 / 128), 4: (7, 1, 1 / 128)}
    assert {r["row_idx"]: (r["Input"], r["Merch"]) for r in t.pools.collect()} == {2: (5.0, 4.0), 3: (5.0, None), 4: (1.0, 4.0)}


def test_all_tables_of_the_panel_hold_the_same_groups(spark):
    names = ("key", "state", "pools", "flux", "parameters")
    ids = {n: {tuple(r) for r in QUERIES[f"prepare_groups_{n}"](spark, SF_SMALL).select("year", "row_idx").distinct().collect()}
           for n in names}
    assert all(ids[n] == ids["key"] for n in names)


def test_fixtures_hold_the_cases_that_could_fail(spark):
    q = {n: QUERIES[n](spark, SF_SMALL) for n in ("union_fill", "drop_inactive", "split_disturbed", "orphans", "group_area",
                                                   "flux_totals", "products_stock", "emissions_products", "age_panel", "decay_rates")}
    assert q["drop_inactive"].count() < q["union_fill"].count()
    parents = q["split_disturbed"].groupBy("year", "row_idx").agg(F.count_distinct("row_idx_prev").alias("n"))
    assert parents.where("n > 1").count() > 0
    assert q["orphans"].where("n = 0").count() == 0
    assert 0 < q["group_area"].where("area_ha IS NULL").count() < q["group_area"].count()
    assert q["flux_totals"].where("DisturbanceBioCO2Emission IS NULL").count() == 1
    assert q["products_stock"].where("products_stock IS NULL").count() == 1
    assert q["emissions_products"].where("Products IS NULL AND CO2 IS NULL").count() == 1
    assert q["age_panel"].agg(F.max(F.col("year") - F.col("last_event_year"))).first()[0] >= 8
    assert q["decay_rates"].where("decay_rate IS NULL").count() > 0


def test_untouched_rows_are_not_shuffled_by_the_key_update(spark):
    from sylva.operators import groups as gr
    from sylva.plans import catalog as c
    from sylva.sources.fixtures import Fixtures
    marked, split = c._split(Fixtures(spark, SF_SMALL))
    plan = gr.apply_split_to_key(marked, split, ("year",))._jdf.queryExecution().executedPlan()
    union = plan.toString()
    branches = union.split("Union")[1].split("+- ")
    first = union[union.index("Union"):].split("isnull(disturbance_type_id")[0]
    assert "Exchange" not in first and len(branches) > 1


@pytest.mark.parametrize("wipe", [False, True])
def test_a_used_store_is_refused_or_wiped(spark, tmp_path, wipe):
    from sylva.sources import snapshots as sn
    root = str(tmp_path / "run")
    df = spark.createDataFrame([(1, 1), (2, 1)], "year int, row_idx long")
    sn.open_store(spark, root)
    sn.write_panel(df, root, "key")
    if wipe:
        sn.open_store(spark, root, wipe=True)
        assert sn.written_years(spark, root, "key") == []
    else:
        with pytest.raises(ValueError, match="earlier run"):
            sn.open_store(spark, root)


def test_years_are_read_alone_and_written_in_few_files(spark, tmp_path):
    from sylva.sources import snapshots as sn
    root = str(tmp_path / "run")
    panel = spark.range(20_000).select((F.col("id") % 5 + 1).cast("int").alias("year"), "id", F.lit(1.0).alias("Products")).repartition(16)
    sn.write_panel(panel, root, "pools")
    sn.write_snapshot({"pools": spark.range(3).select("id")}, root, 0, spinup=True)
    for y in range(1, 6):
        assert len(list((tmp_path / "run" / "pools").glob(f"write=*/year={y}/*.parquet"))) <= 2
    got = sn.read_snapshots(spark, root, "pools", [0, 3])
    assert {r["year"] for r in got.select("year").distinct().collect()} == {0, 3}
    assert got.where("year = 0 AND Products IS NULL").count() == 3
    assert "year=1" not in str(got.inputFiles())


def test_group_tables_do_not_store_the_key(spark):
    from sylva.operators import groups as gr
    inputs = _inputs(spark)
    key = spark.createDataFrame([(1, 1, 1, 7), (2, 2, 1, 7), (3, 3, 1, None), (4, 4, 2, None)],
                                "cohortID long, pixelIndex long, row_idx long, disturbance_type_id int")
    counts = {(r["row_idx"], r["disturbance_type_id"]): (r["first_cohort"], r["n"]) for r in gr.group_counts(key).collect()}
    assert counts == {(1, 7): (1, 2), (1, None): (3, 1), (2, None): (4, 1)}
    state = spark.createDataFrame([(i, "Saskatchewan", 9, 1, 10, 0) for i in (1, 2)],
                                  "row_idx long, admin_name string, eco_id int, gcID int, age int, delay int")
    pools = spark.createDataFrame([(1, 5.0), (2, 6.0)], "row_idx long, Input double")
    t = an.prepare_groups(CarbonTables(key=key, parameters=state.select("row_idx"), state=state, pools=pools), inputs, ["gcID"])
    assert sorted(r["row_idx"] for r in t.pools.collect()) == [1, 2, 3]
    assert "key" not in t.__dict__ and "marked" not in t.__dict__ and t.flux is None
    whole = t.tables()
    assert {r["cohortID"]: r["row_idx"] for r in whole.key.collect()} == {1: 3, 2: 3, 3: 1, 4: 2}
    assert whole.parameters.count() == whole.state.count() == 3


def test_tables_without_years_hold_for_every_year_of_a_panel(spark):
    inputs = _inputs(spark)
    key = spark.createDataFrame([(1, 1, 1, 7, 1), (2, 2, 2, None, 1), (1, 1, 1, None, 2)],
                                "cohortID long, pixelIndex long, row_idx long, disturbance_type_id int, year int")
    state = spark.createDataFrame([(i, "Saskatchewan", 9, 1, 10, 0) for i in (1, 2)],
                                  "row_idx long, admin_name string, eco_id int, gcID int, age int, delay int")
    pools = spark.createDataFrame([(1, 5.0), (2, 6.0)], "row_idx long, Input double")
    t = an.prepare_groups(CarbonTables(key=key, parameters=state.select("row_idx"), state=state, pools=pools), inputs, ["gcID"], ("year",))
    want = {(1, 2), (1, 3), (2, 1)}
    for table in (t.key, t.state, t.pools, t.parameters):
        assert {(r["year"], r["row_idx"]) for r in table.collect()} == want
    assert {(r["year"], r["row_idx"]): r["Input"] for r in t.pools.collect()} == {(1, 2): 6.0, (1, 3): 1.0, (2, 1): 5.0}
