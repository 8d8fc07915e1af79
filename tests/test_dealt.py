"""Tables dealt by the rows that they hold: a task's memory does not grow with the input."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from sylva.operators import groups as gr
from sylva.operators import growth as gw
from sylva.operators import heavy
from sylva.operators import reports as rp
from sylva.operators import transfers as tr
from sylva.plans.catalog import QUERIES
from sylva.sources import fixtures as fxm

Y = ("year",)


def _plan(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


def _shuffles(df) -> list[str]:
    return re.findall(r"Exchange ((?:hash|range|roundrobin)partitioning\(.*?\)|SinglePartition), (\w+)", re.sub(r"#\d+L?", "", _plan(df)))


@pytest.fixture()
def folder(spark, tmp_path):
    """Lines and orders with repeated keys, unknown keys and lines without an order."""
    day = dt.datetime(1995, 5, 1)
    lines = [(k if k % 41 else None, k % 7, k % 5, float(k % 8), day.replace(year=1995 + k % 6)) for k in (i % 300 for i in range(2000))]
    orders = [(k if k % 37 else None, k % 50) for k in (i % 280 for i in range(400))]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_suppkey long, l_quantity double, l_shipdate timestamp") \
        .write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    return str(tmp_path)


def _rows(df) -> list[str]:
    return sorted(map(str, df.collect()))


def test_tables_are_dealt_by_their_rows_and_stay_the_same(spark, folder, monkeypatch):
    made = {}
    for limit in (10_000, 50):
        monkeypatch.setattr(fxm, "ROWS_PER_TASK", limit)
        fx = fxm.Fixtures(spark, folder)
        assert fx.tasks == (None if limit == 10_000 else max(40, spark.sparkContext.defaultParallelism))
        made[limit] = {name: _rows(getattr(fx, name)) for name in ("key", "pools", "flux", "state")}
        made[limit]["census"] = _rows(gr.group_census(fx.key, Y))
        made[limit]["npp"] = _rows(rp.npp_by_stand(fx.key, fx.flux, Y))
    assert made[50] == made[10_000] and all(made[50].values())
    for table, by in ((fx.key, "cohortID"), (fx.flux, "year, row_idx"), (fx.pools, "row_idx"), (fx.state, "row_idx")):
        assert (f"hashpartitioning({by}, {fx.tasks})", "REPARTITION_BY_NUM") in _shuffles(table)


def test_transfers_leave_the_pools_where_they_lie(spark):
    pools = spark.createDataFrame([(y, g, 1.0 * g, 2.0) for y in (1, 2) for g in range(30)], "year int, row_idx long, Merch double, Foliage double") \
        .repartition(7, "row_idx")
    long = rp.pools_long(pools).selectExpr("*", "cast(row_idx % 3 as int) as disturbance_type_id")
    matrix = spark.createDataFrame([(1, "Merch", "CO2", 0.5), (1, "Merch", "Products", 0.5)], "disturbance_type_id int, source string, sink string, proportion double")
    names = spark.createDataFrame([("Merch", "CO2", "Emission")], "source string, sink string, flux string")
    units = spark.createDataFrame([(g, g % 2) for g in range(30)], "row_idx long, spatial_unit_id int").repartition(7, "row_idx")
    warm = spark.createDataFrame([(0, 1.0), (1, 4.0)], "spatial_unit_id int, mean_annual_temperature double")
    decay = spark.createDataFrame([("Merch", 0.5, 1.0, 2.0)], "pool string, base_rate double, ref_temp double, q10 double")
    inc = spark.createDataFrame([(g, -0.5, 0.5, -0.25) for g in range(20)], "row_idx long, merch_inc double, foliage_inc double, other_inc double").repartition(7, "row_idx")
    turnover = spark.createDataFrame([("Merch", "StemSnags", 1.0)], "source string, sink string, proportion double")
    for out in (tr.apply_transfers(long, matrix), tr.transfer_flux(long, matrix, names), tr.temp_modifiers(long, units, warm, decay),
                tr.overmature_decline(pools, inc, turnover)):
        dealt = [x for x in _shuffles(out) if re.search(r"row_idx|pool|source", x[0]) and x[1] == "ENSURE_REQUIREMENTS"]
        of_dimensions = [x for x in dealt if "row_idx" not in x[0]]
        assert not [x for x in dealt if x not in of_dimensions], _plan(out)
        assert "SortMergeJoin [source" not in _plan(out) and "SortMergeJoin [disturbance" not in _plan(out)
        assert out.count() > 0


def test_decline_with_repeated_missing_and_unknown_increments(spark):
    pools = spark.createDataFrame([(1, 1, 8.0, 1.0), (1, 2, 8.0, None), (1, 3, 8.0, 1.0), (None, None, 4.0, 1.0)],
                                  "year int, row_idx long, Merch double, Foliage double")
    inc = spark.createDataFrame([(1, -1.0, None, 0.5), (1, -2.0, -0.5, None), (2, 1.0, -1.0, -1.0), (None, -1.0, -1.0, -1.0)],
                                "row_idx long, merch_inc double, foliage_inc double, other_inc double")
    turnover = spark.createDataFrame([("Merch", "StemSnags", 0.75), ("Merch", "Merch", 0.25), ("Foliage", "Litter", 1.0)],
                                     "source string, sink string, proportion double")
    out = {(r["row_idx"], r["pool"]): r["value"] for r in tr.overmature_decline(pools, inc, turnover).collect()}
    assert out == {
        (1, "Merch"): 8.0 - 3.0 + 0.75, (1, "Foliage"): 0.5, (1, "Other"): 0.0, (1, "StemSnags"): 2.25, (1, "Litter"): 0.5,
        (2, "Merch"): 8.0, (2, "Foliage"): None, (2, "Other"): -1.0, (2, "StemSnags"): 0.0, (2, "Litter"): 1.0, (2, tr.UNMAPPED): 1.0,
        (3, "Merch"): 8.0, (3, "Foliage"): 1.0, (3, "Other"): 0.0,
        (None, "Merch"): 4.0, (None, "Foliage"): 1.0, (None, "Other"): 0.0}


def _coalescible(df) -> list[str]:
    """Columns of the shuffles that run-time coalescing may give to one task per core."""
    return [x for x, origin in _shuffles(df) if origin != "REPARTITION_BY_NUM"]


def test_sums_by_group_and_stand_have_tasks_by_rows(spark, folder, monkeypatch):
    monkeypatch.setattr(fxm, "ROWS_PER_TASK", 50)
    fx = fxm.Fixtures(spark, folder)
    plain = fxm.Fixtures(spark, folder)
    plain.tasks = None
    rows = {}
    for f in (fx, plain):
        rows[f.tasks] = [gr.group_census(f.group_key, Y), rp.npp_by_year(f.group_key, f.flux, Y),
                         rp.npp_by_stand(f.group_key, f.flux, Y, tasks=f.tasks), rp.total_carbon_by_stand(f.group_key, f.group_pools, Y, tasks=f.tasks)]
    for many, few in zip(rows[fx.tasks], rows[None]):
        assert _rows(many) == _rows(few) and _rows(few)
        assert not [x for x in _coalescible(many) if re.search("row_idx|pixelIndex", x)], _plan(many)
        assert [x for x in _coalescible(few) if re.search("row_idx|pixelIndex", x)]


@pytest.mark.parametrize("tasks", [None, 9])
def test_shared_areas_shuffle_the_key_once(spark, tasks):
    """Stands that come twice, cohorts that come twice, unknown stands, years and areas."""
    key = spark.createDataFrame([(1, 1, 1, 1), (1, 2, 1, 2), (1, 2, 1, 2), (2, 1, 1, 1), (None, 3, 1, 1), (1, 4, None, 2), (1, 5, 9, 2), (1, 6, 2, 3), (1, 7, 3, 3)],
                                "year int, cohortID long, pixelIndex long, row_idx long")
    stands = spark.createDataFrame([(1, 900.0), (1, 300.0), (2, None), (3, 600.0), (None, 100.0)], "pixelIndex long, area double")
    out = rp.shared_areas(key, stands, Y, tasks)
    assert out.columns == ["year", "pixelIndex", "cohortID", "row_idx", "area"]
    assert _rows(out.select("year", "cohortID", "row_idx", "area")) == sorted(
        f"Row(year={y}, cohortID={c}, row_idx={g}, area={a})" for y, c, g, a in (
            (1, 1, 1, 300.0), (1, 1, 1, 100.0), (1, 2, 2, 300.0), (1, 2, 2, 100.0), (1, 2, 2, 300.0), (1, 2, 2, 100.0),
            (2, 1, 1, 900.0), (2, 1, 1, 300.0), (1, 6, 3, None), (1, 7, 3, 600.0)))
    if tasks:
        assert _shuffles(out) == [(f"hashpartitioning(pixelIndex, {tasks})", "REPARTITION_BY_NUM")] * 2


def test_split_join_is_dealt_by_its_rows(spark, monkeypatch):
    big = spark.range(4000).select(F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 100 != 1, F.col("id")).alias("k"), F.col("id").alias("t"))
    small = spark.range(0, 4000, 2).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    monkeypatch.setattr(heavy, "ROWS_PER_TASK", 100)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for how in ("inner", "left"):
            out = heavy.split_join(big, small, ["k"], how)
            assert _rows(out) == _rows(big.join(small, "k", how))
            assert ("hashpartitioning(k, 40)", "REPARTITION_BY_NUM") in _shuffles(out)
            assert not [x for x in _coalescible(out) if "k," in x], _plan(out)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_heavy_keys_are_those_that_reach_the_limit(spark):
    table = spark.range(3000).select((F.col("id") % 2).cast("int").alias("a"), F.expr("cast(sqrt(id) as int)").alias("b"))
    for limit, buckets in ((1, 4), (40, 4), (40, 4096), (55, 64), (10_000, 64)):
        exact = heavy.key_counts(table, ["a", "b"]).where(F.col("__n") >= limit).select("a", "b")
        assert _rows(heavy.heavy_keys(table, ["a", "b"], limit, buckets)) == _rows(exact)


def test_curves_are_joined_where_the_state_lies(spark):
    meta = spark.createDataFrame([(1, "x", 1, "s"), (2, "y", None, "s")], "gcID int, admin_name string, eco_id int, species string")
    inc = spark.createDataFrame([(1, 1, 1.0, 2.0, 3.0), (1, 2, 4.0, 5.0, 6.0), (2, 1, 7.0, None, 9.0)],
                                "gcID int, age int, merch_inc double, foliage_inc double, other_inc double")
    state = spark.createDataFrame([(1, "x", 1, "s", 9), (2, "y", None, "s", 1), (3, "z", 1, "s", 1), (4, "x", 1, "s", None), (5, "x", 1, "s", 0)],
                                  "row_idx long, admin_name string, eco_id int, species string, age int").repartition(7, "row_idx")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = gw.annual_increments(state, meta, inc, ["species"])
        assert "SortMergeJoin" not in _plan(out)
        assert {r["row_idx"]: (r["merch_inc"], r["foliage_inc"]) for r in out.collect()} == {1: (4.0, 5.0), 2: (7.0, None), 4: (None, None), 5: (None, None)}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _whole_query(spark, folder, monkeypatch, name):
    """A registered query has the same rows however its tables are dealt, and no shuffle of cohorts, groups or pools whose number
    of tasks run-time coalescing may lower."""
    spark.createDataFrame([(n, f"N{n}", n % 3) for n in range(8)], "n_nationkey int, n_name string, n_regionkey int").write.parquet(f"{folder}/nation.parquet")
    rows = {}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for limit in (10_000, 50):
            monkeypatch.setattr(fxm, "ROWS_PER_TASK", limit)
            rows[limit] = _rows(QUERIES[name](spark, folder))
        out = QUERIES[name](spark, folder)
        assert rows[50] == rows[10_000] and rows[50]
        assert not [x for x in _coalescible(out) if re.search("row_idx|cohortID|pool|disturbance_type_id|spatial_unit_id", x)], _plan(out)
        assert ("hashpartitioning(row_idx, 40)", "REPARTITION_BY_NUM") in _shuffles(out)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_temp_modifier_has_tasks_by_rows(spark, folder, monkeypatch):
    _whole_query(spark, folder, monkeypatch, "temp_modifier")


def test_transfer_flux_has_tasks_by_rows(spark, folder, monkeypatch):
    _whole_query(spark, folder, monkeypatch, "transfer_flux")
