"""Transfers inside the row and products of matrices, against the long operators and by hand; guards
of the joins with dimensions (Q6, Q17)."""

import random

import pytest
from pyspark.sql import functions as F

from sylva.functions.columns import null_safe_join, unique_rows
from sylva.operators import attributes as at
from sylva.operators import growth as gw
from sylva.operators import reports as rp
from sylva.operators import transfers as tr

POOLS = ("A", "B", "C")
MATRIX = "kind int, source string, sink string, proportion double"


def _pools(spark, n=40, seed=1):
    rng = random.Random(seed)
    value = lambda: rng.choice([None, 0.0, 1.0, rng.randrange(64) / 4])
    return spark.createDataFrame([(y, i, *[value() for _ in POOLS], rng.choice([1, 2, 3, None])) for y in (1, 2) for i in range(n)],
                                 "year int, row_idx long, A double, B double, C double, kind int")


def _random_matrix(rng, kinds=(1, 2)):
    rows = []
    for k in kinds:
        for source in POOLS:
            if rng.random() < 0.7:
                sinks = rng.sample([*POOLS, "out"], rng.randint(1, 3))
                rows += [(k, source, s, w) for s, w in zip(sinks, {1: (1.0,), 2: (0.25, 0.75), 3: (0.25, 0.25, 0.5)}[len(sinks)])]
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_wide_equals_long(spark, seed):
    pools = _pools(spark, seed=seed)
    m = spark.createDataFrame(_random_matrix(random.Random(seed)), MATRIX)
    long = {(r["year"], r["row_idx"], r["pool"]): r["value"] for r in tr.apply_transfers(
        rp.pools_long(pools.drop("kind")).join(pools.select("year", "row_idx", "kind"), ["year", "row_idx"]), m, "kind").collect()}
    wide = tr.apply_transfers_wide(pools, m, "kind")
    assert wide.columns[:6] == pools.columns
    rows = wide.collect()
    assert len(rows) == pools.count()
    for r in rows:
        for p in set(wide.columns) - {"year", "row_idx", "kind"}:
            assert r[p] == long.get((r["year"], r["row_idx"], p), 0.0)


def test_no_shuffle_above_the_matrix_join(spark, tmp_path):
    _pools(spark).write.parquet(str(tmp_path / "pools"))
    m = spark.createDataFrame(_random_matrix(random.Random(1)), MATRIX)
    plan = tr.apply_transfers_wide(spark.read.parquet(str(tmp_path / "pools")), m, "kind")._jdf.queryExecution().executedPlan().toString()
    above = plan.split("Join")[0]
    assert "Join" in plan and "Exchange" not in above


def test_flux_names(spark):
    pools = spark.createDataFrame([(1, 1, 4.0, 2.0, 1), (1, 2, None, 8.0, 1), (1, 3, 1.0, 1.0, 7)], "year int, row_idx long, A double, B double, kind int")
    m = spark.createDataFrame([(1, "A", "x", 0.5), (1, "A", "A", 0.5), (1, "B", "x", 0.25), (1, "B", "y", 0.75)], MATRIX)
    names = spark.createDataFrame([("A", "x", "toX"), ("B", "x", "toX")], "source string, sink string, flux string")
    got = {r["row_idx"]: (r["toX"], r[tr.UNMAPPED]) for r in tr.transfer_flux_wide(pools, m, names, "kind").collect()}
    assert got == {1: (2.5, 1.5), 2: (None, 6.0), 3: (0.0, 0.0)}
    with pytest.raises(ValueError, match="more than one flux name"):
        tr.transfer_flux_wide(pools, m, names.union(names.select("source", "sink", F.lit("other"))), "kind")


def test_matrices_per_group_and_year(spark):
    pools = spark.createDataFrame([(y, i, 4.0) for y in (1, 2) for i in (1, 2)], "year int, row_idx long, A double")
    m = spark.createDataFrame([(1, 1, "A", "B", 1.0), (2, 1, "A", "B", 0.5), (2, 1, "A", "A", 0.5)],
                              "year int, row_idx long, source string, sink string, proportion double")
    got = {(r["year"], r["row_idx"]): (r["A"], r["B"]) for r in tr.apply_transfers_wide(pools, m, "row_idx").collect()}
    assert got == {(1, 1): (0.0, 4.0), (1, 2): (4.0, 0.0), (2, 1): (2.0, 2.0), (2, 2): (4.0, 0.0)}


@pytest.mark.parametrize("seed", range(3))
def test_a_product_equals_its_factors_in_turn(spark, seed):
    rng = random.Random(seed)
    names = (*POOLS, "out")
    kinds = spark.createDataFrame([(1,), (2,), (3,)], "kind int")  # 3 has no matrix of its own
    one, two = (spark.createDataFrame(_random_matrix(rng), MATRIX) for _ in range(2))
    every = spark.createDataFrame([r[1:] for r in _random_matrix(rng, (1,))] or [("A", "A", 1.0)], "source string, sink string, proportion double")
    factors = [tr.complete(one, names, kinds), tr.complete(every, names), tr.complete(two, names, kinds)]
    product = tr.compose(tr.compose(factors[0], factors[1], ["kind"]), factors[2], ["kind"])
    pools = _pools(spark, seed=seed).where("kind IS NOT NULL").withColumn("out", F.lit(1.0)).fillna(2.0, ["A", "B", "C"])
    in_turn = tr.apply_transfers_wide(pools, one, "kind")
    in_turn = tr.apply_transfers_wide(in_turn.withColumn("all", F.lit(0)), every.withColumn("all", F.lit(0)), "all", pool_names=names).drop("all")
    in_turn = tr.apply_transfers_wide(in_turn, two, "kind", pool_names=names)
    at_once = tr.apply_transfers_wide(pools, tr.conserving(product, ["kind"]), "kind", pool_names=names)
    key = ["year", "row_idx", "kind", *names]
    assert sorted(map(tuple, in_turn.select(key).collect())) == sorted(map(tuple, at_once.select(key).collect()))


def test_leaks_raise(spark):
    leaky = spark.createDataFrame([(1, "A", "B", 0.5)], MATRIX)
    with pytest.raises(Exception, match="do not add up to 1: 1, A"):
        tr.conserving(leaky, ["kind"]).collect()
    with pytest.raises(Exception, match="do not add up to 1"):
        tr.compose(leaky, leaky, ["kind"]).collect()
    whole = spark.createDataFrame([(1, "A", "B", 1.0)], MATRIX)
    with pytest.raises(Exception, match="no row for the pool B"):
        tr.compose(whole, whole, ["kind"]).collect()


def test_mixing_and_decline_equal_the_long_forms(spark):
    pools = _pools(spark).drop("kind")
    long = {(r["year"], r["row_idx"], r["pool"]): r["value"] for r in tr.slow_mixing(rp.pools_long(pools), 0.25, "A", "D").collect()}
    for r in tr.slow_mixing_wide(pools, 0.25, "A", "D").collect():
        assert all(r[p] == long.get((r["year"], r["row_idx"], p), 0.0) for p in "ABCD")
    pools = pools.withColumnRenamed("A", "Merch").withColumnRenamed("B", "Foliage")
    inc = spark.createDataFrame([(i, -0.5 * (i % 3), 0.25, -0.125) for i in range(40)], "row_idx long, merch_inc double, foliage_inc double, other_inc double")
    turnover = spark.createDataFrame([("Merch", "C", 0.5), ("Merch", "Litter", 0.5)], "source string, sink string, proportion double")
    long = {(r["year"], r["row_idx"], r["pool"]): r["value"] for r in tr.overmature_decline(pools, inc, turnover).collect()}
    wide = tr.overmature_decline_wide(pools, inc, turnover)
    for r in wide.collect():
        for p in set(wide.columns) - {"year", "row_idx"}:
            assert r[p] == long.get((r["year"], r["row_idx"], p), 0.0), p


def test_site_from_the_spatial_unit(spark):
    inc = spark.createDataFrame([(1, 1, 1.0, 0.0, 0.0), (2, 1, 2.0, 0.0, 0.0)], "gcID int, age int, merch_inc double, foliage_inc double, other_inc double")
    meta = spark.createDataFrame([(1, "P", 1, "x", True), (2, "Q", 1, "x", True)], "gcID int, admin_name string, eco_id int, sp string, sw boolean")
    units = spark.createDataFrame([(7, "P", 1), (8, "Q", 1)], "spatial_unit_id int, admin_name string, eco_id int")
    state = spark.createDataFrame([(1, 7, "x", 1), (2, 8, "x", 1), (3, 9, "x", 1), (4, None, "x", 1)], "row_idx long, spatial_unit_id int, sp string, age int")
    got = sorted((r["row_idx"], r["gcID"], r["merch_inc"]) for r in gw.annual_increments(state, meta, inc, units=units).collect())
    assert got == [(1, 1, 1.0), (2, 2, 2.0)]  # one row per group, none from a unit that nobody knows
    with pytest.raises(ValueError, match="needs the table of spatial units"):
        gw.annual_increments(state, meta, inc)
    with pytest.raises(ValueError, match="no site"):
        gw.annual_increments(state.drop("spatial_unit_id"), meta, inc, units=units)
    with pytest.raises(Exception, match="spatial units repeats the key"):
        gw.annual_increments(state, meta, inc, units=units.union(units.limit(1))).collect()
    with pytest.raises(Exception, match="growth curve metadata repeats the key"):
        gw.annual_increments(state, meta.union(meta.limit(1)), inc, units=units).collect()


def test_dimensions_may_not_repeat_a_key(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (2, "c")], "k int, v string")
    assert sorted(map(tuple, unique_rows(df, "things", ["k"]).collect()), key=str) == [(1, "a"), (2, "c"), (None, "b")]
    twice = df.union(df.where("k IS NULL"))
    with pytest.raises(Exception, match="NULL"):
        unique_rows(twice, "things", ["k"]).select("k").collect()
    with pytest.raises(ValueError, match="needs a key"):
        null_safe_join(df, df, [])
    groups = spark.createDataFrame([(1, 5)], "row_idx long, spatial_unit_id int")
    units = spark.createDataFrame([(5, 1.0), (5, 2.0)], "spatial_unit_id int, mean_annual_temperature double")
    with pytest.raises(Exception, match="spatial units repeats"):
        at.attach_spatial_unit(groups, units).collect()
