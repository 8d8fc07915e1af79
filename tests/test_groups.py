"""Cohort groups and the yearly split on hand-made frames (Q7, Q8, Q10) and invariants."""

import math

from pyspark.sql import functions as F

from sylva.operators import groups as gr
from sylva.operators.ids import number_groups


def test_nulls_are_values_and_ids_follow_first_cohort(spark):
    cs = spark.createDataFrame(
        [(5, 1, "a", None), (1, 2, "b", 3), (2, 3, "a", None), (3, 4, None, 3), (4, 5, None, 3)],
        "cohortID long, pixelIndex long, sp string, delay int")
    key, groups = gr.cohort_groups(cs)
    k = {r["cohortID"]: r["row_idx"] for r in key.collect()}
    # groups by first cohortID: (b,3) <- 1, (a,null) <- 2, (null,3) <- 3
    assert k == {1: 1, 2: 2, 5: 2, 3: 3, 4: 3}
    assert groups.count() == 3


def test_number_groups_is_independent_of_partitioning(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("first"), (F.col("id") % 3).alias("b"))
    a = {r["first"]: r["row_idx"] for r in number_groups(df.repartition(1), ["first"]).collect()}
    b = {r["first"]: r["row_idx"] for r in number_groups(df.repartition(13), ["first"], by=()).collect()}
    assert a == b and sorted(a.values()) == list(range(1, 5001))
    c = number_groups(df.repartition(7), ["first"], start=100, by=["b"]).collect()
    for bv in range(3):
        ids = sorted(r["row_idx"] for r in c if r["b"] == bv)
        assert ids == list(range(101, 101 + len(ids)))


def _tables(spark, pools_rows):
    key = spark.createDataFrame(
        [(1, 1, 1, 7), (2, 2, 1, 7), (3, 3, 2, 7), (4, 4, 3, 7), (5, 5, 3, None), (6, 6, 4, 7)],
        "cohortID long, pixelIndex long, row_idx long, disturbance_type_id int")
    state = spark.createDataFrame([(1, 10, 0), (2, 10, 0), (3, 20, 0), (4, 10, 0)],
                                  "row_idx long, age int, delay int")
    pools = spark.createDataFrame(pools_rows, "row_idx long, Input double, Merch double")
    return key, state, pools


def test_split_merges_parents_with_equal_values(spark):
    # groups 1 and 2 share every value: their disturbed cohorts merge into one new group,
    # which takes the rest from the first parent (Q8); ids start after the greatest live id
    key, state, pools = _tables(spark, [(1, 1.0, 4.0), (2, 1.0, 4.0), (3, 1.0, 4.0), (4, 1.0, 2.0)])
    split = gr.split_disturbed(key, state, pools)
    new = gr.apply_split_to_key(key, split)
    got = {r["cohortID"]: (r["row_idx_prev"], r["row_idx"]) for r in new.collect()}
    assert got[1][1] == got[2][1] == got[3][1] == 5  # parents 1 and 2 merge
    assert got[4][1] == 6 and got[6][1] == 7
    assert got[5] == (3, 3)  # undisturbed keeps its group
    reps = {r["row_idx"]: (r["row_idx_prev"], r["disturbance_type"]) for r in split.new_groups.collect()}
    assert reps == {5: (1, 7), 6: (3, 7), 7: (4, 7)}


def test_negative_zero_and_nan_pools_group_together(spark):
    key, state, pools = _tables(spark, [(1, 1.0, -0.0), (2, 1.0, 0.0), (3, 1.0, math.nan), (4, 1.0, math.nan)])
    state = spark.createDataFrame([(1, 10, 0), (2, 10, 0), (3, 10, 0), (4, 10, 0)], "row_idx long, age int, delay int")
    split = gr.split_disturbed(key, state, pools)
    ids = {r["cohortID"]: r["row_idx"] for r in gr.apply_split_to_key(key, split).collect()}
    assert ids[1] == ids[2] == ids[3]  # -0.0 (group 1) and 0.0 (group 2) are equal
    assert ids[4] == ids[6]  # NaN (group 3) equals NaN (group 4)
    assert ids[1] != ids[4]


def test_clone_reset_union_and_drop_keep_tables_aligned(spark):
    key, state, pools = _tables(spark, [(1, 1.0, 4.0), (2, 1.0, 4.0), (3, 1.0, 4.0), (4, 1.0, 2.0)])
    split = gr.split_disturbed(key, state, pools)
    k2 = gr.apply_split_to_key(key, split)
    st = gr.union_fill(state, gr.reset_disturbed_state(gr.clone_group_rows(split.new_groups, state)))
    pl = gr.union_fill(pools, gr.reset_disturbed_pools(gr.clone_group_rows(split.new_groups, pools)))
    pa = gr.parameters_from_state(state.select("row_idx"), st, split.new_groups)
    st, pl, pa = (gr.drop_inactive(t, k2) for t in (st, pl, pa))
    live = {r["row_idx"] for r in k2.collect()}
    for t in (st, pl, pa):
        assert {r["row_idx"] for r in t.collect()} == live
    new_state = {r["row_idx"]: r for r in st.collect()}
    assert new_state[5]["age"] == 1 and new_state[5]["time_since_last_disturbance"] is None
    assert new_state[3]["time_since_last_disturbance"] is None  # absent before: NULL after union (F2)
    assert {r["row_idx"]: r["disturbance_type"] for r in pa.collect()} == {3: 0, 5: 7, 6: 7, 7: 7}
    # cohorts conserved
    assert k2.count() == key.count()


def test_census(spark):
    key = spark.createDataFrame([(1, 1), (2, 1), (3, 4)], "cohortID long, row_idx long")
    r = gr.group_census(key).collect()[0]
    assert (r["n_groups"], r["max_row_idx"], r["n_cohorts"], r["max_group_cohorts"]) == (2, 4, 3, 2)
