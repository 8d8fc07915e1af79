"""Event resolution on hand-made frames."""

import pytest

from sylva.operators import events as ev

EV = "pixelIndex long, year int, eventID int"
META = "eventID int, disturbance_type_id int, priority int"


def _resolve(spark, events, meta, meta_schema=META, by=("year",)):
    e = spark.createDataFrame(events, EV)
    m = spark.createDataFrame(meta, meta_schema)
    return {(r["pixelIndex"], r["year"]): (r["eventID"], r["disturbance_type_id"])
            for r in ev.resolve_events(ev.type_events(e, m), by=by).collect()}


def test_null_priority_wins(spark):
    got = _resolve(spark, [(1, 2000, 1), (1, 2000, 2)], [(1, 10, 1), (2, 20, None)])
    assert got[(1, 2000)] == (2, 20)


def test_lowest_priority_then_lowest_event(spark):
    got = _resolve(spark, [(1, 2000, 3), (1, 2000, 2), (1, 2000, 1), (2, 2000, 2)],
                   [(1, 10, 5), (2, 20, 1), (3, 30, 1)])
    assert got[(1, 2000)] == (2, 20)
    assert got[(2, 2000)] == (2, 20)


def test_unknown_event_competes_and_means_undisturbed(spark):
    # eventID 9 has no metadata: NULL type and NULL priority, so it wins (Q2)
    got = _resolve(spark, [(1, 2000, 1), (1, 2000, 9)], [(1, 10, 1)])
    assert got[(1, 2000)] == (9, None)


def test_duplicates_without_priority_are_an_error(spark):
    with pytest.raises(ValueError, match="Two or more events"):
        _resolve(spark, [(1, 2000, 1), (1, 2000, 1)], [(1, 10)], "eventID int, disturbance_type_id int")


def test_single_events_without_priority(spark):
    got = _resolve(spark, [(1, 2000, 1), (2, 2000, 1)], [(1, 10)], "eventID int, disturbance_type_id int")
    assert got == {(1, 2000): (1, 10), (2, 2000): (1, 10)}


def test_year_filter_casts(spark):
    e = spark.createDataFrame([(1, 2000.0, 1), (1, 2001.0, 1)], "pixelIndex long, year double, eventID int")
    assert ev.year_filter(e, 2000).count() == 1


def test_whole_stand_marking_and_empty_year(spark):
    key = spark.createDataFrame([(1, 1, 1), (2, 1, 1), (3, 2, 1)], "cohortID long, pixelIndex long, row_idx long")
    e = spark.createDataFrame([(1, 2000, 1)], EV)
    m = spark.createDataFrame([(1, 10, 1)], META)
    marked = {r["cohortID"]: r["disturbance_type_id"]
              for r in ev.prep_disturbances(key, e, m, year=2000).collect()}
    assert marked == {1: 10, 2: 10, 3: None}
    none = ev.prep_disturbances(key, e, m, year=2001).collect()
    assert all(r["disturbance_type_id"] is None for r in none)
    assert all(r["disturbance_type_id"] is None for r in ev.prep_disturbances(key, None, None, 2000).collect())


def test_window_group_limit_before_shuffle(spark):
    e = spark.createDataFrame([(1, 2000, 1)], EV)
    m = spark.createDataFrame([(1, 10, 1)], META)
    plan = ev.resolve_events(ev.type_events(e, m))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_age_panel_matches_reference_expectations(spark):
    # events in 2000 for two stands; delay 0 and 2 -> ages 3 and 1 at the end of 2002
    winners = spark.createDataFrame([(1, 2000, 1, 1), (2, 2000, 1, 1)],
                                    "pixelIndex long, year int, eventID int, disturbance_type_id int")
    cohorts = spark.createDataFrame([(1, 1, 0), (2, 2, 2)], "cohortID long, pixelIndex long, delayRegen int")
    rows = {(r["cohortID"], r["year"]): (r["lookup_age"], r["age"])
            for r in ev.age_panel(winners, 2002, cohorts, "delayRegen").collect()}
    assert rows[(1, 2000)] == (1, 1) and rows[(1, 2001)] == (1, 2) and rows[(1, 2002)] == (2, 3)
    assert rows[(2, 2000)] == (1, 0) and rows[(2, 2001)] == (0, 0) and rows[(2, 2002)] == (0, 1)


def test_age_panel_resets_on_second_event(spark):
    winners = spark.createDataFrame([(1, 1, 1, 1), (1, 4, 1, 1), (1, 2, 1, None)],
                                    "pixelIndex long, year int, eventID int, disturbance_type_id int")
    rows = {r["year"]: r["age"] for r in ev.age_panel(winners, 6).collect()}
    assert rows == {1: 1, 2: 2, 3: 3, 4: 1, 5: 2, 6: 3}
