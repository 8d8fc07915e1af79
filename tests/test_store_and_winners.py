"""Years that are whole or not there (A4, A5), winners by batch (A7 + E1), growth over intervals (E3 -> C10)."""

import random
import threading

import pytest
from pyspark.sql import functions as F

from sylva.operators import events as ev
from sylva.operators import growth as gw
from sylva.session import shared_dir, work_folder
from sylva.sources import snapshots as sn
from sylva.streaming import winners as wn


def _tables(spark, value):
    df = spark.createDataFrame([(1, value), (2, value)], "row_idx long, v int")
    return {"key": df, "pools": df, "flux": df}


def test_a_stopped_writer_leaves_no_year(spark, tmp_path):
    root = str(tmp_path / "run")
    sn.write_snapshot(_tables(spark, 1), root, 1)
    broken = {**_tables(spark, 2), "flux": spark.range(1).select(F.raise_error(F.lit("stopped")).alias("v"))}
    for year in (1, 2):  # a year that was there, and one that was not
        with pytest.raises(Exception, match="stopped"):
            sn.write_snapshot(broken, root, year)
    assert sn.written_years(spark, root, "pools") == [1]
    assert {r["v"] for r in sn.read_snapshots(spark, root, "pools").collect()} == {1}
    with pytest.raises(ValueError, match="no pools of year 2 .* there are 1"):
        sn.read_snapshots(spark, root, "pools", [1, 2])
    assert {"key", "pools"} <= {name.split("/")[0] for name in sn.remove_unused(spark, root)}
    assert [len(list((tmp_path / "run" / t).glob("write=*"))) for t in ("key", "pools", "flux")] == [1, 1, 1]
    assert sn.read_snapshots(spark, root, "flux").count() == 2
    sn.write_snapshot(_tables(spark, 3), root, 2)
    assert sorted((r["year"], r["v"]) for r in sn.read_snapshots(spark, root, "pools").collect()) == [(1, 1), (1, 1), (2, 3), (2, 3)]


def test_a_panel_is_not_written_into_one_year(spark, tmp_path):
    root = str(tmp_path / "run")
    panel = spark.createDataFrame([(y, y * 10) for y in (1, 2, 3)], "year int, v int")
    sn.write_snapshot({"pools": panel}, root, 2)
    assert [tuple(r) for r in sn.read_snapshots(spark, root, "pools").select("year", "v").collect()] == [(2, 20)]
    unknown = panel.union(spark.createDataFrame([(None, 0)], "year int, v int"))
    for write in (lambda: sn.write_snapshot({"pools": unknown}, root, 3), lambda: sn.write_panel(unknown, root, "pools")):
        with pytest.raises(Exception, match="no year"):
            write()
    assert sn.written_years(spark, root, "pools") == [2]


def test_rewritten_years_and_other_tables(spark, tmp_path):
    root = str(tmp_path / "run")
    panel = spark.createDataFrame([(y, y) for y in (1, 2, 3)], "year long, v int")
    sn.write_panel(panel, root, "pools")
    sn.write_panel(panel.where("year > 1"), root, "flux")
    sn.write_panel(panel.where("year = 3").withColumn("v", F.lit(9)), root, "pools")
    assert sn.written_years(spark, root, "flux") == [2, 3]
    got = sn.read_snapshots(spark, root, "pools")
    assert dict(got.dtypes)["year"] == "int" and sorted(map(tuple, got.select("year", "v").collect())) == [(1, 1), (2, 2), (3, 9)]
    assert len(sn.remove_unused(spark, root)) == 0  # the first write still holds years 1 and 2
    sn.write_panel(panel, root, "pools")
    assert len(sn.remove_unused(spark, root)) == 2
    sn.write_panel(panel.limit(0), root, "empty")
    assert sn.written_years(spark, root, "empty") == []


def _events(seed, n=300):
    rng = random.Random(seed)
    return [(rng.randrange(40), rng.choice([1, 2, 3, None]), rng.randrange(6)) for _ in range(n)]


META = "eventID int, disturbance_type_id int, priority int"


def test_winners_by_batches_equal_the_batch(spark, tmp_path):
    meta = spark.createDataFrame([(0, 5, 2), (1, 6, 1), (2, 7, None), (3, 8, 1), (4, 9, 3)], META)
    root, rows = str(tmp_path / "winners"), _events(1)
    df = lambda r: spark.createDataFrame(r, "pixelIndex long, year int, eventID int")
    assert wn.merge_events(df(rows[:100]), meta, root, 0) == [1, 2, 3]
    assert wn.merge_events(df([r for r in rows[100:200] if r[1] == 2]), meta, root, 1) == [2]
    places = wn._years(spark, root)
    assert places == {1: "batch=0", 2: "batch=1", 3: "batch=0"}  # only the touched year was written
    assert wn.merge_events(df(rows[200:]), meta, root, 1) == []  # a batch that has been merged
    rest = [r for r in rows[100:200] if r[1] != 2] + rows[200:]
    wn.merge_events(df(rest), meta, root, 2)
    wn.merge_events(df([]), meta, root, 3)
    given = df(rows).where("year IS NOT NULL")
    want = ev.resolve_events(ev.type_events(given, meta))
    assert sorted(map(tuple, wn.read_winners(spark, root).collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_a_batch_that_stopped_before_its_commit(spark, tmp_path, monkeypatch):
    meta = spark.createDataFrame([(e, e, e) for e in range(6)], META)
    root, rows = str(tmp_path / "winners"), [r for r in _events(2) if r[1]]
    df = lambda r: spark.createDataFrame(r, "pixelIndex long, year int, eventID int")
    wn.merge_events(df(rows[:50]), meta, root, 0)
    before = sorted(map(tuple, wn.read_winners(spark, root).collect()))

    def stop(*_):
        raise OSError("stopped")
    with monkeypatch.context() as m:
        m.setattr(wn, "put_text", stop)
        with pytest.raises(OSError):
            wn.merge_events(df(rows[50:]), meta, root, 1)
    assert sorted(map(tuple, wn.read_winners(spark, root).collect())) == before
    wn.merge_events(df(rows[50:]), meta, root, 1)
    want = ev.resolve_events(ev.type_events(df(rows), meta))
    assert sorted(map(tuple, wn.read_winners(spark, root).collect())) == sorted(map(tuple, want.collect()))


def test_events_that_cannot_be_ranked(spark, tmp_path):
    meta = spark.createDataFrame([(1, 5), (2, 6)], "eventID int, disturbance_type_id int")
    df = lambda r: spark.createDataFrame(r, "pixelIndex long, year int, eventID int")
    wn.merge_events(df([(1, 1, 1)]), meta, str(tmp_path / "w"), 0)
    with pytest.raises(ValueError, match="priority"):
        wn.merge_events(df([(1, 1, 2)]), meta, str(tmp_path / "w"), 1)


INC = "gcID int, age int, merch_inc double, foliage_inc double, other_inc double"


def test_interval_growth_by_hand(spark):
    rng = random.Random(5)
    curves = {c: {a: tuple(rng.choice([None, 0.0, 0.25, 1.5, -0.5]) if rng.random() < 0.1 else rng.randrange(16) / 8 for _ in range(3))
                  for a in range(rng.randint(0, 1), rng.randint(2, 9)) if rng.random() < 0.9} for c in range(30)}
    inc = spark.createDataFrame([(c, a, *v) for c, by in curves.items() for a, v in by.items()], INC)
    spans = [(rng.randrange(32), rng.randint(1, 20), rng.randint(0, 4)) for _ in range(400)]
    df = spark.createDataFrame([(i, *s) for i, s in enumerate(spans)], "id int, gcID int, years int, delay int")
    got = {r["id"]: tuple(r[c] for c in gw.INCREMENT_COLUMNS) for r in gw.interval_growth(df, inc).collect()}
    for i, (c, years, delay) in enumerate(spans):
        by, sums = curves.get(c) or {}, [0.0, 0.0, 0.0]
        for t in range(1, years + 1):
            age = 1 if t == 1 else max(0, t - 1 - delay)
            row = by.get(min(age, max(by)) if by else age, (None,) * 3)
            sums = [None if s is None or x is None else s + x for s, x in zip(sums, row)]
        assert got[i] == tuple(sums), (c, years, delay)


def test_a_curve_may_not_repeat_an_age(spark):
    inc = spark.createDataFrame([(1, 1, 1.0, 0.0, 0.0), (1, 1, 2.0, 0.0, 0.0)], INC)
    with pytest.raises(Exception, match="increments repeats the key"):
        gw.curve_sums(inc).collect()


def test_intervals_against_the_panel(spark):
    rng = random.Random(3)
    won = spark.createDataFrame([(p, y, 1, rng.choice([1, None])) for p in range(20) for y in range(1, 13) if rng.random() < 0.3],
                                "pixelIndex long, year int, eventID int, disturbance_type_id int")
    cohorts = spark.createDataFrame([(i, i % 25, rng.choice([0, 2, None])) for i in range(40)], "cohortID long, pixelIndex long, delay int")
    panel = ev.age_panel(won, 10, cohorts)  # some first events come after the horizon
    want = panel.groupBy("cohortID", F.col("last_event_year").alias("event_year")).agg(F.count("*").cast("int").alias("years"), F.max("age").alias("age_at_end"))
    got = ev.event_intervals(won, 10, cohorts).select("cohortID", "event_year", "years", "age_at_end")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_work_folders_of_threads_do_not_mix(spark):
    seen = {}

    def other():
        seen["other"] = shared_dir(spark, "t")
    with work_folder(spark) as mine:
        t = threading.Thread(target=other)
        t.start()
        t.join()
        assert shared_dir(spark, "t").startswith(mine) and not seen["other"].startswith(mine)
