"""Snapshots (A4-A6, F3) and incremental event ingestion."""

import pytest
from pyspark.sql import functions as F

from sylva.sources import snapshots as sn
from sylva.streaming.events import read_events, start_event_ingest


def test_write_read_and_years(spark, tmp_path):
    root = str(tmp_path / "db")
    df = spark.createDataFrame([(1, 1.0), (2, 2.0)], "row_idx long, Merch double")
    for y in (2000, 2001, 2002):
        sn.write_snapshot({"key": df, "pools": df.withColumn("Merch", F.lit(float(y))), "flux": df}, root, y)
    sn.write_snapshot({"key": df, "pools": df, "flux": df}, root, 1999, spinup=True)
    assert sn.snapshot_tables() == ["key", "pools", "flux"]
    assert sn.snapshot_tables(save_all=True, spinup=True) == ["key", "parameters", "state", "pools"]
    panel = sn.read_snapshots(spark, root, "pools", [0, 2001])
    assert sorted({r["year"] for r in panel.collect()}) == [0, 2001]
    assert dict(panel.dtypes)["year"] == "int"
    # year 0 has no flux; rewriting a year replaces it
    assert sorted({r["year"] for r in sn.read_snapshots(spark, root, "flux").collect()}) == [2000, 2001, 2002]
    sn.write_snapshot({"pools": df.limit(1)}, root, 2001)
    assert sn.read_snapshots(spark, root, "pools", [2001]).count() == 1
    assert sn.save_years(2000, 2, 2005, spinup=True) == [0, 2000, 2002, 2004]
    assert sn.save_years(None, 1, 2005) == []
    assert [r["year"] for r in sn.save_years_frame(spark, 2000, 2, 2005).collect()] == [2000, 2002, 2004]


def test_incremental_ingest_equals_batch(spark, tmp_path):
    src, table, ckpt = str(tmp_path / "in"), str(tmp_path / "events"), str(tmp_path / "ckpt")
    a = spark.createDataFrame([(1, 2000, 1), (2, 2000, 2)], "pixelIndex long, year int, eventID int")
    b = spark.createDataFrame([(1, 2001, 1), (3, 2001, 4)], "pixelIndex long, year int, eventID int")
    a.write.parquet(src + "/batch=0")
    q = start_event_ingest(spark, src, table, checkpoint=ckpt, glob_filter="*.parquet")
    q.awaitTermination()
    b.write.parquet(src + "/batch=1")
    q = start_event_ingest(spark, src, table, checkpoint=ckpt, glob_filter="*.parquet")
    q.awaitTermination()
    # rerunning with nothing new adds nothing (exactly-once sink)
    q = start_event_ingest(spark, src, table, checkpoint=ckpt, glob_filter="*.parquet")
    q.awaitTermination()
    got = sorted(tuple(r) for r in read_events(spark, table).collect())
    assert got == sorted([tuple(r) for r in a.collect()] + [tuple(r) for r in b.collect()])
    assert read_events(spark, table, 2001).count() == 2


def test_streamed_events_prune_by_year(spark, tmp_path):
    from sylva.operators import events as ev
    src, table = str(tmp_path / "in"), str(tmp_path / "events")
    given = spark.createDataFrame([(1, 2000, 1), (2, 2000, 1), (2, 2001, 1)], "pixelIndex long, year int, eventID int")
    given.write.parquet(src + "/batch=0")
    q = start_event_ingest(spark, src, table, checkpoint=str(tmp_path / "ckpt"), glob_filter="*.parquet")
    q.awaitTermination()
    streamed = read_events(spark, table)
    one = ev.year_filter(streamed, 2000)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan  # the year is a folder, not a row filter
    assert sorted(map(tuple, one.collect())) == [(1, 2000, 1), (2, 2000, 1)]


@pytest.mark.parametrize("master_url", ["yarn", "local-cluster[2,1,1024]", "spark://host:7077"])
def test_cluster_session_needs_a_shared_checkpoint_folder(master_url):
    from sylva.session import shared_dir

    class _Conf:
        def get(self, key, default=None):
            return default

    class _SC:
        master = master_url

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return _Conf()

    class _Spark:
        sparkContext = _SC()
        conf = _Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(_Spark(), "x")


def test_shared_dir_uses_the_session_folder(spark):
    from sylva.session import shared_dir
    root = spark.sparkContext.getCheckpointDir() or ""
    a, b = shared_dir(spark, "t"), shared_dir(spark, "t")
    assert a != b and a.startswith(spark.sparkContext.getCheckpointDir().rstrip("/"))
    assert root == "" or a.startswith(root.rstrip("/"))
