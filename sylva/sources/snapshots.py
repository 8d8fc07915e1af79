"""Yearly snapshots (A4, A5, A6, F3) in a store whose years are whole or not there.

Layout: ``<root>/<table>/write=<id>/year=<y>/part-*.parquet`` and one manifest per year,
``<root>/_years/<y>.json``, which names the write that holds each of the year's tables. Tables are written
first, to a folder of their own; the manifests come last, each put in place by a rename. A writer that
stops in between leaves files that no manifest names, and the year stays as it was: absent, or
as an earlier run left it. Writing a year again replaces its manifest, so retries are
idempotent and readers never see half of a year. Readers open manifests only: they list no
data folders, and of the wanted years only. ``remove_unused`` deletes what no manifest names.

Concurrent writers of different years do not meet; of one year, the last manifest holds."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

DEFAULT_TABLES = ("key", "pools", "flux")
ALL_TABLES = ("key", "parameters", "state", "pools", "flux")


def snapshot_tables(save_all: bool = False, spinup: bool = False) -> list[str]:
    """A4's table choice: key, pools, flux by default; parameters and state with
    ``save_all``; the spinup (year 0) has no flux."""
    names = list(ALL_TABLES if save_all else DEFAULT_TABLES)
    if spinup:
        names.remove("flux")
    return names


def write_snapshot(tables: Mapping[str, DataFrame | None], root: str, year: int, save_all: bool = False,
                   spinup: bool = False) -> list[str]:
    """A4: write a year's tables (year 0 for the spinup), then its manifest. Of a table with a ``year``
    column the rows of that year are written (a NULL year raises). Returns the table names written."""
    y = 0 if spinup else int(year)
    spark, places = None, {}
    for name in snapshot_tables(save_all, spinup):
        df = tables.get(name)
        if df is None:
            continue
        spark = df.sparkSession
        if "year" in df.columns:
            df = _of_years(df, F.col("year") == y).drop("year")
        places[name] = _new_write()
        df.write.parquet(f"{root.rstrip('/')}/{name}/{places[name]}/year={y}")
    if places:
        _publish(spark, root, {y: places})
    return list(places)


def open_store(spark: SparkSession, root: str, wipe: bool = False) -> str:
    """Start a run's store: a folder that already holds tables is refused, or emptied with ``wipe``,
    so that no year of an earlier run can be taken for one of this run."""
    root = root.rstrip("/")
    fs, path = _path(spark, root)
    if fs.exists(path) and len(fs.listStatus(path)):
        if not wipe:
            raise ValueError(f"{root} holds tables of an earlier run; wipe it or name another folder")
        fs.delete(path, True)
    fs.mkdirs(path)
    return root


def write_years(tables: Mapping[str, DataFrame | None], root: str, initial: int | None, interval: int, end: int,
                save_all: bool = False, spinup: bool = False) -> list[str]:
    """A4 + A6 on panels: of each chosen table, the years that the save options name (first year,
    interval, last year; year 0 holds the spinup, which has no flux)."""
    wanted = save_years(initial, interval, end, spinup)
    spark, written, places = None, [], {}
    for name in snapshot_tables(save_all):
        df = tables.get(name)
        if df is None:
            continue
        spark = df.sparkSession
        years = [y for y in wanted if not (y == 0 and name == "flux")]
        place, found = _write_folders(df, root, name, F.col("year").isin(years))
        for y in found:
            places.setdefault(y, {})[name] = place
        written.append(name)
    if places:
        _publish(spark, root, places)
    return written


def write_panel(df: DataFrame, root: str, table: str) -> None:
    """Write a (year, ...) panel in one job, one folder per year; only the years present are replaced. Rows
    are rebalanced by year first, which splits large years and keeps a task from opening a file in
    every year. A NULL year raises, and nothing is published."""
    place, years = _write_folders(df, root, table)
    _publish(df.sparkSession, root, {y: {table: place} for y in years})


def _new_write() -> str:
    return f"write={uuid.uuid4().hex[:16]}"


def _of_years(df: DataFrame, wanted: F.Column) -> DataFrame:
    """The rows that are ``wanted``; one without a year raises. (One expression: of two filters the optimizer
    could run the other one first, which a NULL does not pass.)"""
    return df.where(F.when(F.col("year").isNull(), F.raise_error(F.lit("a row has no year")).cast("boolean")).otherwise(wanted))


def _write_folders(df: DataFrame, root: str, table: str, wanted: F.Column | None = None) -> tuple[str, list[int]]:
    """The folder of a new write and the years in it, which the writing job itself counts."""
    place, seen = _new_write(), Observation()
    rows = _of_years(df, F.lit(True) if wanted is None else wanted).withColumn("year", F.col("year").cast("int"))
    rows = rows.hint("rebalance", "year").observe(seen, F.collect_set("year").alias("years"))
    rows.write.partitionBy("year").parquet(f"{root.rstrip('/')}/{table}/{place}")
    return place, sorted(seen.get["years"] or [])


MANIFESTS = "_years"


def _publish(spark: SparkSession, root: str, places: Mapping[int, Mapping[str, str]]) -> None:
    """Put the manifests of years in place: the tables just written, and those that the years had."""
    for y, tables in sorted(places.items()):
        fs, path = _path(spark, f"{root.rstrip('/')}/{MANIFESTS}/{int(y)}.json")
        before = _manifest(spark, root, y) or {}
        put_text(spark, path.toString(), json.dumps({**before, **tables}, sort_keys=True))


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file under another name and rename it: a reader sees the old one or the new one."""
    fs, final = _path(spark, path)
    _, draft = _path(spark, f"{path}.{uuid.uuid4().hex[:8]}.draft")
    out = fs.create(draft, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    over = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = gateway.new_array(over, 1)
    how[0] = over.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), spark._jsc.hadoopConfiguration()).rename(draft, final, how)


def get_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _path(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _manifest(spark: SparkSession, root: str, year: int) -> dict[str, str] | None:
    text = get_text(spark, f"{root.rstrip('/')}/{MANIFESTS}/{int(year)}.json")
    return None if text is None else json.loads(text)


def _years_there(spark: SparkSession, root: str) -> list[int]:
    fs, path = _path(spark, f"{root.rstrip('/')}/{MANIFESTS}")
    if not fs.exists(path):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(path)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json"))


def remove_unused(spark: SparkSession, root: str) -> list[str]:
    """Delete the writes that no manifest names (of writers that stopped, and of replaced years). To be
    called when no writer and no reader of an earlier state is at work. Returns what was deleted."""
    root = root.rstrip("/")
    named = {f"{table}/{place}" for y in _years_there(spark, root) for table, place in (_manifest(spark, root, y) or {}).items()}
    fs, path = _path(spark, root)
    gone = []
    for table in [f.getPath() for f in fs.listStatus(path) if f.isDirectory() and not f.getPath().getName().startswith("_")]:
        for write in [f.getPath() for f in fs.listStatus(table)]:
            name = f"{table.getName()}/{write.getName()}"
            if write.getName().startswith("write=") and name not in named:
                fs.delete(write, True)
                gone.append(name)
    return sorted(gone)


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def written_years(spark: SparkSession, root: str, table: str) -> list[int]:
    """Years whose manifest names the table; no data folder is listed."""
    return [y for y in _years_there(spark, root) if table in (_manifest(spark, root, y) or {})]


def read_snapshots(spark: SparkSession, root: str, table: str, years: Iterable[int] | None = None) -> DataFrame:
    """A5: one table over several years as a panel with an int ``year`` column. Only the wanted
    years' folders are touched, and of each one footer is read: years may differ in columns
    (the spinup has fewer pools), and the union gives NULL where a year lacks one. A wanted year that
    is not there raises; without ``years``, all that are there are read."""
    wanted = written_years(spark, root, table) if years is None else sorted({int(y) for y in years})
    if not wanted:
        raise ValueError(f"no year of {table} in {root}")
    panels = [read_year(spark, root, table, y).withColumn("year", F.lit(y)) for y in wanted]
    out = panels[0]
    for p in panels[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def read_year(spark: SparkSession, root: str, table: str, year: int) -> DataFrame:
    """One table of one year (without the ``year`` column). A year's files share one
    schema, so the folder is read directly: no schema merge, no listing of other years."""
    place = (_manifest(spark, root, year) or {}).get(table)
    if place is None:
        there = written_years(spark, root, table)
        raise ValueError(f"no {table} of year {int(year)} in {root}; there are " + (", ".join(map(str, there)) or "none"))
    return spark.read.parquet(f"{root.rstrip('/')}/{table}/{place}/year={int(year)}")


def save_years(initial: int | None, interval: int, end: int, spinup: bool = False) -> list[int]:
    """Initial, initial+interval, ... <= end, plus 0 for a saved spinup; nothing when
    ``initial`` is None."""
    if initial is None:
        return [0] if spinup else []
    years = list(range(int(initial), int(end) + 1, int(interval)))
    return ([0] if spinup else []) + years


def save_years_frame(spark: SparkSession, initial: int, interval: int, end: int, spinup: bool = False) -> DataFrame:
    """A6 as a DataFrame (``sequence`` + ``explode``), for joining against panels."""
    df = spark.range(1).select(F.explode(F.sequence(F.lit(int(initial)), F.lit(int(end)),
                                                    F.lit(int(interval)))).alias("year"))
    df = df.select(F.col("year").cast("int").alias("year"))
    if spinup:
        df = spark.range(1).select(F.lit(0).alias("year")).unionByName(df)
    return df


def append_year(result: DataFrame, root: str, table: str = "emissionsProducts") -> None:
    """add a year's result rows to the results table (idempotent per year)."""
    write_panel(result, root, table)
