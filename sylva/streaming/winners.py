"""Winning events kept up to date while events arrive (A7 + E1).

A stream of events is merged batch by batch into a stored table of winners (one event per stand and year). Of
two winners of one stand and year E1 takes the same one that it takes of all their events, so a batch
is merged by resolving it together with the stored winners of the years that it touches; the years that
it does not touch are neither read nor written.

``foreachBatch`` may repeat a batch. Each batch writes its years to a folder named after its number and then
puts a commit in place, which names the folder of every year; a batch whose commit is there is left
out, and one that stopped before its commit is written anew. Readers follow the last commit, so they see
all of a batch or nothing of it."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sylva.operators.events import resolve_events, type_events
from sylva.session import shared_dir
from sylva.sources.snapshots import _path, get_text, put_text
from sylva.streaming.events import EVENT_SCHEMA

COMMITS = "_commits"
STORED = "pixelIndex long, eventID int, disturbance_type_id int, priority int"


def _commits(spark: SparkSession, root: str) -> list[int]:
    fs, path = _path(spark, f"{root.rstrip('/')}/{COMMITS}")
    if not fs.exists(path):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(path)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json"))


def _years(spark: SparkSession, root: str, before: int | None = None) -> dict[int, str]:
    """Folder of each year by the last commit (before a batch)."""
    done = [c for c in _commits(spark, root) if before is None or c < before]
    if not done:
        return {}
    text = get_text(spark, f"{root.rstrip('/')}/{COMMITS}/{done[-1]}.json")
    return {int(y): place for y, place in json.loads(text or "{}").items()}


def _stored(spark: SparkSession, root: str, places: dict[int, str]) -> DataFrame:
    out = spark.createDataFrame([], f"{STORED}, year int")
    for y, place in sorted(places.items()):
        year = spark.read.schema(STORED).parquet(f"{root.rstrip('/')}/{place}/year={y}")
        out = out.unionByName(year.withColumn("year", F.lit(y)))
    return out


def merge_events(events: DataFrame, meta: DataFrame, root: str, batch_id: int) -> list[int]:
    """Merge a batch of (pixelIndex, year, eventID) into the winners in ``root``; returns the years that were
    written, none if the batch has been merged before. Events without a year are left out, as no year
    of the horizon reads them."""
    spark = events.sparkSession
    if int(batch_id) in _commits(spark, root):
        return []
    before = _years(spark, root, int(batch_id))
    typed = type_events(events.where("year IS NOT NULL").select("pixelIndex", F.col("year").cast("int").alias("year"), "eventID"), meta)
    ranked = "priority" in typed.columns
    if not ranked:
        typed = typed.withColumn("priority", F.lit(None).cast("int"))
    typed = typed.select("pixelIndex", "eventID", "disturbance_type_id", "priority", "year").persist()
    try:
        touched = sorted(r["year"] for r in typed.select("year").distinct().collect())  # at most the years of the horizon
        both = _stored(spark, root, {y: p for y, p in before.items() if y in touched}).unionByName(typed)
        if not ranked:  # two events of one stand and year cannot be ranked (Q3)
            resolve_events(both.drop("priority"), check=True)
        won = resolve_events(both, check=False, keep=("priority",))
        place = f"batch={int(batch_id)}"
        won.hint("rebalance", "year").write.mode("overwrite").partitionBy("year").parquet(f"{root.rstrip('/')}/{place}")
    finally:
        typed.unpersist()
    now = {**before, **{y: place for y in touched}}
    put_text(spark, f"{root.rstrip('/')}/{COMMITS}/{int(batch_id)}.json", json.dumps({str(y): p for y, p in sorted(now.items())}))
    return touched


def read_winners(spark: SparkSession, root: str) -> DataFrame:
    """The winners as E1 gives them: pixelIndex, year, eventID, disturbance_type_id."""
    return _stored(spark, root, _years(spark, root)).select("pixelIndex", "year", "eventID", "disturbance_type_id")


def start_winner_updates(spark: SparkSession, source: str, meta: DataFrame, root: str, schema: StructType | str = EVENT_SCHEMA,
                         transform: Callable[[DataFrame], DataFrame] | None = None, checkpoint: str | None = None,
                         available_now: bool = True, source_format: str = "parquet", glob_filter: str | None = None,
                         files_per_batch: int | None = None):
    """Start the stream ``source`` files -> winners in ``root``. A ``checkpoint`` belongs to one ``root``: the
    batch numbers of one go on in the other."""
    reader = spark.readStream.schema(schema).format(source_format)
    if glob_filter:
        reader = reader.option("pathGlobFilter", glob_filter)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = reader.load(source)
    if transform is not None:
        stream = transform(stream)

    def merge(batch: DataFrame, batch_id: int) -> None:
        merge_events(batch, meta, root, batch_id)

    writer = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint or shared_dir(spark, "winners-ckpt"))
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")).start()
