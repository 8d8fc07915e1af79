"""Disturbance events may arrive during a run (another producer writes event files);
the result must be the same as with one initial table.

Events are streamed from a folder of files into an events table partitioned by ``year``
with Structured Streaming's file sink, which is exactly-once (its ``_spark_metadata`` log
lists committed files; a restarted query resumes from its checkpoint). The yearly loop
reads that table with a ``year`` filter, which prunes partitions (B9). There is no
late-data rule in the model: an event for a year already simulated is stored but never
read, so no watermark or state is needed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from sylva.session import shared_dir

EVENT_SCHEMA = "pixelIndex long, year int, eventID int"


def start_event_ingest(spark: SparkSession, source: str, table: str, schema: StructType | str = EVENT_SCHEMA,
                       transform: Callable[[DataFrame], DataFrame] | None = None,
                       checkpoint: str | None = None, available_now: bool = True,
                       source_format: str = "parquet", glob_filter: str | None = None):
    """Start the stream ``source`` files -> ``table`` (parquet, partitioned by year).
    ``transform`` maps the source rows to (pixelIndex, year, eventID). Returns the
    StreamingQuery; with ``available_now`` it stops after the files present at start.
    ``glob_filter`` keeps only matching file names of the source folder."""
    reader = spark.readStream.schema(schema).format(source_format)
    if glob_filter:
        reader = reader.option("pathGlobFilter", glob_filter)
    stream = reader.load(source)
    if transform is not None:
        stream = transform(stream)
    stream = stream.select("pixelIndex", "year", "eventID")
    writer = (stream.writeStream.format("parquet").outputMode("append").partitionBy("year")
              .option("path", table)
              .option("checkpointLocation", checkpoint or shared_dir(spark, "events-ingest-ckpt")))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


def ingest_events(spark: SparkSession, source: str, table: str, schema: StructType | str = EVENT_SCHEMA,
                  transform: Callable[[DataFrame], DataFrame] | None = None, checkpoint: str | None = None,
                  source_format: str = "parquet", glob_filter: str | None = None) -> DataFrame:
    """Ingest every file now in ``source`` and return the events table."""
    q = start_event_ingest(spark, source, table, schema, transform, checkpoint, True, source_format, glob_filter)
    q.awaitTermination()
    return read_events(spark, table)


def read_events(spark: SparkSession, table: str, year: int | None = None) -> DataFrame:
    df = spark.read.parquet(table)
    if year is not None:
        df = df.where(df["year"] == int(year))
    return df.select("pixelIndex", df["year"].cast("int").alias("year"), "eventID")
