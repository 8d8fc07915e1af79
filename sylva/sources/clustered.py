"""Tables stored clustered by their join key: bucketed and sorted, so that the joins of stands, cohorts,
key and events on ``pixelIndex`` read them side by side, without a shuffle of either.

All tables of a layout share key and number of buckets. The files lie below the shared folder; the bucket
layout is kept by the session's catalog (a Hive catalog keeps it beyond the session)."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame

from sylva.session import shared_dir

#: The key of the cohort-level tables.
CLUSTER_KEY = ("pixelIndex",)


def clustered(df: DataFrame, name: str, keys: Sequence[str] = CLUSTER_KEY, buckets: int | None = None) -> DataFrame:
    """``df`` written in ``buckets`` buckets (default: as many as shuffle partitions) by ``keys``, sorted within, and
    read back. One shuffle now, so that every later join or aggregation on the keys needs none. One file per bucket;
    rows without a key go to one bucket, as a shuffle would send them to one task."""
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"sylva_{name}_{uuid.uuid4().hex[:12]}"
    (df.repartition(n, *keys).write.mode("overwrite").format("parquet").bucketBy(n, *keys).sortBy(*keys)
     .option("path", shared_dir(spark, f"clustered-{name}")).saveAsTable(table))
    return spark.table(table)
