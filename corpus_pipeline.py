"""From raw documents to the shards of a training corpus.

Each stage takes (spark, docs, sf_dir) and works on what the stage before it kept. ``run`` writes
each stage's rows as Parquet below ``spark.checkpoint.dir`` and reads them again, so that a lost
executor costs no earlier stage. All stages but the last return the columns of documents; the last
adds ``shard``.

SQL cannot express cross-parsing or the bit votes of a SimHash, so there is no ORACLE_SQL; the
tests hold every stage against a brute-force version."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sylva.llm.common import read, stored
from sylva.llm.decontaminate import decontaminate
from sylva.llm.language import keep_identified
from sylva.llm.mixing import mix
from sylva.llm.sharding import assign_shards
from sylva.llm.simhash import keep_one


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a known language; the automata learn from the rows that came in."""
    return keep_identified(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id."""
    return keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words is inside a test window."""
    return decontaminate(docs, read(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mix(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard; repeats of a text share one."""
    return assign_shards(docs)


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
