"""Mixing sources to target weights by weighted fair queueing.

The documents of each source are shuffled by a hash, and each gets a virtual finish time: the tokens
of its source up to and including it, divided by the weight of the source. A second and third pass
over a source go on where the pass before ended. All (document, pass) entries are sorted globally
by finish time and cut off at the total budget; what is before the cut is the mix, in its order.

A source that runs out after ``max_epochs`` passes leaves the rest of the budget to the others in
proportion to their weights; ``targets`` states the same shares in closed form.

NULL texts have size 0; a NULL source is a source of its own. Repeated rows are documents of their
own. Ties in finish time go by pass, then by place in the shuffled order, which only rows equal in
source, id and size can share. An empty table gives an empty mix."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import read, running_totals, small, stored, word_count

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = 17


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source of ``sized`` (source, size): source, source_size, weight, target.

    Sources in code point order, NULL last, take the weights in turn. The budget is the sum of all
    sizes. A target stops at ``max_epochs`` times its source's size, and the excess goes to the
    others by weight: targets are min(limit, level * weight) at the level that spends the budget.
    The windows see one row per source."""
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    nth = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), ((nth - 1) % len(weights) + 1).cast("int")))
    per = per.withColumn("limit", F.col("source_size") * max_epochs).withColumn("fills_at", F.col("limit") / F.col("weight"))
    by_level = Window.orderBy("fills_at", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    per = per.withColumn("level", (F.sum("source_size").over(every) - F.coalesce(F.sum("limit").over(by_level), F.lit(0)))
                         / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(by_level), F.lit(0))))
    # from the first source that the level does not fill on, the level only falls
    level = F.max(F.when(F.col("level") <= F.col("fills_at"), F.col("level"))).over(every)
    return per.withColumn("target", F.least(F.col("limit").cast("double"), level * F.col("weight"))) \
        .select("source", "source_size", "weight", "target")


def queue(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """One row per row of ``docs`` (doc_id, source, size and any more): its source's source_size,
    weight and target, and ``finish``, its entries' finish times by pass, and ``epochs``, the number
    of its entries that are in the mix."""
    shuffled = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "size").cast("binary"))
    order = [F.col("source").asc_nulls_last(), shuffled, F.col("doc_id"), F.col("size")]
    placed = running_totals(docs, order, {"size": "tokens"}, "mix-sources")
    per = stored(targets(docs, weights, max_epochs), "mix-targets")
    before = F.coalesce(F.sum("source_size").over(Window.orderBy(F.col("source").asc_nulls_last())
                                                  .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    per = per.withColumn("before", before).withColumnRenamed("source", "of_source")
    placed = placed.join(small(per, per.count()), F.col("source").eqNullSafe(F.col("of_source"))).drop("of_source")
    tokens = F.col("tokens") - F.col("before")
    finish = F.array(*[(tokens + k * F.col("source_size")) / F.col("weight") for k in range(max_epochs)])
    placed = stored(placed.withColumn("finish", finish).drop("before", "tokens"), "mix-queue")
    entries = placed.select("row_pos", "size", F.posexplode("finish").alias("pass", "at"))
    key = ["at", "pass", "row_pos"]
    budget = per.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    mixed = running_totals(entries, [F.col(k) for k in key], {"size": "spent"}, "mix-entries")
    cut = mixed.where(F.col("spent") <= budget).agg(F.max(F.struct(*key)).alias("cut")).first()["cut"]
    if cut is None:
        return placed.withColumn("epochs", F.lit(0))
    last = F.struct(F.lit(cut["at"]).alias("at"), F.lit(cut["pass"]).alias("pass"), F.lit(cut["row_pos"]).alias("row_pos"))
    taken = [(F.struct(F.col("finish")[k].alias("at"), F.lit(k).alias("pass"), F.col("row_pos").alias("row_pos")) <= last).cast("int")
             for k in range(max_epochs)]
    return placed.withColumn("epochs", sum(taken[1:], taken[0]))


def sized(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))


def mix(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them (0 to ``MAX_EPOCHS`` times). Rows that
    agree in id, source and size are taken equally often, up to one pass, by their rank."""
    times = queue(sized(docs)).groupBy("doc_id", "source", "size").agg(F.sum("epochs").alias("n"), F.count("*").alias("of"))
    times = times.select(F.to_json(F.struct("doc_id", "source", "size")).alias("key"), "n", "of")
    times = stored(times.where("n > 0"), "mix-times")
    keyed = docs.select(F.struct(*docs.columns).alias("row"), F.to_json(F.struct(
        "doc_id", "source", word_count(F.col("text")).alias("size"))).alias("key"))
    alone = keyed.join(times.where("of = 1"), "key").select("row", F.col("n").alias("copies"))
    repeated = times.where("of > 1")
    n_repeated = repeated.count()
    if not n_repeated:
        return _copies(alone)
    # repeated rows share their entries out by their place in one global order
    again = keyed.join(small(repeated, n_repeated), "key").withColumn("tie", F.monotonically_increasing_id())
    again = running_totals(again, [F.col("key"), F.col("tie")], {}, "mix-repeats")
    first = stored(again.groupBy(F.col("key").alias("of_key")).agg(F.min("row_pos").alias("first")), "mix-firsts")
    again = again.join(small(first, first.count()), F.col("key") == F.col("of_key"))
    share = F.floor(F.col("n") / F.col("of")) + (F.col("row_pos") - F.col("first") < F.col("n") % F.col("of")).cast("int")
    return _copies(alone.unionByName(again.select("row", share.alias("copies"))))


def _copies(rows: DataFrame) -> DataFrame:
    return rows.where("copies > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")


def op6_mixing_to_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = queue(sized(read(spark, sf_dir, "documents")))
    return placed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("epochs")).cast("long").alias("taken"))


#: The same mix by DuckDB: running sums per source, all entries sorted, cut at the budget.
ORACLE = rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS nth FROM d GROUP BY source),
w AS (SELECT *, [{", ".join(map(str, WEIGHTS))}][(nth - 1) % {len(WEIGHTS)} + 1] AS weight, {MAX_EPOCHS} * source_size AS most FROM s),
l AS (SELECT *, most / weight AS fills_at, (sum(source_size) OVER () - coalesce(sum(most) OVER below, 0))
        / (sum(weight) OVER () - coalesce(sum(weight) OVER below, 0)) AS level
    FROM w WINDOW below AS (ORDER BY most / weight, nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT *, least(most::DOUBLE, (SELECT max(level) FROM l WHERE level <= fills_at) * weight) AS target FROM l),
p AS (SELECT d.*, t.source_size, t.weight, t.target, md5('{SEED}:' || coalesce(doc_id::VARCHAR, '') || ':' || size) AS h
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
q AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST, h, doc_id NULLS FIRST) AS place,
    sum(size) OVER (PARTITION BY source ORDER BY h, doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING) AS tokens FROM p),
e AS (SELECT place, size, pass, (tokens + pass * source_size) / weight AS finish FROM q, (SELECT unnest(range({MAX_EPOCHS})) AS pass)),
m AS (SELECT place, size, sum(size) OVER (ORDER BY finish, pass, place ROWS UNBOUNDED PRECEDING) AS spent FROM e),
n AS (SELECT place, sum(size) AS taken FROM m WHERE spent <= (SELECT sum(size) FROM d) GROUP BY place)
SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken FROM q LEFT JOIN n USING (place)
"""
