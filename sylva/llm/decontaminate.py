"""Benchmark decontamination by a distributed positional inverted index.

``build_index`` stores a posting (term, document row, position) for every occurrence in the training
texts of a term that a test text uses; other terms can take part in no match, and their postings
would never be read. ``matches`` intersects offset-adjusted postings: each test window first asks
for its few rarest terms (by their number of postings), a document start survives if all of them
stand at their offsets, and the survivors ask for every term of the window, in the postings of the
surviving documents alone. With ``slop`` above 0 a term may stand that many words off its place
relative to the rarest term, which gives proximity matches; 0 gives exact phrases.

All of it is DataFrame operations. Test windows are broadcast when their counted rows are within
``BROADCAST_ROWS`` and joined by a shuffle otherwise; postings are never broadcast.

NULL texts have no words. A test item without words has no window and occurs nowhere; NULL item ids
are left out of the lists of ids. Repeated rows of either table are judged alike; an item that is
repeated counts once. Extra columns are ignored, or kept by ``decontaminate``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ascii_lower, fresh, read, small, stored

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 13
#: Terms of a window that are asked for first.
RAREST = 3
#: The posting that each document row has beside its words': its position is the number of words.
LENGTH = -1


def words(text: Column) -> Column:
    """Array of the words of ``text`` (NULL: none)."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD), "")


def test_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id, win, size, q, term): the words of each test window, one row each; q is the offset."""
    items = benchmark.select("item_id", words(F.col("text")).alias("w")).where("size(w) > 0").distinct()
    starts = items.select("item_id", "w", F.explode(F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0)))).alias("s"))
    cut = starts.select("item_id", F.slice("w", F.col("s") + 1, window).alias("w"))
    return cut.select("item_id", F.sha2(F.concat_ws(" ", "w"), 256).alias("win"), F.size("w").alias("size"),
                      F.posexplode("w").alias("q", "term")).distinct()


def build_index(docs: DataFrame, terms: DataFrame, n_terms: int) -> DataFrame:
    """Stored postings (row, term_id, pos) of ``terms`` (term, term_id) in ``docs``, and for each row of
    ``docs`` one posting of term ``LENGTH`` with its doc_id and its number of words."""
    texts = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), words(F.col("text")).alias("w"))
    # the empty word never occurs in a text: it stands for the length
    spots = texts.select("row", "doc_id", F.size("w").alias("n"), F.posexplode(F.concat("w", F.array(F.lit("")))).alias("p", "term"))
    known = terms.union(docs.sparkSession.sql(f"SELECT '' AS term, {LENGTH}L AS term_id"))
    is_length = F.col("term_id") == LENGTH
    return stored(spots.join(small(known, n_terms), "term").select(
        "row", F.when(is_length, F.col("doc_id")).alias("doc_id"), "term_id", F.when(is_length, F.col("n")).otherwise(F.col("p")).alias("pos")), "postings")


def matches(index: DataFrame, windows: DataFrame, n_windows: int, slop: int = 0, rarest: int = RAREST) -> DataFrame:
    """(win, size, row, start): where the windows (win, size, q, term_id; one row per word) occur.

    With ``slop``, start is where the window would begin by the place of its rarest term, and each
    of its terms stands within ``slop`` words of its place."""
    postings = index.where(F.col("term_id") != LENGTH)
    counts = postings.groupBy("term_id").agg(F.count("*").alias("n"))
    by_rarity = Window.partitionBy("win").orderBy("n", "term_id", "q")
    # a window with a term that no document has occurs nowhere
    ranked = stored(windows.join(counts, "term_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
                    .withColumn("rank", F.row_number().over(by_rarity))
                    .withColumn("least", F.min("n").over(Window.partitionBy("win"))).where("least > 0"), "windows")
    anchors = ranked.where(F.col("rank") <= rarest)
    spots = postings.join(small(anchors, n_windows * rarest), "term_id") \
        .select("win", "size", "row", "rank", (F.col("pos") - F.col("q")).alias("at"))
    if slop:
        around = F.explode(F.sequence(F.col("at") - slop, F.col("at") + slop))
        spots = spots.where("rank = 1").union(spots.where("rank > 1").select("win", "size", "row", "rank", around).distinct())
    need = F.least(F.lit(rarest), F.col("size"))
    survivors = spots.where("at >= 0" if not slop else "true").groupBy("win", "size", "row", "at") \
        .agg(F.count("*").alias("found"), F.min("rank").alias("low")).where((F.col("found") == need) & (F.col("low") == 1)) \
        .select("win", "size", "row", "at")
    survivors = stored(survivors, "survivors")
    # every other term, asked in the surviving documents only
    rest = ranked.where(F.col("rank") > rarest).select("win", "q", "term_id")
    asked = survivors.join(small(rest, n_windows * WINDOW), "win").select(
        "win", "size", "row", "at", "term_id", "q", F.explode(
            F.sequence(F.col("at") + F.col("q") - slop, F.col("at") + F.col("q") + slop)).alias("pos"))
    rows = stored(survivors.select(F.col("row").alias("of")).distinct(), "surviving-rows")
    near = postings.join(small(rows, rows.count()), F.col("row") == F.col("of"), "left_semi").select("row", "term_id", "pos")
    met = asked.join(near, ["row", "term_id", "pos"]).select("win", "size", "row", "at", "q").distinct() \
        .groupBy("win", "size", "row", "at").agg(F.count("*").alias("found"))
    whole = met.where(F.col("found") == F.col("size") - rarest).select("win", "size", "row", "at") \
        .union(survivors.where(F.col("size") <= rarest))
    return whole.withColumnRenamed("at", "start")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per row of ``docs``: row, doc_id, n_words, n_hit (words inside any occurrence of a test
    window), items (sorted ids of the items with an occurring window) and contaminated: at least a
    twentieth of the words are hit."""
    tests = stored(test_windows(benchmark, window), "test-words")
    n_tests = tests.count()
    # a number for each window, as it goes into every row of the intersection
    numbers = stored(tests.select("win").distinct().withColumn("number", F.monotonically_increasing_id()), "test-windows")
    tests = stored(tests.join(small(numbers, n_tests), "win").drop("win").withColumnRenamed("number", "win"), "tests")
    terms = stored(tests.select("term").distinct().withColumn("term_id", F.monotonically_increasing_id()), "terms")
    index = build_index(docs, terms, n_tests)
    windows = tests.join(terms, "term").select("win", "size", "q", "term_id").distinct()
    found = stored(matches(index, windows, n_tests), "matches")
    hit = found.select("row", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("size") - 1)).alias("pos")) \
        .distinct().groupBy("row").agg(F.count("*").alias("n_hit"))
    of_window = tests.select("win", "item_id").where("item_id IS NOT NULL").distinct()
    items = found.select("row", "win").distinct().join(small(of_window, n_tests), "win").select("row", "item_id").distinct() \
        .groupBy("row").agg(F.sort_array(F.collect_list(F.col("item_id").cast("string"))).alias("items"))
    # documents with a match, a small part of all
    judged = hit.join(items, "row", "left")
    base = index.where(F.col("term_id") == LENGTH).select("row", "doc_id", F.col("pos").cast("long").alias("n_words"))
    out = base.join(judged, "row", "left").select(
        "row", "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` that are not contaminated. A document is known again by its id and a
    256-bit digest of its text, so rows that agree in both share their fate."""
    key, text = fresh("_key", docs.columns), F.coalesce(F.sha2("text", 256), F.lit("none"))
    marked = docs.select(F.struct("doc_id", text.alias("text")).alias("doc_id"), "text")
    bad = stored(contamination(marked, benchmark, window).where("contaminated").select("doc_id").distinct(), "contaminated")
    of = fresh("_bad", [*docs.columns, key])
    found = small(bad.select(F.to_json("doc_id").alias(of)), bad.count(), 100_000)
    keyed = docs.withColumn(key, F.to_json(F.struct("doc_id", text.alias("text"))))
    return keyed.join(found, F.col(key) == F.col(of), "left_anti").drop(key)


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


#: The same rows by DuckDB: all windows of all texts, met by their words.
ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT DISTINCT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
tests AS (SELECT DISTINCT item_id, least(len(w), 13) AS size, array_to_string(w[s:s + 12], ' ') AS win
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS s FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM tests),
spans AS (SELECT r, size, s, array_to_string(w[s:s + size - 1], ' ') AS win
    FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS s FROM d, sizes WHERE len(w) >= size)),
found AS (SELECT spans.r, spans.s, spans.size, tests.item_id FROM spans JOIN tests ON spans.win = tests.win AND spans.size = tests.size),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + size)) AS p FROM found) GROUP BY r),
items AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM found GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN items USING (r)
"""
