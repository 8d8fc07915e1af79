import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from sylva.llm import decontaminate as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, size=13):
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for item, t in items:
            b = words(t)
            for s in range(max(1, len(b) - size + 1) if b else 0):
                window = b[s:s + size]
                for p in range(len(w) - len(window) + 1):
                    if w[p:p + len(window)] == window:
                        hit.update(range(p, p + len(window)))
                        if item is not None:
                            found.add(str(item))
        ids = ",".join(sorted(found))
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def run(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    got = dc.contamination(d, b)
    rows = got.select("doc_id", "n_words", "n_hit", F.size("items").alias("n"), F.sha2(F.concat_ws(",", "items"), 256), "contaminated").collect()
    return sorted([tuple(r) for r in rows], key=str)


def test_against_brute_force(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(12)] + ["Élan", "the", "a"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.choice([1, 5, 12, 13, 20, 40]))) for i in range(12)] + [(3, None), (4, ""), (5, " . ,"), (None, text(14)), (7, "Only, SHORT!")]
    docs = []
    for i in range(40):
        parts = [text(rng.randint(0, 30))]
        for _ in range(rng.randint(0, 2)):
            _, t = rng.choice(items)
            w = words(t)
            s = rng.randint(0, max(0, len(w) - 13))
            parts += [" ".join(w[s:s + rng.choice([12, 13, 15])]).upper(), text(rng.randint(0, 300))]
        docs.append((i, "\n".join(parts)))
    docs += [(50, None), (51, ""), (52, "..."), (53, "x only short y"), (53, "x only short y"), (None, items[0][1])]
    docs.append((54, text(5000) + " " + items[5][1]))  # a very long text
    assert run(spark, docs, items) == brute(docs, items)


@pytest.mark.parametrize("docs, items", [([], [(1, "a b c")]), ([(1, "a b c")], []), ([], [])])
def test_empty_tables(spark, docs, items):
    assert run(spark, docs, items) == brute(docs, items)


def test_proximity(spark):
    item = " ".join(f"t{i}" for i in range(13))
    exact = item.split()
    off = exact[:6] + ["noise"] + exact[6:]  # the second half is one word off its place
    far = exact[:6] + ["noise"] * 4 + exact[6:]
    docs = spark.createDataFrame([(1, item), (2, " ".join(off)), (3, " ".join(far))], "doc_id long, text string")
    tests = dc.test_windows(spark.createDataFrame([(1, item)], "item_id long, text string"))
    terms = tests.select("term").distinct().withColumn("term_id", F.monotonically_increasing_id())
    terms = spark.createDataFrame(terms.collect(), terms.schema)
    index = dc.build_index(docs, terms, 13)
    windows = tests.join(terms, "term").select("win", "size", "q", "term_id")
    ids = {r["row"]: r["doc_id"] for r in index.where(F.col("term_id") == dc.LENGTH).collect()}
    found = {k: sorted({ids[r["row"]] for r in dc.matches(index, windows, 1, slop=k).collect()}) for k in (0, 1, 4)}
    assert found == {0: [1], 1: [1, 2], 4: [1, 2, 3]}


def test_keeps_clean_rows_with_all_columns(spark):
    item = " ".join(f"t{i}" for i in range(13))
    rows = [(1, item, "a", 1), (2, "clean text", "b", 2), (2, "clean text", "b", 2), (None, item + " x", "c", 3), (4, None, "d", 4),
            (5, item + " and" * 300, "e", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, win string, row long")
    kept = dc.decontaminate(docs, spark.createDataFrame([(9, item)], "item_id long, text string"))
    assert kept.columns == docs.columns
    assert sorted(tuple(r) for r in kept.select("doc_id", "win").collect()) == [(2, "b"), (2, "b"), (4, "d"), (5, "e")]


def test_decontaminate_keeps_columns_of_any_name(spark):
    text = " ".join(f"w{i}" for i in range(20))
    docs = spark.createDataFrame([(1, text, "x", 4), (2, "something else", "y", 5)], "doc_id long, text string, bad string, _bad int")
    tests = spark.createDataFrame([("i1", " ".join(f"w{i}" for i in range(15)))], "item_id string, text string")
    assert [tuple(r) for r in dc.decontaminate(docs, tests).collect()] == [(2, "something else", "y", 5)]
