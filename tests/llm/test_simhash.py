import random

import pytest
import xxhash
from pyspark.sql import functions as F

from sylva.llm import simhash as sm


def slow_simhash(text, k=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in low).split(" ") if w]
    grams = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(rows, bits=4):
    fps = {f for _, f in rows}
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in fps:
        for b in fps:
            if (a ^ b).bit_count() <= bits:
                root[find(a)] = find(b)
    least = {}
    for i, f in rows:
        r = find(f)
        ids = [x for x in (i, least.get(r)) if x is not None]
        least[r] = min(ids) if ids else None
    return sorted(((i, f, least[find(f)]) for i, f in rows), key=str)


TEXTS = [None, "", "  \n", "one", "one two", "Ünïcode wörds ÀÉ hEre now", "a b c d", "a b c d e a b c d e", "tab\tand\x0bfeed\x0c x\x1cy z"]


def test_fingerprints():
    rng = random.Random(3)
    texts = TEXTS + [" ".join(rng.choice("ABCdef") * rng.randint(1, 3) for _ in range(n)) for n in (3, 4, 5, 60, 3000)]
    for t in texts:
        assert sm.simhash(t) == slow_simhash(t)


def test_jvm_hash_is_the_contracts(spark):
    got = spark.sql("SELECT xxhash64('a b c d') AS h").first()["h"]
    assert got % (1 << 64) == xxhash.xxh64_intdigest(b"a b c d", 42)


def test_components_against_brute_force(spark, documents):
    rng = random.Random(9)
    base = [" ".join(rng.choice(["x", "y", "zed", "why"]) + str(rng.randint(0, 50)) for _ in range(80)) for _ in range(12)]
    texts = TEXTS + base + base[:4] * 3
    for t in base:
        w = t.split()
        for _ in range(4):
            w[rng.randint(0, len(w) - 1)] = "changed"
            texts.append(" ".join(w))
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, base[0]), (3, "one")]
    got = sm.near_components(documents(rows)).collect()
    want = slow_components([(i, slow_simhash(t)) for i, t in rows])
    assert sorted([(r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in got], key=str) == want


@pytest.mark.parametrize("long_list", [0, 3, 1 << 30])
def test_links_of_dense_lists(spark, long_list):
    """The way of long lists connects what pairs connect."""
    rng = random.Random(4)
    fps = {0}
    for _ in range(6):
        centre = rng.getrandbits(64)
        for _ in range(25):
            fps.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))))
    signed = [f - (1 << 64) if f >= 1 << 63 else f for f in fps]
    edges = sm.links(spark.createDataFrame([(f,) for f in signed], "fp long"), long_list=long_list).collect()
    assert all(((a ^ b) % (1 << 64)).bit_count() <= 4 for a, b in edges)
    root = {f: f for f in signed}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in edges:
        root[find(a)] = find(b)
    for a in signed:
        for b in signed:
            if ((a ^ b) % (1 << 64)).bit_count() <= 4:
                assert find(a) == find(b)


def test_keeps_one_of_each_component(spark, documents):
    rows = [(5, "same text of five words"), (2, "same text of five words"), (None, "same text of five words"), (7, None), (8, ""), (9, "other words stand in here"),
            (9, "other words stand in here")]
    docs = documents(rows).withColumnRenamed("source", "fp").withColumn("component_id", F.lit(1))
    kept = sm.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 7, 9]
    assert sm.keep_one(documents([])).count() == 0
    assert sm.near_components(documents([])).count() == 0


def test_keep_one_keeps_columns_of_any_name(spark):
    rows = [(1, "a b c d e", 7, 8, 9), (2, "a b c d e", 5, 6, 7), (3, "quite another text here", 1, 2, 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _simhash long, _simhash_at long, fp long")
    assert sorted(map(tuple, sm.keep_one(df).collect())) == [rows[0], rows[2]]
