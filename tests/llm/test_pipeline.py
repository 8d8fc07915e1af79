import random

import pytest

import corpus_pipeline as cp
from sylva.llm import language, mixing, registry, sharding
from .test_decontaminate import words as plain_words
from .test_simhash import slow_components, slow_simhash

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """Rows before and after each stage on the smallest tables."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [("", docs, docs.collect())]
    for name, f in cp.STAGES:
        docs = cp.stored(f(spark, docs, SF), f"test-{name}")
        out.append((name, docs, docs.collect()))
    return out


def test_stages_in_order_with_the_columns_of_documents(stages):
    assert [n for n, *_ in stages[1:]] == ["language_id", "simhash_near_dedup", "benchmark_decontamination", "mixing", "sharding"]
    for name, df, _ in stages[:-1]:
        assert df.columns == COLUMNS, name
    assert stages[-1][1].columns == [*COLUMNS, "shard"]


def test_language_stage_drops_only_texts_without_letters(stages):
    before, after = stages[0][2], stages[1][2]
    want = sorted(r["doc_id"] for r in before if any(c.isalpha() for c in r["text"] or ""))
    assert sorted(r["doc_id"] for r in after) == want


def test_dedup_stage_against_brute_force(stages):
    before, after = stages[1][2], stages[2][2]
    component = slow_components([(r["doc_id"], slow_simhash(r["text"])) for r in before])
    assert sorted(r["doc_id"] for r in after) == sorted({c for *_, c in component})
    assert len(after) < len(before)


def test_decontamination_stage_against_brute_force(spark, stages):
    before, after = stages[2][2], stages[3][2]
    windows = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = plain_words(r["text"])
        windows |= {tuple(w[i:i + 13]) for i in range(max(1, len(w) - 12))} if w else set()
    sizes = {len(w) for w in windows}
    want = []
    for r in before:
        w = plain_words(r["text"])
        hit = {i + k for n in sizes for i in range(len(w) - n + 1) if tuple(w[i:i + n]) in windows for k in range(n)}
        if not (hit and 20 * len(hit) >= len(w)):
            want.append(r["doc_id"])
    assert sorted(r["doc_id"] for r in after) == sorted(want) and len(want) < len(before)


def test_mixing_stage_repeats_rows_to_the_targets(spark, stages):
    before, after = stages[3][2], stages[4][2]
    size = lambda r: len((r["text"] or "").encode().split())
    targets = {r["source"]: r["target"] for r in mixing.targets(mixing.sized(stages[3][1])).collect()}
    taken, longest, times = {}, {}, {}
    for r in before:
        longest[r["source"]] = max(longest.get(r["source"], 0), size(r))
    for r in after:
        taken[r["source"]] = taken.get(r["source"], 0) + size(r)
        times[r["doc_id"]] = times.get(r["doc_id"], 0) + 1
    assert max(times.values()) <= 3
    assert all(abs(taken.get(s, 0) - t) <= 2 * longest[s] for s, t in targets.items())


def test_sharding_stage(stages):
    before, after = stages[4][2], stages[5][2]
    assert sorted(r[:5] for r in map(tuple, after)) == sorted(map(tuple, before))
    of_text, load = {}, {}
    for r in after:
        of_text.setdefault(r["text"], set()).add(r["shard"])
        load[r["shard"]] = load.get(r["shard"], 0) + len(r["text"].encode()) + 1
    assert all(len(s) == 1 for s in of_text.values()) and set(load) == set(range(sharding.SHARDS))


def test_run_gives_the_rows_of_the_stages(spark, stages):
    assert sorted(map(tuple, cp.run(spark, SF).collect())) == sorted(map(tuple, stages[-1][2]))


def test_odd_rows_pass_through_all_stages(spark):
    """Nulls in every column, empty and long texts, repeated rows, extra columns."""
    rng = random.Random(1)
    rows = [(i, " ".join(f"word{rng.randint(0, 99)}" for _ in range(30)), "en", "s", 1, "x") for i in range(40)]
    rows += [(None, "words without an id stand in this text", None, None, None, None), (50, None, "en", "s", 1, "x"), (51, "", "en", "s", 1, "x"),
             (52, "long text " * 30_000, "en", "s", 1, "x"), (0, *rows[0][1:]), (0, *rows[0][1:])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, row string")
    for _, f in cp.STAGES:
        docs = cp.stored(f(spark, docs, SF), "odd")
    assert docs.columns == [*COLUMNS, "row", "shard"]
    assert docs.where("text IS NULL OR text = ''").count() == 0 and docs.count() > 0
    empty = spark.createDataFrame([], docs.drop("shard").schema)
    for _, f in cp.STAGES:
        empty = cp.stored(f(spark, empty, SF), "empty")
    assert empty.count() == 0


def test_each_operator_has_one_query():
    numbers = sorted(int(k[2:].split("_")[0]) for k in registry.QUERIES)
    assert numbers == list(range(1, 14)) and set(registry.ORACLES) <= set(registry.QUERIES)
    assert language.UNKNOWN == "und"


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_oracles(spark, name):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = registry.QUERIES[name](spark, SF)
    want = con.sql(registry.ORACLES[name])
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    key = lambda row: tuple(map(str, row))
    assert sorted(map(key, got.select(*columns).collect())) == sorted(map(key, want.select(*columns).fetchall()))
