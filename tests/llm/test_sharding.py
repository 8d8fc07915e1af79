import random
import zlib

import pytest

from sylva.llm import sharding as sh


def smallest(sizes, shards):
    """Brute force: try capacities one by one."""
    cap = max([max(sizes, default=0), -(-sum(sizes) // shards)])
    while True:
        used, at = 1, 0
        for s in sizes:
            if at + s > cap:
                used, at = used + 1, 0
            at += s
        if used <= shards:
            return cap
        cap += 1


def placed(docs, shards=8):
    rows = sh.place(docs)
    plan = sh.ShardPlan(rows, shards)
    out = rows.withColumn("shard", plan.shard(rows.key))
    return out.withColumn("slot", plan.slot(out.shard, out.row_pos)).collect()


@pytest.mark.parametrize("seed, shards", [(1, 8), (2, 8), (3, 3), (4, 1)])
def test_against_brute_force(spark, documents, seed, shards):
    rng = random.Random(seed)
    texts = ["x" * rng.randint(0, 60) + str(rng.randint(0, 40)) for _ in range(120)] + [None, None, "", ""]
    texts += ["hot copy"] * (80 if seed == 2 else 5)
    got = placed(documents(list(enumerate(texts))), shards)
    assert len(got) == len(texts)
    by_key, groups = {}, {}
    for r in got:
        text = texts[r["doc_id"]]
        assert r["size"] == len((text or "").encode()) + 1 and r["text_crc32"] == zlib.crc32((text or "").encode())
        by_key.setdefault(text, set()).add(r["shard"])
        groups[r["key"]] = groups.get(r["key"], 0) + r["size"]
    assert all(len(s) == 1 for s in by_key.values())  # equal texts stay together
    load = [sum(r["size"] for r in got if r["shard"] == s) for s in range(shards)]
    sizes = [groups[k] for k in sorted(groups)]
    assert max(load) <= smallest(sizes, shards)
    for s in range(shards):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))
    order = sorted(got, key=lambda r: r["row_pos"])
    assert [r["shard"] for r in order] == sorted(r["shard"] for r in got)  # contiguous


def test_shares_are_near_equal(spark, documents):
    rng = random.Random(8)
    got = placed(documents([(i, "y" * rng.randint(10, 100) + str(i)) for i in range(900)]))
    load = [sum(r["size"] for r in got if r["shard"] == s) for s in range(8)]
    assert max(load) - min(load) <= 2 * 110


def test_few_and_no_rows(spark, documents):
    assert placed(documents([])) == []
    got = placed(documents([(1, "a"), (1, "a"), (None, "b")]))
    assert sorted(r["size"] for r in got) == [2, 2, 2]
    assert sh.assign_shards(documents([])).count() == 0


def test_adds_a_shard_to_each_row(spark, documents):
    docs = documents([(1, "a"), (2, "a"), (3, None)]).withColumnRenamed("lang", "shard")
    out = sh.assign_shards(docs)
    assert sorted(out.columns) == sorted(docs.columns) and out.count() == 3
    assert out.where("text = 'a'").select("shard").distinct().count() == 1
