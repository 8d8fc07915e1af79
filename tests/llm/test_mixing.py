import random

import pytest

from sylva.llm import mixing as mx


def water(sizes, weights, epochs=3):
    """Targets by repeated resharing."""
    budget, target, open_ = sum(sizes), [0.0] * len(sizes), set(range(len(sizes)))
    while open_:
        level = budget / sum(weights[i] for i in open_)
        full = [i for i in open_ if level * weights[i] > epochs * sizes[i] + 1e-9]
        if not full:
            for i in open_:
                target[i] = level * weights[i]
            break
        for i in full:
            target[i] = epochs * sizes[i]
            budget -= target[i]
            open_.remove(i)
    return target


def rows_of(seed, n=400):
    rng = random.Random(seed)
    sources = ["b", "a", "Z", "é", "c", None, "z", "hot"]
    return [(i, " ".join(["w"] * rng.randint(0, 12)), "en", rng.choice(sources + ["hot"] * 6) if i % 40 else "tiny") for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_targets_and_takes(spark, documents, seed):
    rows = rows_of(seed) + [(900, None, "en", "a"), (900, None, "en", "a"), (None, "w w", "en", "b")]
    got = mx.queue(mx.sized(documents(rows))).collect()
    assert len(got) == len(rows)
    size = {}
    for r in rows:
        size[r[3]] = size.get(r[3], 0) + len((r[1] or "").split())
    order = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    want = dict(zip(order, water([size[s] for s in order], [(5, 2, 1)[i % 3] for i in range(len(order))]), strict=True))
    taken = dict.fromkeys(order, 0)
    for r in got:
        assert r["source_size"] == size[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["epochs"] <= 3
        taken[r["source"]] += r["epochs"] * r["size"]
    for s in order:
        assert abs(taken[s] - want[s]) <= 14  # about a document
    assert sum(taken.values()) <= sum(size.values())


def test_finish_times_are_fair_at_every_prefix(spark, documents):
    got = mx.queue(mx.sized(documents(rows_of(3)))).collect()
    entries = sorted((t, k, r["row_pos"], r["source"], r["size"], k < r["epochs"]) for r in got for k, t in enumerate(r["finish"]))
    spent, inside = 0, True
    budget = sum(r["size"] for r in got)
    for *_, s, taken in entries:
        spent += s
        assert taken == (inside := inside and spent <= budget)


def test_reruns_agree(spark, documents):
    rows = rows_of(4)
    a = sorted((r["doc_id"], r["epochs"]) for r in mx.queue(mx.sized(documents(rows, 2))).collect())
    random.Random(1).shuffle(rows)
    assert a == sorted((r["doc_id"], r["epochs"]) for r in mx.queue(mx.sized(documents(rows, 5))).collect())


def test_mix_repeats_rows(spark, documents):
    rows = rows_of(5) + [(7, "w w w", "en", "a")] * 3 + [(None, None, "en", None)]
    docs = documents(rows).withColumnRenamed("lang", "_n")
    epochs = {}
    for r in mx.queue(mx.sized(docs)).collect():
        epochs[r["doc_id"], r["source"], r["size"]] = epochs.get((r["doc_id"], r["source"], r["size"]), 0) + r["epochs"]
    out = mx.mix(docs)
    assert out.columns == docs.columns
    times = {}
    for r in out.collect():
        k = r["doc_id"], r["source"], len((r["text"] or "").split())
        times[k] = times.get(k, 0) + 1
    assert times == {k: n for k, n in epochs.items() if n}


def test_empty(spark, documents):
    assert mx.queue(mx.sized(documents([]))).count() == 0
    assert mx.mix(documents([])).count() == 0
    assert mx.mix(documents([(1, None), (2, "")])).count() >= 0
