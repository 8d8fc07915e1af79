import math
import random

import numpy as np
import pytest

from sylva.llm import toxicity as tx


def test_nearest_is_exact():
    rng = random.Random(1)
    n_terms = 30
    idf = np.array([rng.uniform(0.5, 4) for _ in range(n_terms)])
    bags = [{rng.randrange(n_terms): rng.randint(1, 5) for _ in range(rng.randint(1, 8))} for _ in range(300)]
    index = tx.BlockMaxIndex([tx.unit(b, idf) for b in bags], n_terms, block=16)

    def cosine(a, b):
        w = lambda x: {t: (1 + math.log(c)) * idf[t] for t, c in x.items()}
        a, b = w(a), w(b)
        return sum(a[t] * b.get(t, 0) for t in a) / math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))
    for q in bags[:40]:
        got_at, got = index.nearest(*tx.unit(q, idf), 10)
        want = sorted(((round(cosine(q, b), 12), -i) for i, b in enumerate(bags)), reverse=True)[:10]
        assert np.allclose(got, [c for c, _ in want])
        assert list(got_at) == [-i for _, i in want]
    at, _ = index.nearest(*tx.unit(bags[5], idf), 10, leave_out=5)
    assert 5 not in at


def test_monotone_fit():
    x, y = tx.monotone(np.array([0.1, 0.4, 0.3, 0.9, 0.9]), np.array([0, 0, 1, 1, 1.0]))
    assert list(np.diff(y) >= 0) == [True] * (len(y) - 1) and list(x) == sorted(x)


def test_held_out_rows(spark):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = tx.op3_toxicity(spark, "/root/testdata/sf0.1").join(labels, "doc_id").where("held_out").collect()
    # an eighth of the toxic labels of this table stand at texts without any toxic word
    toxic, clean = [r for r in got if r["toxic"] == 1], [r for r in got if r["toxic"] == 0]
    assert sum(r["predicted"] for r in toxic) >= 0.85 * len(toxic)
    assert sum(r["predicted"] for r in clean) <= 0.02 * len(clean)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)


@pytest.fixture()
def labelled(spark):
    rng = random.Random(2)
    rows = []
    for i in range(300):
        bad = i % 5 == 0
        words = [f"w{rng.randrange(900)}" for _ in range(30)] + (["Nasty", "awful"] if bad else [])
        rng.shuffle(words)
        rows.append((i, " ".join(words), int(bad)))
    return rows


def test_learns_and_explains(spark, labelled):
    model = tx.learn(spark.createDataFrame(labelled, "doc_id long, text string, toxic int"))
    assert {"nasty", "awful", "nast*", "awfu*"} <= {t.decode() for t in model.terms} <= {"nasty", "awful", "nast*", "nasty*", "awfu*", "awful*"}
    assert model.score("nastiest of them")[0] > 0.9  # a form that no labelled text has
    score, evidence = model.score("some NASTY, awful thing")
    assert score > 0.9 and all(int(e) % 5 == 0 for e in evidence) and len(evidence) == 3
    assert model.score("nothing of the kind")[0] < 0.05


def test_odd_rows(spark, labelled, documents):
    train = spark.createDataFrame([*labelled, (900, None, 1), (901, "", 0), (None, "nasty awful", 1), (902, "x", None)], "doc_id long, text string, toxic int")
    model = tx.learn(train)
    docs = documents([(1, None), (2, ""), (3, "nasty " * 20_000), (3, "nasty " * 20_000), (None, "awful")]).withColumnRenamed("lang", "score")
    got = sorted((str(r["doc_id"]), r["predicted"]) for r in tx.score(docs, model).collect())
    assert got == [("1", 0), ("2", 0), ("3", 1), ("3", 1), ("None", 1)]
    none = tx.learn(spark.createDataFrame([], "doc_id long, text string, toxic int"))
    assert {r["predicted"] for r in tx.score(docs, none).collect()} == {0}
    assert tx.score(documents([]), model).count() == 0


def test_labels_of_training_rows_only(spark, documents):
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 1), (2, 0, None), (None, 1, 1), (3, 1, 0)], "doc_id long, quality int, toxic int")
    rows = tx.labelled_rows(documents([(i, "t") for i in range(6)]), labels).collect()
    assert all(r["doc_id"] in (1, 3) for r in rows)
    assert {r["toxic"] for r in rows if r["doc_id"] == 1} <= {1}


def test_words_of_one_copied_text_do_not_pass(spark, labelled):
    """Many near copies of a toxic text: its other words stand behind the same words everywhere."""
    copies = [(1000 + i, f"rare words stand in a text with nasty {i} awful things", 1) for i in range(60)]
    model = tx.learn(spark.createDataFrame(labelled + copies, "doc_id long, text string, toxic int"))
    assert b"nasty" in model.terms and not {b"rare", b"words", b"text", b"things"} & set(model.terms)


def test_copy_of_an_example_without_chosen_words(spark, labelled):
    """All words of a text are asked for, not the chosen ones alone."""
    plain = "an ordinary sentence whose words stand on no list at all"
    model = tx.learn(spark.createDataFrame([*labelled, (1001, plain, 1)], "doc_id long, text string, toxic int"))
    score, evidence = model.score(plain)
    assert evidence[0] == 1001 and score >= 0.5
    at, w = model.vector(plain)
    assert model.index.nearest(at, w, 1)[1][0] == pytest.approx(1)
    assert model.score(labelled[1][1])[1][0] == 1


def test_short_word_does_not_speak_for_longer_ones(spark):
    """A toxic word of three letters is not the beginning of other words."""
    rng = random.Random(4)
    rows = [(i, " ".join([f"w{rng.randrange(900)}" for _ in range(30)] + (["ass", f"u{i}", f"v{i}", f"x{i}"] if i % 4 == 0 else [])), int(i % 4 == 0)) for i in range(400)]
    model = tx.learn(spark.createDataFrame(rows, "doc_id long, text string, toxic int"))
    assert b"ass" in model.terms and b"ass*" not in model.terms
    assert model.score("we assume the assembly is associated")[0] < 0.5
    at, w = model.vector(rows[0][1])
    assert (w * w).sum() == pytest.approx(1)


def test_fixed_phrase_is_learned(spark):
    """A toxic word that always follows the same word, in many different texts."""
    rng = random.Random(5)
    text = lambda bad: [f"w{rng.randrange(900)}" for _ in range(15)] + (["you", "moron"] if bad else []) + [f"w{rng.randrange(900)}" for _ in range(15)]
    rows = [(i, " ".join(text(i % 5 == 0)), int(i % 5 == 0)) for i in range(300)]
    model = tx.learn(spark.createDataFrame(rows, "doc_id long, text string, toxic int"))
    assert b"moron" in model.terms
