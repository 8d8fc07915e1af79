import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from sylva.llm import rules as ru

SPACE = r"[\x20\x09-\x0D]+"


def slow(text):
    """The statistics of one text."""
    text = text or ""
    words, lines = re.findall(r"[^\x20\x09-\x0D]+", text), text.split("\n")
    solid = sum(map(len, words))
    upper = sum(c.isupper() and c.isalpha() for c in text)
    stops = len(re.findall(r"[.!?](?=[\x20\x09-\x0D]|\Z)", text))
    per = lambda a, b: a / max(b, 1)
    count = lambda chars: sum(map(text.count, chars))
    return {"log_words": math.log1p(len(words)), "word_length": per(solid, len(words)), "symbols_per_word": per(count(ru.SYMBOLS), len(words)),
            "bars_per_word": per(count("|"), len(words)), "digit_share": per(count("0123456789"), solid), "mark_share": per(count(".,;:!?"), solid),
            "shouts_per_word": per(count("!"), len(words)), "upper_share": per(upper, solid), "words_per_stop": per(len(words), stops),
            "words_per_line": per(len(words), len(lines)), "different_lines": per(len(set(lines)), len(lines)),
            "different_words": per(len(set(re.split(SPACE, text))), len(words))}


def holds(rule, s):
    return all(a < s[k] <= b for k, (a, b) in rule.items())


TEXTS = [None, "", " ", "\n", "A plain line. And one more!", "THIS IS!! LOUD!!", "a | b | c", "a\na\nb", "é É ß 12 #x $y", "word " * 40_000, "x\x85y\x1fz", "a\\b[c]"]


def test_statistics(spark):
    df = spark.createDataFrame([(i, t, "mine") for i, t in enumerate(TEXTS)], "i int, text string, _chars string")
    out, names = ru.described(df)
    assert set(out.columns) == {"i", "text", "_chars", *names.values()}
    for r in out.collect():
        want = slow(r["text"])
        assert {k: r[n] for k, n in names.items()} == pytest.approx(want), r["text"]
        assert tuple(want) == ru.STATISTICS


DRAWING = """RandomForestClassificationModel: uid=x, numTrees=2, numClasses=2, numFeatures=12
  Tree 0 (weight 1.0):
    If (feature 0 <= 1.5)
     If (feature 2 <= 0.25)
      Predict: 0.0
     Else (feature 2 > 0.25)
      If (feature 0 <= -1.0E-4)
       Predict: 1.0
      Else (feature 0 > -1.0E-4)
       Predict: 0.0
    Else (feature 0 > 1.5)
     Predict: 1.0
  Tree 1 (weight 1.0):
    If (feature 0 <= 1.5)
     Predict: 0.0
    Else (feature 0 > 1.5)
     Predict: 1.0
"""


def test_paths_of_trees():
    inf = math.inf
    assert ru.tree_rules(DRAWING) == [
        {"log_words": (-inf, 1.5)}, {"log_words": (-inf, 1.5), "symbols_per_word": (-inf, 0.25)}, {"log_words": (-inf, 1.5), "symbols_per_word": (0.25, inf)},
        {"log_words": (-inf, -1e-4), "symbols_per_word": (0.25, inf)}, {"log_words": (-1e-4, 1.5), "symbols_per_word": (0.25, inf)}, {"log_words": (1.5, inf)}]
    assert ru.tree_rules("  Tree 0 (weight 1.0):\n    Predict: 1.0\n") == []


def test_scores_against_plain_rules(spark):
    inf = math.inf
    model = ru.RuleEnsemble(-0.5, [({"log_words": (-inf, 3.0)}, 1.25), ({"upper_share": (0.5, inf), "shouts_per_word": (0.1, 2.5)}, -3.0), ({"bars_per_word": (0.2, inf)}, -0.75)])
    df = spark.createDataFrame([(i, t, 5, "kept") for i, t in enumerate(TEXTS)] + [(4, TEXTS[4], 5, "kept")], "doc_id int, text string, score int, _score string").repartition(3)
    got = ru.score(df, model)
    assert got.columns == ["doc_id", "text", "_score", "score", "predicted", "n_rules"]
    rows = got.collect()
    assert len(rows) == len(TEXTS) + 1
    for r in rows:
        found = [w for rule, w in model.rules if holds(rule, slow(r["text"]))]
        value = 1 / (1 + math.exp(-(model.base + sum(found))))
        assert r["score"] == pytest.approx(value) and r["predicted"] == int(value >= 0.3) and r["n_rules"] == len(found)
    assert ru.score(df.limit(0), model).count() == 0
    assert len(model.described()) == 3 and "upper_share > 0.5" in model.described()[0]


def test_compiled_into_one_stage(spark):
    """Scoring is a projection: no Python, no shuffle, every count made once."""
    model = ru.RuleEnsemble(0.0, [({"upper_share": (0.1 * k, math.inf)}, 1.0) for k in range(9)])
    df = spark.createDataFrame([(1, "a")], "doc_id int, text string")
    plan = ru.score(df, model)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
    assert plan.count(r"\p{Lu}") == 1


def texts_of(kind, n, rng):
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8)))
    plain = [" ".join(word() for _ in range(rng.randint(5, 40))).capitalize() + "." for _ in range(n)]
    return plain if kind else [t.upper().replace(" ", "!! ") if i % 2 else t.replace(" ", "$$$ ") for i, t in enumerate(plain)]


def test_learns(spark):
    rng = random.Random(1)
    rows = [(t, y) for y in (0, 1) for t in texts_of(y, 150, rng)] + [("no label", None), (None, 1)]
    model = ru.learn(spark.createDataFrame(rows, "text string, quality int").repartition(4))
    assert model.rules
    new = [(t, y) for y in (0, 1) for t in texts_of(y, 100, rng)]
    got = ru.score(spark.createDataFrame(new, "text string, y int"), model).collect()
    assert sum(r["predicted"] == r["y"] for r in got) >= 195
    again = ru.learn(spark.createDataFrame(rows, "text string, quality int").repartition(4))
    assert again.base == pytest.approx(model.base) and [r for r, _ in again.rules] == [r for r, _ in model.rules]


@pytest.mark.parametrize("labels, share", [([], 0.5), ([1, 1, 1], 3.5 / 4), ([0, None], 0.5 / 2)])
def test_labels_of_one_kind(spark, labels, share):
    model = ru.learn(spark.createDataFrame([("some text", y) for y in labels], "text string, quality int"))
    got = ru.score(spark.createDataFrame([("a",), (None,)], "text string"), model).collect()
    assert [r["score"] for r in got] == [pytest.approx(share)] * 2


def test_training_rows(spark, documents):
    docs = documents([(i, f"t{i}") for i in range(20)] + [(None, "n"), (3, "t3")])
    labels = spark.createDataFrame([(i, 1) for i in range(15)] + [(3, 0), (4, None), (None, 1), (99, 0)], "doc_id long, quality int")
    got = sorted((r["text"], r["quality"]) for r in ru.labelled_rows(docs, labels).collect())
    ids = [i for i in [*range(15), 3] if zlib.crc32(str(i).encode()) % 5]
    assert got == sorted((f"t{i}", 0 if i == 3 else 1) for i in ids)


def test_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    got = ru.op11_quality_classifier(spark, sf)
    assert got.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    held = got.where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    n, right = held.agg(F.count("*"), F.sum((F.col("predicted") == F.col("quality")).cast("int"))).first()
    assert right >= 0.95 * n > 0
    assert got.where("score NOT BETWEEN 0 AND 1 OR predicted <> cast(score >= 0.3 AS int)").count() == 0
