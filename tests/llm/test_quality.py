import random
import re

from sylva.llm import quality as ql


def slow(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    twice = {g for g in grams if grams.count(g) > 1}
    covered = {i + k for i, g in enumerate(grams) if g in twice for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    duplicates = sum(x in lines[:i] for i, x in enumerate(lines))
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
            "n_dup_lines": duplicates, "n_repeat_words": len(covered), "base_failed": len(words) < 50 or 100 * len(covered) > 50 * len(words)}


def test_figures_against_brute_force():
    rng = random.Random(3)
    pieces = ["a", "b", "é", "word", "#x", "$|", "\n", "\t", "  ", "\x0b", "\x1c", "\n\n", "a b c", " same line\n", "same line\n", " "]
    texts = [None, "", "\n", "a a a", "a b a b a b"] + [" ".join(rng.choice(pieces) for _ in range(rng.randint(1, 120))) for _ in range(300)]
    for t in texts:
        got = ql.judge(t)
        assert {k: got[k] for k in slow(t)} == slow(t), t


def body_of(lines, seed=1):
    rng = random.Random(seed)
    return "\n".join(" ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 8))) for _ in range(9)) + "." for _ in range(lines))


GOOD = "This is a plain line of text, and it ends like one."


def test_lines():
    assert ql.bad_line(GOOD) is None and ql.bad_line("  ") is None
    assert ql.bad_line("Home | About | Contact | Help") == "navigation"
    assert ql.bad_line("a*** b### c$$$") == "symbols"
    assert ql.bad_line("Copyright. All rights reserved.") == "furniture"
    assert ql.bad_line("THIS LINE IS SHOUTED AT EVERYONE!!") == "shouted"
    assert ql.bad_line("spam spam spam spam spam eggs spam.") == "one word"
    assert ql.bad_line("home about contact help more less other") == "no sentence"


def test_rejects_documents_that_lose_too_much():
    body = body_of(12)
    assert ql.judge(body)["kept"]
    noisy = body + "\n" + "\n".join(f"Menu{i} | Item{i} | Other{i}" for i in range(3))
    got = ql.judge(noisy)
    assert got["kept"] and got["clean"] == body
    assert not ql.judge(body + "\n" + "\n".join(f"Menu{i} | Item{i} | Other{i} | More{i}" for i in range(90)))["kept"]


def test_table(spark, documents):
    body = body_of(12)
    rows = [(1, body + "\nAll rights reserved."), (2, None), (3, ""), (None, body), (1, body + "\nAll rights reserved."), (5, "word " * 40_000)]
    docs = documents(rows).withColumnRenamed("lang", "kept").withColumnRenamed("source", "n_words")
    assert ql.figures(docs.select("doc_id", "text", "kept")).count() == 6
    clean = ql.clean(docs)
    assert clean.columns == docs.columns
    assert sorted((str(r["doc_id"]), r["text"]) for r in clean.collect()) == [("1", body), ("1", body), ("None", body)]
    assert ql.clean(documents([])).count() == 0


def test_verdicts_follow_the_labels(spark):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = ql.op10_quality_rules(spark, "/root/testdata/sf0.1").join(labels, "doc_id").where("NOT base_failed").collect()
    good, bad = [r for r in got if r["quality"] == 1], [r for r in got if r["quality"] == 0]
    assert sum(r["kept"] for r in good) >= 0.99 * len(good)
    assert sum(r["kept"] for r in bad) <= 0.05 * len(bad)
