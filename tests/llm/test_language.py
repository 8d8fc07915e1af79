import random

import numpy as np

from sylva.llm import language as la


def slow_phrases(text, references, piece=la.PIECE):
    """Greedy phrases of ``text`` that occur in a reference, cut at the ends of pieces."""
    n = 0
    for at in range(0, len(text), piece):
        part, i = text[at:at + piece], 0
        while i < len(part):
            j = i + 1
            while j < len(part) and any(part[i:j + 1] in r for r in references):
                j += 1
            n, i = n + 1, j
    return n


def test_letters_only():
    clean = lambda t: "".join(map(chr, la.letters_only(t)))
    assert clean("Ab1 -- C\nd") == "ab c d"
    assert clean("Été!") == "été "
    assert clean("") == "" and clean("12 34.").strip() == ""


def test_cross_parsing_against_brute_force():
    rng = random.Random(2)
    word = lambda a: "".join(rng.choice(a) for _ in range(rng.randint(1, 7)))
    samples = {"x": [" ".join(word("abcd") for _ in range(60)) for _ in range(3)], "y": [" ".join(word("cdef") for _ in range(80))]}
    parser = la.CrossParser.learn(samples)
    texts = ["", "a", "zzz", " ".join(word("abcdefz") for _ in range(500)), samples["x"][0], " ".join(word("abcd") for _ in range(90))]
    chars, counts = parser.phrases([la.letters_only(t) for t in texts])
    refs = {k: ["".join(map(chr, la.letters_only(t))) for t in v] for k, v in samples.items()}
    for t, n, c in zip(texts, chars, counts, strict=True):
        clean = "".join(map(chr, la.letters_only(t)))
        assert n == len(clean)
        assert list(c) == [slow_phrases(clean, refs["x"]), slow_phrases(clean, refs["y"])]


def test_suffix_automaton_accepts_the_substrings():
    rng = random.Random(6)
    s = [rng.randint(0, 3) for _ in range(120)]
    table = la.suffix_automaton(s, 5)
    inside = {tuple(s[i:j]) for i in range(len(s)) for j in range(i, len(s) + 1)}
    for _ in range(600):
        q = [rng.randint(0, 4) for _ in range(rng.randint(0, 7))]
        at = 0
        for c in q:
            at = int(table[at, c]) if at >= 0 else -1
        assert (at >= 0) == (tuple(q) in inside)


def test_predictions_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = la.op4_language_id(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    right = sum(r["lang"] == r["lang_pred"] for r in got)
    assert len(got) > 150 and right >= 0.97 * len(got)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_predictions_are_blind_to_batches(spark, documents):
    rows = [(i, f"the quick brown word number {i} " * (1 + i % 90), "en") for i in range(40)] + [(100 + i, f"der schnelle braune satz {i} " * 4, "de") for i in range(40)]
    a, b = documents(rows, 1), documents(rows, 7)
    parser = la.learn(la.training(a))
    one = sorted(map(tuple, la.identify(a.select("doc_id", "text"), parser).collect()))
    assert one == sorted(map(tuple, la.identify(b.select("doc_id", "text"), la.learn(la.training(b))).collect()))


def test_odd_rows(spark, documents):
    rows = [(1, "hello world of words", "en"), (2, None, "en"), (3, "", None), (4, "123 ...", "en"), (None, "hello hello", None), (1, "hello world of words", "en"),
            (9, "y" * 30_000, "en")]
    docs = documents(rows).withColumnRenamed("source", "score").withColumnRenamed("n_chars", "keep")
    got = la.identify(docs.select("doc_id", "text"), la.learn(docs)).collect()
    assert len(got) == len(rows)
    assert {(r["doc_id"], r["lang_pred"]) for r in got} == {(1, "en"), (2, "und"), (3, "und"), (4, "und"), (None, "en"), (9, "en")}
    assert all(r["score"] == 0 for r in got if r["lang_pred"] == "und")
    kept = la.keep_identified(docs)
    assert kept.columns == docs.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "1", "9", "None"]
    assert la.identify(documents([]), la.learn(documents([]))).count() == 0
    nothing = la.identify(docs.select("text"), la.learn(documents([]))).collect()
    assert {r["lang_pred"] for r in nothing} == {"und"}


def test_sample_is_bounded(spark, documents):
    docs = documents([(i, f"{i} words " * 300, "en") for i in range(50)])
    parser = la.learn(docs, reference_chars=2000, row_chars=500)
    assert len(parser.step) // parser.width <= 2 * (2000 + 64)
    assert np.all(parser.roots < len(parser.step))


def test_copies_of_one_text_do_not_fill_the_sample(spark, documents):
    rows = [(i, "copied text of one kind", "en") for i in range(900)] + [(1000 + i, f"another sentence number {chr(97 + i)}", "en") for i in range(20)]
    parser = la.learn(documents(rows))
    whole = la.letters_only("another sentence number t")
    assert parser.phrases([whole])[1][0][0] == 1


def test_scripts_of_more_letters_than_columns():
    """Latin, Cyrillic, Greek and Chinese, the last with hundreds of letters, against brute force."""
    rng = random.Random(8)
    scripts = {"en": (0x61, 26), "ru": (0x430, 32), "el": (0x3B1, 17), "zh": (0x4E00, 700), "ja": (0x5200, 300)}

    def text(lang, n):
        first, letters = scripts[lang]
        skew = lambda: chr(first + int(letters * rng.random() ** 2))
        return " ".join("".join(skew() for _ in range(rng.randint(1, 6))) for _ in range(n))
    samples = {x: [text(x, 150) for _ in range(3)] for x in scripts}
    parser = la.CrossParser.learn(samples)
    texts = [text(x, n) for x in scripts for n in (1, 3, 30)] + [text("en", 20) + text("zh", 20) + "\u0531"]
    counts = parser.phrases([la.letters_only(t) for t in texts])[1]
    clean = lambda t: "".join(map(chr, la.letters_only(t)))
    for t, c in zip(texts, counts, strict=True):
        assert list(c) == [slow_phrases(clean(t), list(map(clean, samples[x]))) for x in parser.languages]
    assert list(parser.predict(texts)["lang_pred"][:15]) == [x for x in scripts for _ in range(3)]
