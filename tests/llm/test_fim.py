import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from sylva.llm import fim

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
PIECES = ["a", "word", "é", "€", "😀", " ", "  ", "\n", "\t", "\x0b", "\x0c", "\r", "\x08", "\x0e", "\x1f", "!", "\x7f", " ", " ", "\x00", "<", "<S", "S>", "P>", "Ġ"]


def some_texts(n, seed, pieces=PIECES, longest=40):
    rng = random.Random(seed)
    return ["".join(rng.choice(pieces) for _ in range(rng.randint(0, longest))) for _ in range(n)]


def slow(doc_id, text, seed=42):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k:8 * k + 8], 16) for k in range(4))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    p, m, s = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
    if h4 % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_marks_of_every_byte():
    every = np.arange(256, dtype=np.uint8)
    for shift in range(8):  # in every place of a word, beside every neighbour
        rolled = np.roll(every, shift)
        space = fim.space_marks(rolled.view("<u8")).view(np.uint8)
        inner = fim.inner_marks(rolled.view("<u8")).view(np.uint8)
        assert [b for b, x in zip(rolled.tolist(), space.tolist()) if x] == [b for b in rolled.tolist() if b == 32 or 9 <= b <= 13]
        assert [b for b, x in zip(rolled.tolist(), inner.tolist()) if x] == [b for b in rolled.tolist() if 128 <= b < 192]


def test_rank_and_select():
    rng = np.random.default_rng(1)
    marks = rng.integers(0, 2**63, 50, dtype=np.uint64) & rng.integers(0, 2**63, 50, dtype=np.uint64) & fim._HIGH
    at = np.flatnonzero(marks.view(np.uint8))
    m = fim.Marks(marks)
    assert m.select(np.arange(1, len(at) + 1)).tolist() == at.tolist()
    assert m.rank(np.arange(399)).tolist() == [int((at < p).sum()) for p in range(399)]


def test_cuts_against_the_pattern():
    texts = ["", " ", "a", "a ", " a", *some_texts(2000, 2)]
    array = pa.array(["x", *texts])[1:]  # a slice, whose offsets do not begin at 0
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 2**32, len(texts)), rng.integers(0, 2**32, len(texts))
    raw, begin, one, two, end, n, chars = fim.cut(array, a, b)
    for i, t in enumerate(texts):
        units = UNIT.findall(t)
        x, y = sorted((int(a[i]) % (len(units) + 1), int(b[i]) % (len(units) + 1)))
        assert n[i] == len(units)
        got = [raw[p:q].decode() for p, q in ((begin[i], one[i]), (one[i], two[i]), (two[i], end[i]))]
        assert got == ["".join(u) for u in (units[:x], units[x:y], units[y:])]
        assert [len(g) for g in got] == np.diff(chars[:, i]).tolist()


@pytest.mark.parametrize("size", [1, 50, 10**9])
def test_runs_cover_all_rows(size):
    array = pa.array(some_texts(100, 4))
    got = list(fim.runs(array, size))
    assert [a for a, _ in got] == [sum(n for _, n in got[:k]) for k in range(len(got))] and sum(n for _, n in got) == 100


def test_transform(spark):
    rows = list(enumerate(some_texts(400, 5)))
    rows += [(-7, None), (None, "a b c d"), (None, None), (900, "x <P> y z"), (901, "lorem ipsum\n" * 60_000), (5, rows[5][1]), (5, rows[5][1])]
    df = spark.createDataFrame([(i, t, "mine", 3) for i, t in rows], "doc_id long, text string, _h0 string, n_units int").repartition(5)
    got = fim.transform(df)
    assert got.columns == ["doc_id", "text", "_h0", "n_units", "form", "prefix_chars", "middle_chars", "output"]
    found = got.withColumn("back", fim.restored(got.output, got.form)).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in found), key=str) == sorted(rows, key=str)
    forms = set()
    for r in found:
        assert (r["n_units"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == slow(r["doc_id"], r["text"])
        assert r["back"] == (r["text"] or "") and r["_h0"] == "mine"
        forms.add(r["form"])
    assert forms == {"plain", "psm", "spm"}
    assert fim.transform(df.limit(0)).count() == 0


def test_query(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    got = {r["doc_id"]: r for r in fim.op12_fill_in_middle(spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == len(docs)
    for d in docs:
        n, form, prefix, middle, output = slow(d["doc_id"], d["text"])
        r = got[d["doc_id"]]
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"]) == (n, form, prefix, middle)
        assert r["output_sha256"] == hashlib.sha256(output.encode()).hexdigest()
        assert r["restored_sha256"] == hashlib.sha256((d["text"] or "").encode()).hexdigest()
