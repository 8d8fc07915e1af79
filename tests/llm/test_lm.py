import math
import random
from collections import Counter

import numpy as np
import pytest

from sylva.llm import lm


@pytest.mark.parametrize("n, top", [(0, 1), (1, 1), (1, 2**64 - 1), (7, 3), (500, 10**6), (3000, 2**64 - 1), (2000, 300), (5000, 2**40)])
def test_elias_fano(n, top):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, top, n, dtype=np.uint64, endpoint=True))
    if n == 5000:
        values[1000:3000] = np.uint64(2**39) + np.arange(2000, dtype=np.uint64)  # a dense stretch
        values.sort()
    ef = lm.EliasFano.load([np.array(a) for a in lm.EliasFano.encode(values).arrays()])
    if n:
        assert (ef.at(np.arange(n)) == values).all()
        here, behind = ef.at_and_next(np.arange(n - 1))
        assert (here == values[:-1]).all() and (behind == values[1:]).all()
    asked = np.concatenate((values, values - np.uint64(1) * (values > 0), rng.integers(0, top, 500, dtype=np.uint64, endpoint=True)))
    place, same = ef.find(asked)
    assert (place == np.searchsorted(values, asked)).all()
    assert (same == np.isin(asked, values)).all()


def test_files(tmp_path):
    arrays = [np.arange(5, dtype=np.uint16), np.zeros(0, np.uint64), np.array([1, 2**63], dtype=np.uint64)]
    path = f"file:{tmp_path}/a/b.trie"
    lm.write_arrays(path, arrays)
    lm.write_arrays(path, arrays)  # a task that ran again
    got = lm.read_arrays(path)
    assert isinstance(got[0].base.base, np.memmap) and all((a == b).all() and a.dtype == b.dtype for a, b in zip(arrays, got, strict=True))
    assert [p.name for p in (tmp_path / "a").iterdir()] == ["b.trie"]


class Slow:
    """The same model by dictionaries."""

    def __init__(self, texts, order, least, discount=lm.DISCOUNT):
        self.order, self.d = order, discount
        self.counts = [Counter() for _ in range(order + 1)]
        for t in texts:
            w = self.words(t)
            self.counts[1].update((x,) for x in w)
            w = [None, *w]
            for n in range(2, order + 1):
                self.counts[n].update(tuple(w[i:i + n]) for i in range(len(w) - n + 1))
        for n in range(2, order + 1):
            self.counts[n] = {g: c for g, c in self.counts[n].items() if c >= least[n - 1] and (n == 2 or g[:-1] in self.counts[n - 1])}
        self.n, self.v = sum(self.counts[1].values()), len(self.counts[1])
        self.held = [Counter() for _ in range(order + 1)]
        for n in range(2, order + 1):
            for g, c in self.counts[n].items():
                self.held[n][g[:-1]] += c - discount

    @staticmethod
    def words(t):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        return [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in low).split(" ") if w] + [None]

    def p(self, gram):
        if len(gram) == 1:
            return (self.counts[1][gram] + 1) / (self.n + self.v + 1)
        n, context = len(gram), gram[:-1]
        shorter = self.p(gram[1:])
        if context not in self.held[n]:
            return shorter
        of = self.counts[n - 1][context]
        own = max(0, self.counts[n].get(gram, 0) - self.d) if gram in self.counts[n] else 0
        return own / of + (1 - self.held[n][context] / of) * shorter

    def score(self, t):
        w = [None, *self.words(t)]
        base = sum(math.log10((self.counts[1][(x,)] + 1) / (self.n + self.v + 1)) for x in w[1:])
        full = sum(math.log10(self.p(tuple(w[max(0, i - self.order + 1):i + 1]))) for i in range(1, len(w)))
        return len(w) - 1, sum(self.counts[1][(x,)] > 0 for x in w[1:]), base, full


@pytest.fixture()
def corpus():
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(40)] + ["The", "the", "É"]
    return [" ".join(rng.choice(vocabulary[: rng.randint(3, 43)]) for _ in range(rng.randint(0, 60))) for _ in range(120)] + [None, "", "the w1 w2", "the w1 w2"]


@pytest.mark.parametrize("order, shard", [(1, 2_000_000), (2, 2_000_000), (3, 2_000_000), (3, 60)])
def test_against_dictionaries(spark, documents, corpus, monkeypatch, order, shard):
    monkeypatch.setattr(lm, "SHARD_ENTRIES", shard)
    least = (1, 2, 2)
    about = lm.train(documents(list(enumerate(corpus))), order, least)
    if shard == 60 and order == 3:
        assert len(about.levels[1]) > 2
    slow = Slow(corpus, order, least)
    assert (about.train_tokens, about.distinct) == (slow.n, slow.v)
    asked = [*corpus[:30], "unseen words only", "the unseen w1 w2", None, "W1\tW2\nw3 " * 300]
    got = {r["doc_id"]: r for r in lm.score(documents(list(enumerate(asked))), about).collect()}
    for i, t in enumerate(asked):
        n, known, base, full = slow.score(t)
        r = got[i]
        assert (r["n_tokens"], r["n_known"]) == (n, known)
        assert r["base_score"] == pytest.approx(base)
        assert r["score"] == pytest.approx(full, abs=n * order / lm.QUANTA + 1e-9)


def test_probabilities_add_up(corpus):
    slow = Slow(corpus, 3, (1, 2, 2))
    every = [g[0] for g in slow.counts[1]]
    for context in [(None,), ("the",), ("the", "w1"), ("w1", "w2"), ("nowhere",)]:
        total = sum(slow.p((*context, w)) for w in every) + slow.p((*context, "never seen"))
        assert total == pytest.approx(1)


def test_nothing_to_learn_from(spark, documents):
    about = lm.train(documents([]))
    got = lm.score(documents([(1, "a b"), (1, "a b"), (None, None)]), about).collect()
    assert sorted((r["n_tokens"], r["n_known"], r["score"]) for r in got) == [(1, 0, 0.0), (3, 0, 0.0), (3, 0, 0.0)]
    assert lm.score(documents([]), about).count() == 0


def test_held_out_texts_are_likelier_than_by_single_tokens(spark):
    got = [r for r in lm.op8_lm_scoring(spark, "/root/testdata/sf0.01").collect() if r["held_out"]]
    assert sum(r["score"] for r in got) > 0.97 * sum(r["base_score"] for r in got)
    assert all(r["score"] <= 0 for r in got)


def test_ngrams_of_several_runs_are_counted_alike_with_numbers_of_any_size():
    rng = np.random.default_rng(5)
    held = [(rng.integers(0, 40, 500), rng.integers(0, 30, 500)) for _ in range(3)]
    plain = Counter(pair for parent, token in held for pair in zip(parent.tolist(), token.tolist(), strict=True))
    # far apart: parent and token do not fit one number
    for scale, shift in ((1, 0), (10**9, 10**10)):
        got = lm._counted([(parent * scale, token + shift) for parent, token in held])
        found = {(a // scale, b - shift): n for a, b, n in zip(*(c.to_pylist() for c in got.columns), strict=True)}
        assert found == plain
    assert lm.starts(np.array([], dtype=np.int64)).tolist() == []
    assert lm.starts(np.array([2, 2, 3])).tolist() == [True, False, True]


def test_tokens_are_those_of_plain_python():
    rng = random.Random(3)
    letters = " \t\n\x0b\x0c\r\x00\x1c\x85\xa0\u2003aAbBzZÉéİǅ😀0.,"
    for size in range(60):
        texts = [None if rng.random() < 0.1 else "".join(rng.choices(letters, k=rng.randint(0, 40))) for _ in range(size % 12)]
        plain = [[b" ", *(t or "").encode().lower().split(), b" "] for t in texts]
        hashes, which, owner, opens = lm.text_tokens(texts)
        assert hashes[which].tolist() == [lm.xxhash.xxh64_intdigest(w, lm.SEED) for words in plain for w in words]
        assert len(set(hashes.tolist())) == len(hashes) and hashes[0] == lm.xxhash.xxh64_intdigest(b" ", lm.SEED)
        assert owner.tolist() == [i for i, words in enumerate(plain) for _ in words]
        assert opens.tolist() == [j == 0 for words in plain for j in range(len(words))]


@pytest.mark.parametrize("packed", [lm.PACKED, 0])
@pytest.mark.parametrize("order, least", [(2, (1, 1)), (3, (1, 2, 2))])
def test_ngrams_are_grouped_by_one_number_where_it_has_room(spark, documents, corpus, monkeypatch, order, least, packed):
    tables, stored = {}, lm.stored
    monkeypatch.setattr(lm, "PACKED", packed)
    monkeypatch.setattr(lm, "SHARD_ENTRIES", 300)
    monkeypatch.setattr(lm, "stored", lambda df, name: tables.setdefault(name, stored(df, name)))
    about = lm.train(documents(list(enumerate(corpus))), order, least)
    key = ["gram"] if packed else ["parent", "token"]
    slow = Slow(corpus, order, least)
    assert {r["h"] % (1 << 64): r["count"] for r in tables["ngrams-1"].collect()} == {
        lm.xxhash.xxh64_intdigest(w or lm.END, lm.SEED): n for (w,), n in slow.counts[1].items()}
    for level in range(2, order + 1):
        assert [c for c in tables[f"ngrams-{level}"].columns if c not in ("lower", "count")] == key
        assert sorted(r["count"] for r in tables[f"ngrams-{level}"].collect()) == sorted(slow.counts[level].values())
        shards = about.levels[level - 1]
        assert len(shards) > 1 and len({first for *_, first, _ in shards}) == len(shards)
    asked = corpus[:20]
    got = {r["doc_id"]: r for r in lm.score(documents(list(enumerate(asked))), about).collect()}
    for i, t in enumerate(asked):
        n, known, base, full = slow.score(t)
        assert (got[i]["n_tokens"], got[i]["n_known"]) == (n, known)
        assert got[i]["base_score"] == pytest.approx(base) and got[i]["score"] == pytest.approx(full, abs=n * order / lm.QUANTA + 1e-9)


def test_packed_runs_are_counted_as_pairs_are():
    rng = np.random.default_rng(6)
    held = [(rng.integers(0, 40, 500), rng.integers(0, 30, 500)) for _ in range(3)]
    threes = [(parent, token, parent * 7 + token % 7) for parent, token in held]
    for runs in (held, threes):
        pairs, one = lm._counted(runs).to_pydict(), lm._packed(runs, 30).to_pydict()
        assert one.pop("gram") == [a * 30 + b for a, b in zip(pairs.pop("parent"), pairs.pop("token"), strict=True)]
        assert one == pairs
