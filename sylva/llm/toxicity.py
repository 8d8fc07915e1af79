"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Every word of a text is a term; document frequencies are counted over all labelled training rows.
Examples are a bounded sample of these rows, up to half of it of either label, in the order of a
hash of the text; each stands for the rows of its label per example. Their whole texts go into a
block-max inverted index: postings by term, and per term and block of examples the largest weight
(terms that many examples hold are kept as rows over all examples, which is exact). Every text asks
it: the block maxima bound what any example of a block can reach, the blocks of at least half the best
bound are opened first, then all that can still beat the k-th example found: the k nearest are exact.

Words, and the first letters of words for their unseen forms, that speak for toxicity are chosen
from counts over all labelled rows and are extra terms, which make up half of the squared length of
a text that has any: the lower confidence bound of the toxic rate must clear the base rate by a
factor, once over the texts that hold the term and once over the different contexts of three words
on the side where it has fewer of them, so that a word of one text with many near copies does not
pass. A beginning of k letters stands for the words of at least k letters that begin so.

Votes weigh by a power of the odds of the cosine, so that a copy outvotes texts that only share
common words, and a monotone map, fitted on the examples' own votes (each without itself), turns the
weighted share into a calibrated score. A text that shares no term with any example scores the toxic
rate of the labelled rows without chosen terms. ``evidence`` lists the ids of the nearest examples.

NULL texts have no terms. A word that no example has counts in a text's length like one of no
labelled row. Labels: a NULL label teaches nothing; an id labelled more than once counts
as toxic if any label says so; equal texts with equal labels teach once. Without labels every text
scores the same low value. Ties among neighbours go by the order of the sample. Extra columns are
ignored."""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass
from itertools import repeat

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_of_id, map_texts, read, small, stored
from .decontaminate import words

#: Bounds of what is learned: chosen terms and word beginnings, examples in the index.
MAX_TERMS = 4096
MAX_BEGINNINGS = 64
MAX_EXAMPLES = 4096
#: A term speaks for toxicity if the lower bound of its toxic rate is this many times the base rate.
LIFT = 3.0
#: A word beginning must clear this bound, as it stands for words that nobody labelled.
PURE = 0.7
#: Standard errors of that bound.
CAUTION = 4.0
#: Lengths of the word beginnings that are terms too.
BEGINNINGS = (4, 5)
#: Words on either side of a term that tell one place from another.
CONTEXT = 3
NEAREST = 15
BLOCK = 256
#: Terms that more than one in so many examples hold are kept as rows over all examples.
COMMON = 8
#: Share of the chosen terms in the squared length of a text that has any.
CHOSEN_SHARE = 0.5
EVIDENCE = 3
#: Texts whose common terms are scored in one product.
RUN = 64
#: Of the bytes of a text: A-Z in lower case, all that stands between words as a space.
_SPACED = bytes(ord(" ") if c < 128 and not chr(c).isalnum() else ord(chr(c).lower()) if c < 128 else c for c in range(256))


@dataclass
class Example:
    doc_id: object
    toxic: int
    text: str
    stands_for: float = 1.0  # labelled rows of its label per example


def unit(terms: dict[int, int], idf: np.ndarray, other: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
    """Sorted term numbers and their TF-IDF weights, scaled to length 1 with terms of no number,
    whose squared weights add up to ``other``."""
    at = np.array(sorted(terms), dtype=np.int64)
    w = (1 + np.log([terms[t] for t in at.tolist()])) * idf[at] if len(at) else np.zeros(0)
    return at, w / np.sqrt((w * w).sum() + other) if len(at) else w


def ranges(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The numbers of all ranges [begin, end), one range after the other."""
    size = end - begin
    return np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())


class BlockMaxIndex:
    """Inverted lists of the examples' weights with the maximum per term and block."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], n_terms: int, block: int = BLOCK):
        self.n, self.block = len(vectors), block
        self.blocks = -(-self.n // block)
        owner = np.repeat(np.arange(self.n), [len(t) for t, _ in vectors])
        term = np.concatenate([t for t, _ in vectors] or [np.zeros(0, np.int64)]).astype(np.int64)
        weight = np.concatenate([w for _, w in vectors] or [np.zeros(0)])
        common = np.flatnonzero(np.bincount(term, minlength=n_terms) * COMMON > self.n)
        self.row = np.full(n_terms, -1, dtype=np.int32)
        self.row[common] = np.arange(len(common))
        self.rows = np.zeros((len(common), self.n))
        dense = self.row[term] >= 0
        self.rows[self.row[term[dense]], owner[dense]] = weight[dense]
        owner, term, weight = owner[~dense], term[~dense], weight[~dense]
        order = np.lexsort((owner, term))
        self.owner, self.weight, term = owner[order].astype(np.intp), weight[order], term[order]
        # an entry per term and block: where its postings begin, and their largest weight
        key = term * max(self.blocks, 1) + self.owner // block
        self.begin = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
        self.top = np.maximum.reduceat(self.weight, self.begin) if len(key) else np.zeros(0)
        self.of_block = self.owner[self.begin] // block
        self.entries = np.searchsorted(term[self.begin], np.arange(n_terms + 1))
        self.postings = np.searchsorted(term, np.arange(n_terms + 1))
        self.begin = np.append(self.begin, len(key))

    def common(self, vectors: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """What the common terms of each vector add to the score of each example: one product for all."""
        q = np.zeros((len(vectors), len(self.rows)))
        for i, (at, w) in enumerate(vectors):
            row = self.row[at]
            is_row = row >= 0
            q[i, row[is_row]] = w[is_row]
        return q @ self.rows

    def nearest(self, at: np.ndarray, w: np.ndarray, k: int, leave_out: int = -1, common: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of largest cosine (above 0), nearest first, ties by number. ``common`` is the
        vector's row of ``common``."""
        none = np.zeros(0, np.int64), np.zeros(0)
        if not self.n or not len(at):
            return none
        base = self.common([(at, w)])[0] if common is None else common
        scores = base.copy()
        rare = self.row[at] < 0
        at, w = at[rare], w[rare]
        first, last = self.entries[at], self.entries[at + 1]
        entry = ranges(first, last)
        q, of_block = np.repeat(w, last - first), self.of_block[entry]
        bound = np.maximum.reduceat(scores, np.arange(0, self.n, self.block))
        bound = bound + np.bincount(of_block, weights=q * self.top[entry], minlength=self.blocks)
        opened = np.zeros(self.blocks, dtype=bool)
        found_at, found = none
        opening = bound >= bound.max() / 2
        while (opening & (bound > 0)).any():
            if 2 * (opened | opening).sum() > self.blocks and self.blocks > 1:
                # most blocks are needed: all postings, term by term, are cheaper than block by block
                opening = ~opened
                scores = base + self._all(at, w)
            else:
                chosen = opening[of_block]
                e = entry[chosen]
                begin, end = self.begin[e], self.begin[e + 1]
                spots = ranges(begin, end)
                scores += np.bincount(self.owner[spots], weights=np.repeat(q[chosen], end - begin) * self.weight[spots], minlength=self.n)
            if leave_out >= 0:
                scores[leave_out] = 0
            opened |= opening
            hit = np.flatnonzero(scores > 0 if opened.all() else (scores > 0) & np.repeat(opened, self.block)[:self.n])
            if len(hit) > k:  # all that tie with the k-th stay
                hit = hit[scores[hit] >= np.partition(scores[hit], len(hit) - k)[len(hit) - k] - 1e-11]
            best = np.lexsort((hit, -np.round(scores[hit], 12)))[:k]
            found_at, found = hit[best], scores[hit[best]]
            opening = ~opened & (bound >= (found[k - 1] if len(found) >= k else 0.0) - 1e-11)
        return found_at, found

    def _all(self, at: np.ndarray, w: np.ndarray) -> np.ndarray:
        """What these terms add to the score of every example."""
        first, last = self.postings[at], self.postings[at + 1]
        spots = ranges(first, last)
        return np.bincount(self.owner[spots], weights=np.repeat(w, last - first) * self.weight[spots], minlength=self.n)


def monotone(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """First and last points of the best non-decreasing fit of y by x: pool neighbours that are out of order."""
    order = np.argsort(x, kind="stable")
    weight = np.ones(len(x)) if weight is None else weight * len(x) / weight.sum()
    pools: list[list[float]] = []  # sum, count, first x, last x
    for a, b, n in zip(x[order].tolist(), y[order].tolist(), weight[order].tolist(), strict=True):
        pools.append([b * n, n, a, a])
        while len(pools) > 1 and (pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1] or pools[-2][2] == pools[-1][2]):
            last = pools.pop()
            pools[-1][0] += last[0]
            pools[-1][1] += last[1]
            pools[-1][3] = last[3]
    values = np.maximum.accumulate([(p[0] + 0.5) / (p[1] + 1) for p in pools])
    return np.array([v for p in pools for v in p[2:]]), np.repeat(values, 2)


class ToxicityModel:
    """``terms`` are the chosen ones; ``df`` the labelled rows, of ``n``, that hold a word of the examples."""

    def __init__(self, terms: dict[str, int], idf: np.ndarray, examples: list[Example], rate_without: float, k: int = NEAREST,
                 df: dict[str, int] | None = None, n: int = 0):
        self.terms = {t.encode(): i for t, i in terms.items()}
        self.beginnings = {t[:-1]: i for t, i in self.terms.items() if t.endswith(b"*")}
        self.lengths = sorted({len(t) for t in self.beginnings})
        self.idf, self.k, self.rate_without = idf, k, rate_without
        self.vocabulary = {w: i for i, w in enumerate(sorted({w for e in examples for w in spaced(e.text).split()}))}
        self.begun = {w: found for w in self.vocabulary if (found := self.begins(w))}
        self.other = math.log(1 + n) + 1
        self.word_idf = np.array([math.log((1 + n) / (1 + (df or {}).get(w.decode(), 0))) + 1 for w in self.vocabulary])
        self.ids = [e.doc_id for e in examples]
        self.toxic = np.array([e.toxic for e in examples], dtype=float)
        self.stands_for = np.array([e.stands_for for e in examples], dtype=float)
        vectors = [self.vector(e.text) for e in examples]
        self.index = BlockMaxIndex(vectors, len(self.vocabulary) + len(terms))
        own = [self._vote(*v, leave_out=i)[0] for i, v in enumerate(vectors)]
        known = np.array([x is not None for x in own], dtype=bool)
        self.steps, self.values = monotone(np.array([x for x in own if x is not None]), self.toxic[known], self.stands_for[known]) if known.any() \
            else (np.zeros(1), np.array([rate_without]))

    def vector(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Term numbers and weights: the words of the examples, then the chosen terms."""
        flat = spaced(text)
        words = Counter(flat.split())
        number = self.vocabulary.get
        ids = np.fromiter(map(number, words, repeat(-1)), dtype=np.int64, count=len(words))
        tf = 1 + np.log(np.fromiter(words.values(), dtype=np.float64, count=len(words)))
        known = ids >= 0
        other = (tf[~known] ** 2).sum() * self.other ** 2
        order = np.argsort(ids[known])
        at = ids[known][order]
        w = tf[known][order] * self.word_idf[at]
        w = w / np.sqrt((w * w).sum() + other) if len(at) else w
        chosen = {self.terms[t]: words[t] for t in self.terms.keys() & words.keys()}
        if self.beginnings:  # those of known words are listed, the others are looked up
            begun = [(word, t) for word in self.begun.keys() & words.keys() for t in self.begun[word]]
            begun += [(word, t) for word, i in zip(words, ids.tolist(), strict=True) if i < 0 for t in self.begins(word)]
            for word, t in begun:
                chosen[t] = chosen.get(t, 0) + words[word]
        if not chosen:
            return at, w
        more, x = unit(chosen, self.idf)
        return np.concatenate((at, more + len(self.vocabulary))), np.concatenate((w * math.sqrt(1 - CHOSEN_SHARE), x * math.sqrt(CHOSEN_SHARE)))

    def begins(self, word: bytes) -> list[int]:
        """The chosen beginnings of a word."""
        return [self.beginnings[word[:k]] for k in self.lengths if len(word) >= k and word[:k] in self.beginnings]

    def _vote(self, at: np.ndarray, w: np.ndarray, leave_out: int = -1, common: np.ndarray | None = None) -> tuple[float | None, np.ndarray]:
        near, cosine = self.index.nearest(at, w, self.k, leave_out, common)
        if not len(near):
            return None, near
        cosine = np.minimum(cosine, 1.0)
        weight = (cosine / (1.01 - cosine)) ** 2 * self.stands_for[near]
        return round(float((weight * self.toxic[near]).sum() / weight.sum()), 9), near

    def score(self, text: str | None) -> tuple[float, list]:
        return self.scores([text])[0]

    def scores(self, texts: list[str | None], run: int = RUN) -> list[tuple[float, list]]:
        """(score, evidence) of each text; the common terms of a run of texts are scored at once."""
        out: list[tuple[float, list]] = []
        for first in range(0, len(texts), run):
            vectors = [self.vector(t) for t in texts[first: first + run]]
            for v, common in zip(vectors, self.index.common(vectors), strict=True):
                vote, near = self._vote(*v, common=common)
                out.append((self.rate_without, []) if vote is None else
                           (float(np.interp(vote, self.steps, self.values)), [self.ids[i] for i in near[:EVIDENCE]]))
        return out


def spaced(text: str | None) -> bytes:
    """The words of a text in lower case, each behind a space, so that a beginning is what follows one."""
    return b" " + (text or "").encode("utf-8", "replace").translate(_SPACED)


def beginning(word: Column, letters: int) -> Column:
    """The term for the first letters of ``word``; NULL for a word of fewer."""
    return F.when(F.length(word) >= letters, F.concat(F.substring(word, 1, letters), F.lit("*")))


def terms_of(word: Column) -> Column:
    """An array of the word and its beginnings; a beginning is NULL for a shorter word."""
    return F.array(word, *[beginning(word, k) for k in BEGINNINGS])


def places_of(w: Column, words: int = CONTEXT) -> Column:
    """An array with a struct per word of ``w``: the word (w) and the hashes of the words to its left
    and right (l1, r1, ...); the text goes on at its other end."""
    h = F.transform(w, lambda x: F.xxhash64(x))
    sides = [w.alias("w")]
    for j in range(1, words + 1):
        sides += [F.concat(F.slice(h, -j, j), h).alias(f"l{j}"), F.concat(F.slice(h, F.lit(j + 1), F.size(h)), F.slice(h, 1, j)).alias(f"r{j}")]
    return F.arrays_zip(*sides)


def lower_bound(hits: Column, n: Column, errors: float = CAUTION) -> Column:
    """Lower end of the Wilson interval of the rate hits / n."""
    z2, rate = errors ** 2, hits / n
    spread = errors * F.sqrt(rate * (1 - rate) / n + z2 / (4 * n * n))
    return (rate + z2 / (2 * n) - spread) / (1 + z2 / n)


def learn(labelled: DataFrame, max_terms: int = MAX_TERMS, max_examples: int = MAX_EXAMPLES) -> ToxicityModel:
    """A model from doc_id, text and toxic of ``labelled``. Counts are over all its rows; only the
    chosen terms, the bounded sample of examples and the counts of its words come to the driver."""
    rows = labelled.where("toxic IS NOT NULL").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.col("toxic").cast("int").alias("toxic"))
    rows = rows.withColumn("h", F.xxhash64("text"))
    bags = rows.select("doc_id", "toxic", "h", words(F.col("text")).alias("w"))
    firsts = stored(rows.groupBy("h", "toxic").agg(F.min("doc_id").alias("first")), "toxic-texts")
    n, n_toxic = firsts.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    is_first = (F.col("h") == F.col("of")) & (F.col("doc_id") == F.col("first"))
    once = bags.join(small(firsts.select(F.col("h").alias("of"), "first"), n), is_first, "left_semi")
    base = n_toxic / max(n, 1)
    least = F.when(F.col("term").endswith("*"), PURE).otherwise(min(0.5, LIFT * base))
    begun = F.concat(*[F.transform("w", lambda x: beginning(x, k)) for k in BEGINNINGS])  # noqa: B023
    per = stored(once.select("toxic", F.explode(F.array_distinct(F.concat("w", begun))).alias("term")).where("term IS NOT NULL")
                 .groupBy("term").agg(F.count("*").alias("df"), F.sum("toxic").alias("bad")), "toxic-counts")
    likely = per.withColumn("low", lower_bound(F.col("bad"), F.col("df"))).where(F.col("low") >= least) \
        .orderBy(F.desc("low"), "term").limit(4 * max_terms)
    likely = stored(likely.select("term", "df"), "toxic-terms")
    # where the likely terms stand: the words on either side of each of them. The words that hold a term
    # are found among the distinct ones, so that each place is looked up once
    holders = per.where("NOT endswith(term, '*')").select(F.col("term").alias("w"), F.explode(terms_of(F.col("term"))).alias("term"))
    holders = stored(holders.join(F.broadcast(likely.select("term")), "term"), "toxic-holders")  # 4 * max_terms rows at most
    spots = once.select("toxic", "h", F.explode(places_of(F.col("w"))).alias("s")).select("toxic", "h", "s.*")
    sides = [F.xxhash64(*[f"{x}{j}" for j in range(1, CONTEXT + 1)]).alias(x) for x in "lr"]
    spots = stored(spots.join(small(holders, holders.count()), "w").select("term", "toxic", "h", *sides), "toxic-places")
    each = F.explode(F.array(*[F.struct(F.lit(x).alias("side"), F.col(x).alias("words")) for x in "lr"]))
    places = spots.select("term", "toxic", each.alias("c")).groupBy("term", "c") \
        .agg(F.max("toxic").alias("bad"), (1 - F.min("toxic")).alias("good")).groupBy("term", "c.side") \
        .agg(F.sum("bad").alias("bad"), F.sum(F.col("bad") + F.col("good")).alias("places"))
    places = places.groupBy("term").agg(F.min(lower_bound(F.col("bad"), F.col("places"))).alias("low"))
    chosen = places.where(F.col("low") >= least).join(likely, "term").orderBy(F.desc("low"), "term").limit(max_terms).collect()
    beginnings = [r["term"] for r in chosen if r["term"].endswith("*")]
    chosen = [r for r in chosen if r["term"] not in beginnings[MAX_BEGINNINGS:]]
    terms = {r["term"]: i for i, r in enumerate(chosen)}
    idf = np.array([math.log((1 + n) / (1 + r["df"])) + 1 for r in chosen])
    with_terms, toxic_with = 0, 0
    if terms:
        listed = F.broadcast(labelled.sparkSession.createDataFrame([(t,) for t in terms], "term string"))  # max_terms rows at most
        with_terms, toxic_with = spots.join(listed, "term", "left_semi").select("h", "toxic").distinct() \
            .agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    # up to half of the examples of either label, the rest of the other one
    n_clean = n - n_toxic
    take = {1: min(n_toxic, max(max_examples // 2, max_examples - n_clean))}
    take[0] = min(n_clean, max_examples - take[1])
    picked = [firsts.where(F.col("toxic") == x).orderBy("h").limit(take[x]) for x in (0, 1)]
    picked = picked[0].union(picked[1]).select(F.col("h").alias("of"), "first", F.col("toxic").alias("label"))  # max_examples rows at most
    sample = stored(rows.join(F.broadcast(picked), is_first & (F.col("toxic") == F.col("label")), "left_semi").dropDuplicates(["h", "toxic"]), "toxic-sample")
    used = sample.select(F.explode(words(F.col("text"))).alias("term")).distinct()
    df = {r["term"]: r["df"] for r in per.join(used, "term", "left_semi").select("term", "df").collect()}
    found = sorted(sample.collect(), key=lambda r: (r["h"], r["toxic"]))
    examples = [Example(r["doc_id"], r["toxic"], r["text"], (n_toxic if r["toxic"] else n_clean) / take[r["toxic"]]) for r in found]
    return ToxicityModel(terms, idf, examples, (n_toxic - toxic_with + 0.5) / (n - with_terms + 2), df=df, n=n)


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``docs`` with score, predicted and evidence (ids of the nearest examples, as text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(texts: list[str | None]) -> dict:
        got = shared.value.scores(texts)
        return {"score": [s for s, _ in got], "predicted": [int(s >= 0.5) for s, _ in got], "evidence": [[str(i) for i in e] for _, e in got]}

    return map_texts(docs, {"score": "double", "predicted": "int", "evidence": "array<string>"}, scored)


def labelled_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text and toxic of the training rows: labelled, and crc32 of the id mod 5 is not 0."""
    by_id = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where("toxic IS NOT NULL")
    by_id = by_id.where(crc_of_id(F.col("doc_id")) % 5 != 0)
    return docs.select("doc_id", "text").join(small(by_id, by_id.count()), "doc_id")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = learn(labelled_rows(docs, read(spark, sf_dir, "labels")))
    return score(docs.select("doc_id", "text"), model).select(
        "doc_id", (crc_of_id(F.col("doc_id")) % 5 == 0).alias("held_out"), "score", "predicted", "evidence")
