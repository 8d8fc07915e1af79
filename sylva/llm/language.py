"""Language identification by cross-parsing entropy.

For each language, a suffix automaton of labelled text accepts exactly the substrings of that text.
A document is parsed against each automaton into greedy phrases: a phrase grows while the automaton
has a transition, and the next phrase starts at the character that broke it. The fewer phrases per
character, the closer the document is to the language; the smallest normalised count wins.

The automata become one dense table of transitions that also says whether a step ends a phrase, so
that numpy parses many pieces of text in step, one character of each per turn. Every letter of a
sample counts: the table has columns for the commonest ones of each language, transitions by its other
letters are looked up in a sorted list. Whole texts are parsed, in pieces of ``PIECE`` characters (a phrase also ends where a piece ends, for every language
alike).

The reference text is a bounded sample: per language, whole labelled training rows of up to
``REFERENCE_ROW_CHARS`` characters in the order of a hash, until they hold ``REFERENCE_CHARS``
characters; where these rows hold less, longer ones give what is missing. Only that sample comes
to the driver.

A NULL text, or one without a letter, is ``und`` with score 0. Ties go to the language
whose sample has most of the text's letters, then to the one that comes first by name. Rows with a NULL language teach nothing. With no labelled row at all, everything is
``und``. Repeated rows are predicted alike; extra columns are ignored, whatever their names."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import crc_of_id, fresh, map_texts, read

#: Bounds of the sample that is learned from: characters per language, and of a row that is taken first.
REFERENCE_CHARS = 24_000
REFERENCE_ROW_CHARS = 2_000
#: Letters of a language that have a column in the table; the others are looked up.
ALPHABET = 62
PIECE = 512
#: Buckets by hash in which a language's first texts are looked for.
BUCKETS = 211
UNKNOWN = "und"


def letters_only(text: str) -> np.ndarray:
    """Code points of the lower-cased text with every run of other characters as one space."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    known, index = np.unique(points, return_inverse=True)
    letter = np.array([chr(p).isalpha() for p in known], dtype=bool)[index] if len(points) else np.zeros(0, bool)
    out = np.where(letter, points, 32)
    keep = letter.copy()
    if len(out):
        keep[1:] |= letter[:-1]  # the first of each run of spaces
    return out[keep]


def transitions(codes: list[int]) -> list[dict[int, int]]:
    """Per state of the suffix automaton of ``codes``, the next state by code."""
    link, length, moves, last = [-1], [0], [{}], 0
    for c in codes:
        cur = len(moves)
        link.append(0)
        length.append(length[last] + 1)
        moves.append({})
        p = last
        while p != -1 and c not in moves[p]:
            moves[p][c] = cur
            p = link[p]
        if p != -1:
            q = moves[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                twin = len(moves)
                link.append(link[q])
                length.append(length[p] + 1)
                moves.append(moves[q].copy())
                while p != -1 and moves[p].get(c) == q:
                    moves[p][c] = twin
                    p = link[p]
                link[q] = link[cur] = twin
        last = cur
    return moves


def suffix_automaton(codes: list[int], width: int) -> np.ndarray:
    """Transitions of the suffix automaton of ``codes`` (each below ``width``): row = state, -1 = none."""
    return _table(transitions(codes), width)


def _table(moves: list[dict[int, int]], width: int) -> np.ndarray:
    """The transitions by codes below ``width`` as a table."""
    table = np.full((len(moves), width), -1, dtype=np.int32)
    for s, row in enumerate(moves):
        for c, t in row.items():
            if 0 <= c < width:
                table[s, c] = t
    return table


@dataclass
class Others:
    """A language's transitions by letters without a column: sorted keys state * letters + letter, the
    next state * width of each, and that of each letter where a phrase begins with it."""

    letters: int
    keys: np.ndarray
    to: np.ndarray
    first: np.ndarray

    def step(self, state: np.ndarray, letter: np.ndarray) -> np.ndarray:
        key = state * self.letters + letter
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, 2 * self.to[at], 2 * self.first[letter] + 1)


@dataclass
class CrossParser:
    """Tables of all languages. ``step[state * width + code]`` holds 2 * (next state * width) plus 1
    where a phrase begins; ``roots`` are the states before the first character. ``alphabet`` holds the
    code points of all samples, ``codes`` per language its code for each of them (first: of any other):
    0 if it has no such letter, ``width`` or more if the letter has no column."""

    languages: list[str]
    alphabet: np.ndarray
    step: np.ndarray
    roots: np.ndarray
    width: int
    codes: list[np.ndarray]
    others: list[Others | None]

    @classmethod
    def learn(cls, samples: dict[str, list[str]], alphabet: int = ALPHABET) -> CrossParser:
        languages = sorted(samples)
        cleaned = {x: [letters_only(t) for t in samples[x]] for x in languages}
        every = np.concatenate([p for x in languages for p in cleaned[x]] or [np.zeros(0, "<u4")])
        points = np.unique(every)
        own = [np.unique(np.concatenate(cleaned[x] or [every[:0]]), return_counts=True) for x in languages]
        width = min(alphabet, max((len(p) for p, _ in own), default=0)) + 2  # code 0: a letter of other languages; last: one without a column
        tables, roots, of_points, others, at = [], [], [], [], 0
        for x, (letters, n) in zip(languages, own, strict=True):
            rank = np.argsort(np.argsort(-n, kind="stable"), kind="stable")
            code = np.zeros(len(points) + 1, dtype=np.int32)
            code[1 + np.searchsorted(points, letters)] = np.where(rank < width - 2, rank + 1, rank + 2)
            codes: list[int] = []
            for row in cleaned[x]:
                codes += [*code[_encode(row, points)].tolist(), -1]  # -1: between two rows of the sample
            moves = transitions(codes)
            t = _table(moves, width)
            rare = sorted((((at + s) * len(letters) + c - width), (at + to) * width) for s, row in enumerate(moves) for c, to in row.items() if c >= width)
            first = np.array([(at + moves[0][c]) * width for c in range(width, len(letters) + 2)], dtype=np.int64)
            others.append(Others(len(letters), *np.array(rare, dtype=np.int64).T.copy(), first) if rare else None)
            of_points.append(code)
            # a last state without transitions: no phrase is under way, any character begins one
            t = np.concatenate((t, np.full((1, width), -1, t.dtype)))
            begins = t < 0
            t = np.where(begins, np.where(t[0] < 0, len(t) - 1, t[0]), t)
            tables.append((t, begins, at))
            at += len(t)
            roots.append((at - 1) * width)
        kind = np.int32 if at * width * 2 < 2 ** 31 else np.int64
        step = np.concatenate([((t.astype(np.int64) + of) * width * 2 + begins).astype(kind) for t, begins, of in tables]).ravel() \
            if tables else np.zeros(0, np.int32)
        return cls(languages, points, step, np.array(roots, dtype=np.int64), width, of_points, others)

    def phrases(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(characters, phrases per language) of each text of code points."""
        chars = np.array([len(t) for t in texts], dtype=np.int64)
        counts = np.zeros((len(texts), len(self.languages)), dtype=np.int64)
        pieces = -(-chars // PIECE)
        owner = np.repeat(np.arange(len(texts)), pieces)
        if not len(owner) or not self.languages:
            return chars, counts
        points = _encode(np.concatenate(texts), self.alphabet)
        starts = np.concatenate(([0], np.cumsum(chars)))[:-1]
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = starts[owner] + nth * PIECE
        size = np.minimum(PIECE, chars[owner] - nth * PIECE)
        order = np.argsort(-size, kind="stable")  # the pieces still going are a prefix
        begin, size, owner = begin[order], size[order], owner[order]
        for language, root in enumerate(self.roots):
            state = np.full(len(owner), root, dtype=np.int64)
            begun = np.zeros(len(owner), dtype=np.int32)
            going = len(owner)
            codes = self.codes[language][points]
            others = self.others[language] if (codes >= self.width).any() else None
            for k in range(int(size[0])):
                while size[going - 1] <= k:
                    going -= 1
                code = codes[begin[:going] + k]
                if others is None:
                    got = self.step[state[:going] + code]
                else:
                    got = self.step[state[:going] + np.minimum(code, self.width - 1)].astype(np.int64)
                    rare = np.flatnonzero(code >= self.width)
                    got[rare] = others.step(state[rare] // self.width, code[rare] - self.width)
                begun[:going] += got & 1
                state[:going] = got >> 1
            counts[:, language] = np.bincount(owner, weights=begun, minlength=len(texts)).astype(np.int64)
        return chars, counts

    def predict(self, texts: list[str | None]) -> pd.DataFrame:
        """lang_pred, score and phrases per character for each text. The score is the weight of
        the winner where a phrase more costs the bits of a pointer into the reference text."""
        cleaned = [letters_only(t or "") for t in texts]
        chars, counts = self.phrases(cleaned)
        out = pd.DataFrame({"lang_pred": [UNKNOWN] * len(texts), "score": [0.0] * len(texts), "rate": [0.0] * len(texts)})
        if not self.languages or not len(texts):
            return out
        best = counts.argmin(axis=1)
        for i in np.flatnonzero((counts == counts.min(axis=1, keepdims=True)).sum(axis=1) > 1):
            points = _encode(cleaned[i], self.alphabet)
            tied = np.flatnonzero(counts[i] == counts[i].min())
            best[i] = min(tied, key=lambda x: (np.count_nonzero(self.codes[x][points] == 0), x))  # noqa: B023
        bits = np.log2(max(2.0, len(self.step) / self.width / len(self.languages) / 2))
        weight = np.exp2(np.maximum(-bits * (counts - counts.min(axis=1, keepdims=True)), -200))
        some = chars > 0
        out["lang_pred"] = np.where(some, np.array(self.languages, dtype=object)[best], UNKNOWN)
        out["score"] = np.where(some, 1 / weight.sum(axis=1), 0.0)
        out["rate"] = np.where(some, counts.min(axis=1) / np.maximum(chars, 1), 0.0)
        return out


def _encode(points: np.ndarray, alphabet: np.ndarray) -> np.ndarray:
    if not len(alphabet):
        return np.zeros(len(points), np.int64)
    at = np.minimum(np.searchsorted(alphabet, points), len(alphabet) - 1)
    return np.where(alphabet[at] == points, at + 1, 0).astype(np.int64)


def learn(labelled: DataFrame, reference_chars: int = REFERENCE_CHARS, row_chars: int = REFERENCE_ROW_CHARS) -> CrossParser:
    """Automata from columns text and lang of ``labelled``, in the order of a hash of the text; equal
    texts of a language count once."""
    need = max(256, 64 * reference_chars // row_chars)  # texts per language that are enough, however short
    rows = labelled.where("lang IS NOT NULL AND text IS NOT NULL").where("length(trim(text)) > 0").select(
        "lang", F.least(F.length("text"), F.lit(reference_chars)).alias("n"), F.xxhash64("text").alias("h"), "text")
    # copies first become one row; the first texts of a language are the first among those of its buckets
    distinct = rows.groupBy("lang", (F.col("n") > row_chars).alias("long"), "h").agg(F.max("n").alias("n"))
    bucket = Window.partitionBy("lang", F.pmod("h", F.lit(BUCKETS))).orderBy("long", "h")
    distinct = distinct.withColumn("k", F.row_number().over(bucket)).where(F.col("k") <= need).drop("k")
    ranked = distinct.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("long", "h"))).where(F.col("k") <= need)
    before = Window.partitionBy("lang").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    chosen = ranked.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).where(F.col("before") < reference_chars)
    # at most `need` rows per language
    found = rows.select("lang", "h", "text").join(F.broadcast(chosen.select("lang", "h", "k", "before")), ["lang", "h"])
    first = found.groupBy("lang", "k", "before").agg(F.min(F.substring("text", 1, reference_chars)).alias("text"))
    samples: dict[str, list[str]] = {}
    for r in sorted(first.collect(), key=lambda r: (r["lang"], r["k"])):
        samples.setdefault(r["lang"], []).append(r["text"][: reference_chars - r["before"]])
    return CrossParser.learn(samples)


def identify(docs: DataFrame, parser: CrossParser) -> DataFrame:
    """The columns of ``docs`` with lang_pred, score and phrases per character (``rate``)."""
    shared = docs.sparkSession.sparkContext.broadcast(parser)
    return map_texts(docs, {"lang_pred": "string", "score": "double", "rate": "double"}, lambda texts: shared.value.predict(texts))


def training(docs: DataFrame) -> DataFrame:
    """The rows to learn from: crc32 of the id mod 4 is not 2."""
    return docs.where(crc_of_id(F.col("doc_id")) % 4 != 2)


def keep_identified(docs: DataFrame, min_score: float = 0.0) -> DataFrame:
    """The rows of ``docs`` whose language is known; ``und`` and scores below ``min_score`` go."""
    shared = docs.sparkSession.sparkContext.broadcast(learn(training(docs)))
    keep = fresh("keep", docs.columns)

    def kept(texts: list[str | None]) -> dict:
        got = shared.value.predict(texts)
        return {keep: ((got["lang_pred"] != UNKNOWN) & (got["score"] >= min_score)).to_numpy()}

    return map_texts(docs, {keep: "boolean"}, kept).where(F.col(keep)).drop(keep)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = identify(docs.select("doc_id", "text"), learn(training(docs)))
    return found.select("doc_id", (crc_of_id(F.col("doc_id")) % 4 == 2).alias("held_out"), "lang_pred", "score", "rate")
