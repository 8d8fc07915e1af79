"""Quality rules, line first.

Each line is judged by itself: it fails for too many symbols, for being shouted, for being navigation
(short items between separators, or no sentence at all), for one word making up most of it, for being
a fixed phrase of page furniture, or for repeating an earlier line. Failed lines are removed. A
document is rejected if too small a part of its word characters is left, beside the two base rules
(too few words; mostly repeated 3-word windows).

NULL and empty texts have no words and are rejected by the base rules. Repeated rows are judged alike.
Extra columns are ignored, or kept by ``clean``."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh, map_texts, read

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW = 3
#: A line fails above these shares: symbols per word, upper-case letters, its commonest word.
MAX_SYMBOLS = 0.3
MAX_UPPER = 0.7
MAX_ONE_WORD = 0.4
#: Lines of fewer words are too short for the shares of letters and of the commonest word.
SHARE_WORDS = 6
#: A document must keep this share of its word characters.
MIN_LEFT = 0.5
_SYMBOLS = b"#*$%&|<>"
_SENTENCE = re.compile(r"[.!?…][\"'»”’)\]]*(?:[\x20\x09-\x0D]|$)")
#: Fixed phrases of page furniture, lower case.
PHRASES = (
    r"all rights reserved|licensed under|released under the|terms of (?:use|service)|privacy policy|cookie policy|"
    r"accept cookies|subscribe to our newsletter|click here|sign up|log in|back to top|share this|skip to content|javascript")
FURNITURE = re.compile(PHRASES)
#: A line is furniture if it has no more words than this beside such a phrase.
FURNITURE_WORDS = 15


def bad_line(line: str) -> str | None:
    """The rule that ``line`` fails, or None. Lines without words fail no rule."""
    words = line.encode().split()  # of bytes: at ASCII white space only
    n = len(words)
    if not n:
        return None
    symbols = sum(map(line.count, "#*$%&|<>"))
    if symbols > MAX_SYMBOLS * n:
        return "navigation" if 2 * line.count("|") > symbols else "symbols"
    if n <= FURNITURE_WORDS and FURNITURE.search(line.lower()):
        return "furniture"
    if n >= SHARE_WORDS:
        upper = sum(map(str.isupper, line))
        if upper and upper > MAX_UPPER * sum(map(str.isalpha, line)):
            return "shouted"
        if max(Counter(words).values()) > MAX_ONE_WORD * n:
            return "one word"
        if not _SENTENCE.search(line):
            return "no sentence"
    return None


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Number of words inside windows that occur twice or more, the first occurrence included."""
    n = len(words)
    if n <= window:
        return 0
    known: dict[bytes, int] = {}
    ids = np.array([known.setdefault(w, len(known)) for w in words], dtype=np.int64)
    if len(known) == n:
        return 0
    grams = ids[: n - window + 1]
    for k in range(1, window):
        grams = grams * len(known) + ids[k: n - window + 1 + k]
        if k + 1 < window and len(known) > 1_000_000:  # keep the numbers within 64 bits
            grams = np.unique(grams, return_inverse=True)[1]
    order = np.argsort(grams, kind="stable")
    g = grams[order]
    same = np.zeros(len(g), dtype=bool)
    equal = g[1:] == g[:-1]
    same[1:] |= equal
    same[:-1] |= equal
    starts = order[same]
    covered = np.zeros(n, dtype=bool)
    for k in range(window):
        covered[starts + k] = True
    return int(covered.sum())


def judge(text: str | None) -> dict:
    """All figures of one text, its verdict and the cleaned text."""
    text = text or ""
    raw = text.encode()
    words = raw.split()
    figures = {
        "n_words": len(words), "word_chars": len(text) - sum(map(text.count, " \t\n\x0b\x0c\r")),
        "n_symbols": sum(raw.count(c) for c in _SYMBOLS)}
    figures["n_repeat_words"] = repeated_words(words)
    seen: set[str] = set()
    duplicates, kept, removed = 0, [], []
    for line in text.split("\n"):
        has_word = bool(line.encode().split())
        if has_word and line in seen:
            duplicates += 1
            removed.append(line)
            continue
        if has_word:
            seen.add(line)
        (removed if bad_line(line) else kept).append(line)
    lost = sum(len(x.translate(_NO_SPACE)) for x in removed)
    figures["n_dup_lines"] = duplicates
    figures["base_failed"] = len(words) < MIN_WORDS or 100 * figures["n_repeat_words"] > MAX_REPEAT_PERCENT * len(words)
    figures["chars_left"] = figures["word_chars"] - lost
    figures["kept"] = not figures["base_failed"] and figures["chars_left"] >= MIN_LEFT * figures["word_chars"]
    figures["clean"] = "\n".join(kept)
    return figures


_NO_SPACE = dict.fromkeys(map(ord, " \t\n\x0b\x0c\r"))
FIGURES = {"n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long", "n_repeat_words": "long",
           "base_failed": "boolean", "kept": "boolean", "chars_left": "long"}


def figures(docs: DataFrame) -> DataFrame:
    """``docs`` with the figures and the verdict of each text."""
    def judged(texts: list[str | None]) -> dict:
        got = [judge(t) for t in texts]
        return {name: [g[name] for g in got] for name in FIGURES}

    return map_texts(docs, FIGURES, judged)


def clean(docs: DataFrame) -> DataFrame:
    """The kept rows of ``docs``, their text without the failed lines."""
    kept, text = fresh("kept", docs.columns), fresh("clean", docs.columns)

    def judged(texts: list[str | None]) -> dict:
        got = [judge(t) for t in texts]
        return {kept: [g["kept"] for g in got], text: [g["clean"] for g in got]}

    out = map_texts(docs, {kept: "boolean", text: "string"}, judged).where(F.col(kept))
    return out.select(*[F.col(text).alias("text") if c == "text" else c for c in docs.columns])


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return figures(read(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


#: The same rules by DuckDB.
ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM d),
pos AS (SELECT r, unnest(range(1, len(w) - {WINDOW - 2})) AS p, w FROM w WHERE len(w) > {WINDOW}),
grams AS (SELECT r, p, count(*) OVER (PARTITION BY r, w[p], w[p + 1], w[p + 2]) AS n FROM pos),
again AS (SELECT r, count(DISTINCT p + k)::BIGINT AS n_repeat_words FROM grams, (SELECT unnest(range({WINDOW})) AS k) WHERE n > 1 GROUP BY r),
lines AS (SELECT r, k, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS lw,
        row_number() OVER (PARTITION BY r, line ORDER BY k) > 1 AS again
    FROM (SELECT r, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS k FROM d)),
common AS (SELECT r, k, max(n) AS top FROM (SELECT r, k, word, count(*) AS n FROM (SELECT r, k, unnest(lw) AS word FROM lines) GROUP BY ALL) GROUP BY r, k),
judged AS (SELECT r, len(lw) > 0 AND again AS again, len(array_to_string(lw, '')) AS chars, len(lw) > 0 AND (again
        OR len(regexp_extract_all(line, '[#*$%&|<>]')) > {MAX_SYMBOLS} * len(lw)
        OR len(lw) <= {FURNITURE_WORDS} AND regexp_matches(lower(line), '{PHRASES}')
        OR len(lw) >= {SHARE_WORDS} AND (
            len(regexp_extract_all(line, '\p{{Lu}}')) > {MAX_UPPER} * len(regexp_extract_all(line, '\p{{L}}')) AND regexp_matches(line, '\p{{Lu}}')
            OR top > {MAX_ONE_WORD} * len(lw)
            OR NOT regexp_matches(line, '[.!?…]["''»”’)\]]*([\x20\x09-\x0D]|$)'))) AS bad
    FROM lines LEFT JOIN common USING (r, k)),
sums AS (SELECT r, count(*) FILTER (again) AS n_dup_lines, coalesce(sum(chars) FILTER (bad), 0) AS lost FROM judged GROUP BY r),
f AS (SELECT doc_id, len(w)::BIGINT AS n_words, len(array_to_string(w, ''))::BIGINT AS word_chars,
        len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, lost
    FROM w JOIN sums USING (r) LEFT JOIN again USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND word_chars - lost >= {MIN_LEFT} * word_chars AS kept, (word_chars - lost)::BIGINT AS chars_left
FROM (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM f)
"""
