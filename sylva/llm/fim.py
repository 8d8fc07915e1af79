"""Fill-in-the-middle transformation, with units found a machine word at a time.

A unit is a run of white space with the word behind it, or the white space at the end of a text. Every
unit but the last ends where a word is followed by white space, so units are counted without being
formed: the UTF-8 bytes of a run of texts are viewed as 64-bit words, arithmetic on whole words marks
each byte that ends a unit (and each byte that goes on a character), ``bitwise_count`` counts the
marks of a word and their running sums are an index. The k-th unit of a text ends in the word that a binary
search in the sums finds, at the byte that is left when the lower marks of that word are cleared.

``transform`` cuts every text at two random unit borders, drawn from a hash of seed and id, and puts
the parts in the order prefix, suffix, middle (psm) or suffix, prefix, middle (spm) behind sentinels;
``restored`` puts an output together again. A task holds about ``RUN_BYTES`` of texts at a time (more
only if one text is longer), and no row meets another one.

NULL texts are empty; an empty text and one that contains a sentinel stay as they are (plain). A NULL
id counts as an empty one. Very long texts are cut like any other. Repeated rows are transformed alike,
there are no ties, an empty table gives an empty one. Columns of the input stay; those that have the
name of an added one (n_units, form, prefix_chars, middle_chars, output) give way to it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import fresh, read

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 42
#: Of a hundred texts so many are transformed, and so many of these suffix first.
TRANSFORMED, SUFFIX_FIRST = 50, 80
RUN_BYTES = 8_000_000
ADDED = {"n_units": "long", "form": "string", "prefix_chars": "long", "middle_chars": "long", "output": "string"}
_TYPES = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]


def _each(byte: int) -> np.uint64:
    """A word with ``byte`` in each of its eight bytes."""
    return np.uint64(byte * 0x0101010101010101)


_HIGH, _LOW7, _SPACE = _each(0x80), _each(0x7F), _each(0x20)
_FROM_9, _FROM_14 = _each(0x80 - 9), _each(0x80 - 14)
_ONE = np.uint64(1)


def space_marks(words: np.ndarray) -> np.ndarray:
    """The high bit of each byte that is a blank or in 9 to 13."""
    low = words & _LOW7
    other = words ^ _SPACE
    blank = ~(((other & _LOW7) + _LOW7) | other)
    control = (low + _FROM_9) & ~(low + _FROM_14) & ~words
    return (blank | control) & _HIGH


def inner_marks(words: np.ndarray) -> np.ndarray:
    """The high bit of each byte that goes on a character of several bytes (10xxxxxx)."""
    return words & ~(words << _ONE) & _HIGH


class Marks:
    """Marked bytes of a text buffer, with running counts per word."""

    def __init__(self, marks: np.ndarray):
        self.marks = marks
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(marks), dtype=np.int64)))

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Number of marks at bytes before ``at``."""
        word, byte = at >> 3, (at & 7).astype(np.uint64)
        below = (_ONE << (byte << np.uint64(3))) - _ONE
        return self.before[word] + np.bitwise_count(self.marks[word] & below)

    def select(self, k: np.ndarray) -> np.ndarray:
        """The byte of the k-th mark, counted from 1."""
        word = np.searchsorted(self.before, k, side="left") - 1
        left, marks = k - self.before[word], self.marks[word]
        for step in range(2, 9):  # a word has eight bytes at most to choose from
            marks = np.where(left >= step, marks & (marks - _ONE), marks)
        lowest = marks & (~marks + _ONE)
        return (word << 3) + (np.bitwise_count(lowest - _ONE) >> 3)


def cut(texts: pa.Array, a: np.ndarray, b: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, begin, first cut, second cut, end, units, characters before each of the four places) of the
    texts: cuts are after the smaller and the larger of a % (units + 1) and b % (units + 1) units."""
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset: texts.offset + len(texts) + 1].astype(np.int64)
    base, size = int(offsets[0]), int(offsets[-1] - offsets[0])
    raw = texts.buffers()[2]
    raw = raw.slice(base, size).to_pybytes() if raw is not None and size else b""
    padded = np.full((size // 8 + 2) * 8, 0x20, dtype=np.uint8)
    padded[:size] = np.frombuffer(raw, dtype=np.uint8)
    words = padded.view("<u8")
    begin, end = offsets[:-1] - base, offsets[1:] - base
    space = space_marks(words)
    follows = np.append(space[1:], np.uint64(0)) << np.uint64(56)
    ends = ~space & ((space >> np.uint64(8)) | follows) & _HIGH
    last = end[end > begin] - 1  # the last byte of a text ends its last unit
    np.bitwise_or.at(ends, last >> 3, np.uint64(0x80) << ((last & 7).astype(np.uint64) << np.uint64(3)))
    units, inner = Marks(ends), Marks(inner_marks(words))
    first = units.rank(begin)
    n = units.rank(end) - first
    x, y = a % (n + 1), b % (n + 1)

    def after(k: np.ndarray) -> np.ndarray:
        places = begin.copy()
        some = k > 0
        places[some] = units.select(first[some] + k[some]) + 1
        return places

    one, two = after(np.minimum(x, y)), after(np.maximum(x, y))
    return raw, begin, one, two, end, n, np.stack([p - inner.rank(p) for p in (begin, one, two, end)])


def runs(texts: pa.Array, size: int = RUN_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows, (first, number), of about ``size`` bytes of text."""
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset: texts.offset + len(texts) + 1]
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, int(offsets[at]) + size, side="right")) - 1)
        yield at, to - at
        at = to


def arranged(texts: pa.Array, draws: list[np.ndarray]) -> list[list]:
    """The added columns for texts without NULL and their four draws."""
    raw, begin, one, two, end, n, chars = cut(texts, draws[0], draws[1])
    taken = np.zeros(len(texts), dtype=bool)
    for sentinel in (PREFIX, SUFFIX, MIDDLE):
        taken |= pc.match_substring(texts, sentinel).to_numpy(zero_copy_only=False).astype(bool)
    plain = taken | (end == begin) | (draws[2] % 100 >= TRANSFORMED)
    form = np.where(plain, "plain", np.where(draws[3] % 100 < SUFFIX_FIRST, "spm", "psm")).tolist()
    outputs = []
    p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
    for f, i, j, k, e in zip(form, begin.tolist(), one.tolist(), two.tolist(), end.tolist(), strict=True):
        if f == "plain":
            outputs.append(raw[i:e])
        elif f == "psm":
            outputs.append(b"".join((p, raw[i:j], s, raw[k:e], m, raw[j:k])))
        else:
            outputs.append(b"".join((s, raw[k:e], p, raw[i:j], m, raw[j:k])))
    parts = [pa.array(c, mask=plain) for c in (chars[1] - chars[0], chars[2] - chars[1])]
    return [pa.array(n), pa.array(form), *parts, pa.array(outputs, type=pa.binary()).cast(pa.string())]


def transform(docs: DataFrame, id: str = "doc_id", text: str = "text", seed: int = SEED) -> DataFrame:
    """``docs`` with n_units, form, prefix_chars, middle_chars (NULL if plain) and output."""
    kept = [c for c in docs.columns if c.lower() not in ADDED]
    whole = fresh("_text", docs.columns)
    numbers = [fresh(f"_h{k}", docs.columns) for k in range(4)]
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id).cast("string"), F.lit(""))), 256)
    by_id = fresh("_digest", docs.columns)
    source = docs.withColumn(by_id, digest).select(*kept, F.coalesce(F.col(text), F.lit("")).alias(whole), *[
        F.conv(F.substring(by_id, 8 * k + 1, 8), 16, 10).cast("long").alias(c) for k, c in enumerate(numbers)])
    more = StructType.fromDDL(", ".join(f"{c} {t}" for c, t in ADDED.items()))
    schema = StructType([*source.select(*kept).schema.fields, *more.fields])

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, rows in runs(batch.column(len(kept))):
                part = batch.slice(first, rows)
                draws = [part.column(len(kept) + 1 + k).to_numpy(zero_copy_only=False) for k in range(4)]
                made = [c.cast(t) for c, t in zip(arranged(part.column(len(kept)), draws), _TYPES, strict=True)]
                yield pa.RecordBatch.from_arrays([*[part.column(i) for i in range(len(kept))], *made], names=[*kept, *ADDED])

    return source.mapInArrow(mapped, schema)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of."""
    p, s, m = (F.instr(output, x) for x in (PREFIX, SUFFIX, MIDDLE))
    size = F.lit(len(PREFIX))
    rest = F.char_length(output)
    middle = F.substr(output, m + size, rest)
    psm = F.concat(F.substr(output, size + 1, s - size - 1), middle, F.substr(output, s + size, m - s - size))
    spm = F.concat(F.substr(output, p + size, m - p - size), middle, F.substr(output, size + 1, p - size - 1))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = transform(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return made.select("doc_id", F.col("n_units").alias("n"), "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


#: The same by lists of units. (A text's own digest is what the restored one must be.)
ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
        regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u FROM documents),
draws AS (SELECT *, len(u) AS n, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
        ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM d),
cuts AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
             WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM draws),
parts AS (SELECT doc_id, n, form, text, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:], '') AS s FROM cuts)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN len(p) END::BIGINT AS prefix_chars,
    CASE WHEN form <> 'plain' THEN len(m) END::BIGINT AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM parts
"""
