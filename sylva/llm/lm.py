"""Language model scoring with an Elias-Fano n-gram trie.

Level 1 holds the distinct training tokens by their 64-bit hashes, level n the n-grams that occur
often enough, as (entry of the first n-1 tokens on level n-1, token number). Each level is a sorted
table cut into shards; a shard is one binary file of Elias-Fano sequences and code arrays:

* pointers: for each parent of the shard, where its children begin (monotone, Elias-Fano);
* children: token numbers, each plus the last value of the parent before, so that the whole
  sequence is monotone (Elias-Fano); a token is found by a successor search relative to its parent;
* the smoothed log10 probability and the back-off weight of each entry, quantised to 16 bits, and
  its count.

Training is a Spark job per level: tasks walk the training texts through the levels that exist and
count the n-grams whose context is an entry; counts are summed by a shuffle (of one number for
context and token, where 63 bits hold both), entries under the minimum dropped (an n-gram cannot be
frequent unless its parts are, so nothing is lost by looking under frequent contexts only), and the
range-sorted rest written by one task per shard.

Smoothing is interpolated absolute discounting: an entry has (count - discount) / count of its
context, plus the context's freed mass times the probability of the shorter context; a context
without the entry backs off with that mass. Level 1 is add-one, with one unit for all unseen tokens.

Shards live below ``spark.checkpoint.dir``. Where that is a mounted folder they are memory-mapped,
so that all tasks of a machine share the pages; from any other store a task reads them into memory.

NULL texts are empty and score their end token alone. Repeated rows count and score each by itself.
Without training rows every token is unseen. Extra columns are ignored."""

from __future__ import annotations

import json
import math
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sylva.session import shared_dir

from .common import chunks, crc_of_id, map_texts, read, stored

ORDER = 2
#: Least count of an n-gram of each order that becomes an entry; tokens and bigrams all do.
MIN_COUNT = (1, 1, 2)
DISCOUNT = 0.75
#: Entries of one shard; a task holds one shard while it writes it.
SHARD_ENTRIES = 2_000_000
#: Characters of text that a task looks up at once.
RUN_CHARS = 4_000_000
#: N-grams that a task gathers before it counts the equal ones and passes them on.
RUN_GRAMS = 3_000_000
#: Parent and token share one number if all such pairs are below it.
PACKED = 1 << 63
#: Quantised log10: steps of 1/QUANTA below 0.
QUANTA = 4096.0
#: The end token; no word has white space.
END = " "
SEED = 42
_ONE, _ALL = np.uint64(1), np.uint64(0xFFFFFFFFFFFFFFFF)


# --- Elias-Fano -------------------------------------------------------------------------------


class EliasFano:
    """A monotone sequence of unsigned numbers: low bits packed, high bits in unary, and the number
    of ones before every block of the unary bits. ``arrays`` is all there is to store."""

    BLOCK = 4  # words

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, ones: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.ones = n, low_bits, low, high, ones
        self.zeros = np.arange(len(ones), dtype=np.int64) * (64 * self.BLOCK) - ones
        self.last = int(self.at(np.array([n - 1]))[0] >> np.uint64(low_bits)) if n else -1

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = np.ascontiguousarray(values, dtype=np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = min(56, max(0, int(math.log2((top + 1) / n)))) if n and top >= n else 0
        low = _pack(values & np.uint64((1 << low_bits) - 1), low_bits)
        places = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n, dtype=np.int64)
        size = (int(places[-1]) if n else 0) + 2
        bits = np.zeros(-(-size // (64 * cls.BLOCK)) * 64 * cls.BLOCK, dtype=np.uint8)
        bits[places] = 1
        high = np.packbits(bits, bitorder="little").view("<u8")
        per = np.bitwise_count(high).astype(np.int64).reshape(-1, cls.BLOCK).sum(axis=1)
        return cls(n, low_bits, low, high, np.concatenate(([0], np.cumsum(per)))[:-1])

    def _select(self, ranks: np.ndarray, before: np.ndarray, flip: bool) -> np.ndarray:
        """Places of the ones (or, flipped, zeros) of the given ranks; all ranks must exist."""
        block = np.searchsorted(before, ranks, side="right") - 1
        left, word = ranks - before[block], block * self.BLOCK
        for _ in range(self.BLOCK - 1):
            here = np.bitwise_count(self.high[word]).astype(np.int64)
            if flip:
                here = 64 - here
            go = left >= here
            left -= here * go
            word += go
        bits = ~self.high[word] if flip else self.high[word]
        at = word << 6
        for width in (32, 16, 8):
            here = np.bitwise_count(bits & np.uint64((1 << width) - 1)).astype(np.int64)
            go = left >= here
            left -= here * go
            shift = go * width
            bits = bits >> shift.astype(np.uint64)
            at += shift
        return at + _IN_BYTE[((bits & np.uint64(255)).astype(np.int64) << 3) + left]

    def _next(self, begin: np.ndarray, ranks: np.ndarray, before: np.ndarray, flip: bool) -> np.ndarray:
        """Places of the ones (zeros) of the given ranks, which are the first not below ``begin``."""
        word = begin >> 6
        bits = (~self.high[word] if flip else self.high[word]) & (_ALL << (begin & 63).astype(np.uint64))
        todo = np.flatnonzero(bits == 0)
        for _ in range(3):
            word[todo] += 1
            bits[todo] = ~self.high[word[todo]] if flip else self.high[word[todo]]
            todo = todo[bits[todo] == 0]
        place = (word << 6) + np.bitwise_count((bits & (~bits + _ONE)) - _ONE)
        place[todo] = self._select(ranks[todo], before, flip)  # a long way off
        return place

    def at(self, i: np.ndarray) -> np.ndarray:
        """Values at the places ``i``."""
        place = self._select(i, self.ones, False)
        return ((place - i).astype(np.uint64) << np.uint64(self.low_bits)) | _unpack(self.low, i, self.low_bits)

    def at_and_next(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values at the places ``i`` and behind them; the places behind must exist."""
        place = self._select(i, self.ones, False)
        behind = self._next(place + 1, i + 1, self.ones, False)
        value = [((p - j).astype(np.uint64) << np.uint64(self.low_bits)) | _unpack(self.low, j, self.low_bits)
                 for p, j in ((place, i), (behind, i + 1))]
        return value[0], value[1]

    def find(self, targets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each target, the first place whose value is not below it (n if there is none), and
        whether that value is the target."""
        upper = (targets >> np.uint64(self.low_bits)).astype(np.int64)
        inside = np.flatnonzero(upper <= self.last)
        place, same = np.full(len(targets), self.n, dtype=np.int64), np.zeros(len(targets), dtype=bool)
        if not len(inside):
            return place, same
        up, low = upper[inside], targets[inside] & np.uint64((1 << self.low_bits) - 1)
        # the zero of rank u ends the bucket of the values with upper bits u
        opens = np.where(up > 0, self._select(np.maximum(up - 1, 0), self.zeros, True) + 1, 0)
        lo, hi = opens - up, self._next(opens, up, self.zeros, True) - up
        todo = np.flatnonzero(lo < hi)
        while len(todo):
            mid = (lo[todo] + hi[todo]) >> 1
            here = _unpack(self.low, mid, self.low_bits)
            same[inside[todo[here == low[todo]]]] = True
            less = here < low[todo]
            lo[todo] = np.where(less, mid + 1, lo[todo])
            hi[todo] = np.where(less, hi[todo], mid)
            todo = todo[lo[todo] < hi[todo]]
        place[inside] = lo
        return place, same

    def arrays(self) -> list[np.ndarray]:
        return [np.array([self.n, self.low_bits], dtype=np.int64), self.low, self.high, self.ones]

    @classmethod
    def load(cls, arrays: list[np.ndarray]) -> EliasFano:
        return cls(int(arrays[0][0]), int(arrays[0][1]), *arrays[1:])


#: Place of the k-th set bit of each byte, at 8 * byte + k.
_IN_BYTE = np.array([([i for i in range(8) if b >> i & 1] + [0] * 8)[k] for b in range(256) for k in range(8)], dtype=np.int64)


def _pack(values: np.ndarray, bits: int) -> np.ndarray:
    """Numbers of ``bits`` bits each, one behind the other, plus a word to read beyond."""
    out = np.zeros(len(values) * bits // 64 + 2, dtype=np.uint64)
    if not bits:
        return out
    at = np.arange(len(values), dtype=np.int64) * bits
    word, shift = at >> 6, (at & 63).astype(np.uint64)
    np.bitwise_or.at(out, word, values << shift)
    over = np.flatnonzero((at & 63) + bits > 64)
    np.bitwise_or.at(out, word[over] + 1, values[over] >> (np.uint64(64) - shift[over]))
    return out


def _unpack(packed: np.ndarray, i: np.ndarray, bits: int) -> np.ndarray:
    if not bits:
        return np.zeros(len(i), dtype=np.uint64)
    at = i.astype(np.int64) * bits
    word, shift = at >> 6, (at & 63).astype(np.uint64)
    value = packed[word] >> shift
    spill = (packed[word + 1] << _ONE) << (np.uint64(63) - shift)
    return (value | spill) & np.uint64((1 << bits) - 1)


# --- shards -----------------------------------------------------------------------------------


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path as Spark writes it, and the path on it."""
    return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))


def write_arrays(path: str, arrays: list[np.ndarray]) -> int:
    """A file with a header of types and sizes, then the arrays, each from a place divisible by 64.
    Written beside its place and moved there whole, so that a repeated task does no harm."""
    about = [[a.dtype.str, len(a)] for a in arrays]
    header = json.dumps(about).encode()
    fs, at = file_system(path)
    fs.create_dir(at.rpartition("/")[0], recursive=True)
    beside = f"{at}.{uuid.uuid4().hex}"
    with fs.open_output_stream(beside) as out:
        size = out.write(len(header).to_bytes(8, "little") + header)
        for a in arrays:
            size += out.write(b"\0" * (-size % 64))
            size += out.write(memoryview(np.ascontiguousarray(a)).cast("B")) if len(a) else 0
    fs.move(beside, at)
    return size


def read_arrays(path: str) -> list[np.ndarray]:
    """The arrays of a file: mapped if it is on a mounted file system, else read into memory."""
    fs, at = file_system(path)
    if isinstance(fs, pafs.LocalFileSystem):
        raw = np.asarray(np.memmap(at, dtype=np.uint8, mode="r"))
    else:
        with fs.open_input_stream(at) as f:
            raw = np.frombuffer(f.read(), dtype=np.uint8)
    n = int(raw[:8].view("<i8")[0])
    place, out = 8 + n, []
    for kind, size in json.loads(raw[8:8 + n].tobytes()):
        place += -place % 64
        end = place + size * np.dtype(kind).itemsize
        out.append(raw[place:end].view(kind))
        place = end
    return out


def packed_counts(count: np.ndarray) -> np.ndarray:
    """Counts in four bytes each, or in eight where one of them needs it."""
    return count.astype(np.uint32 if not len(count) or count.max() < 1 << 32 else np.uint64)


def quantised(log10: np.ndarray) -> np.ndarray:
    return np.clip(np.round(-log10 * QUANTA), 0, 65535).astype(np.uint16)


class Shard:
    """Entries [start, start + n) of a level, for parents [first, first + parents)."""

    def __init__(self, start: int, first: int, arrays: list[np.ndarray]):
        self.start, self.first = start, first
        self.pointers, self.children = EliasFano.load(arrays[:4]), EliasFano.load(arrays[4:8])
        self.prob, self.backoff, self.count = arrays[8:11]

    @staticmethod
    def encode(first: int, parent: np.ndarray, token: np.ndarray, prob: np.ndarray, backoff: np.ndarray, count: np.ndarray) -> list[np.ndarray]:
        """Arrays of a shard; ``backoff`` is the log10 weight of each of its parents (from the first on)."""
        per = np.bincount(parent - first, minlength=int(parent[-1]) - first + 1)
        begins = np.concatenate(([0], np.cumsum(per)))
        # each parent's tokens start from the last value of the parent before
        ends = begins[1:][per > 0] - 1
        tops = token[ends].astype(np.uint64) + _ONE
        bases = np.concatenate((np.zeros(1, np.uint64), np.cumsum(tops)))[:-1]
        values = token.astype(np.uint64) + np.repeat(bases, per[per > 0])
        return [*EliasFano.encode(begins).arrays(), *EliasFano.encode(values).arrays(), quantised(prob), quantised(backoff), packed_counts(count)]

    @property
    def last(self) -> int:
        """The last parent of the shard's range."""
        return self.first + self.pointers.n - 2

    def ranges(self, parent: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(begin, end, base) of the children of each parent; tokens are stored on top of the base."""
        begin, end = (x.astype(np.int64) for x in self.pointers.at_and_next(parent - self.first))
        base = np.zeros(len(parent), dtype=np.uint64)
        later = np.flatnonzero((begin > 0) & (begin < end))
        base[later] = self.children.at(begin[later] - 1) + _ONE
        return begin, end, base


@dataclass
class Directory:
    """What tasks need to find the files of a model: a few numbers per shard."""

    train_tokens: int
    distinct: int
    levels: list[list[tuple[str, int, int, int, int]]]  # per level: (path, start, first key, first parent, entries)
    order: int


def _by_shard(firsts: list, keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, places of the keys that fall into it) for the shards that have any; shards begin at
    ``firsts``, keys below the first fall into none."""
    of = np.searchsorted(np.array(firsts, dtype=keys.dtype), keys, side="right") - 1
    if len(firsts) > 1:
        order = np.argsort(of.astype(np.int16) if len(firsts) < 32_000 else of, kind="stable")
    else:
        order = np.flatnonzero(of >= 0)
    of = of[order]
    ends = np.flatnonzero(np.diff(of)) + 1
    for begin, end in zip(np.concatenate(([0], ends)).tolist(), np.concatenate((ends, [len(of)])).tolist(), strict=True):
        if begin < end and of[begin] >= 0:
            yield int(of[begin]), order[begin:end]


class Trie:
    """The levels of a model, opened by their files."""

    def __init__(self, about: Directory):
        self.about = about
        total = about.train_tokens + about.distinct + 1
        self.unseen = -math.log10(total)
        self.words = []
        for path, start, key, _, _ in about.levels[0]:
            arrays = read_arrays(path)
            self.words.append((np.uint64(key), start, EliasFano.load(arrays[:4]), arrays[4]))
        self.levels = [[Shard(start, first, read_arrays(path)) for path, start, _, first, _ in level] for level in about.levels[1:]]

    def tokens(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number or -1, count or 0) of each token."""
        number, count = np.full(len(hashes), -1, dtype=np.int64), np.zeros(len(hashes), dtype=np.int64)
        if not self.words:
            return number, count
        for s, at in _by_shard([k for k, *_ in self.words], hashes):
            key, start, ef, counts = self.words[s]
            got, same = ef.find(hashes[at] - key)
            hit = np.flatnonzero(same)
            number[at[hit]] = got[hit] + start
            count[at[hit]] = counts[got[hit]]
        return number, count

    def entries(self, level: int, context: np.ndarray, which: np.ndarray, token: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(entry or -1, its log10 probability, log10 back-off weight of its context or 0) on ``level``
        (2 or more) for each token after ``context[which]``; no context (-1 in either) and no token
        (-1) have no entry."""
        entry, prob, weight = np.full(len(token), -1, dtype=np.int64), np.zeros(len(token)), np.zeros(len(token))
        parent = np.where(which >= 0, context[which], -1)
        shards = self.levels[level - 2]
        for s, at in _by_shard([x.first for x in shards], parent):
            shard = shards[s]
            at = at[parent[at] <= shard.last]
            weight[at] = shard.backoff[parent[at] - shard.first] / -QUANTA
            ask = at[token[at] >= 0]
            if not len(ask):
                continue
            # equal n-grams are looked up once, and in their order, which is that of the files
            width = np.int64(token[ask].max()) + 1
            gram, again = np.unique((parent[ask] - shard.first) * width + token[ask], return_inverse=True)
            local, last = gram // width, gram % width
            new = starts(local)
            of, spread = local[new], np.cumsum(new) - 1
            begin, end, base = (x[spread] for x in shard.ranges(of + shard.first))
            got, same = shard.children.find(base + last.astype(np.uint64))
            found = np.where(same & (got >= begin) & (got < end), got, -1)[again]
            hit = np.flatnonzero(found >= 0)
            entry[ask[hit]] = found[hit] + shard.start
            prob[ask[hit]] = shard.prob[found[hit]] / -QUANTA
        return entry, prob, weight

    def counts(self, level: int, entry: np.ndarray) -> np.ndarray:
        """Counts of entries of ``level``."""
        out = np.zeros(len(entry), dtype=np.int64)
        shards = [(start, counts) for _, start, _, counts in self.words] if level == 1 else \
            [(shard.start, shard.count) for shard in self.levels[level - 2]]
        for start, counts in shards:
            at = np.flatnonzero((entry >= start) & (entry < start + len(counts)))
            out[at] = counts[entry[at] - start]
        return out

    def shorter(self, level: int, lower: np.ndarray) -> np.ndarray:
        """log10 probability of n-grams of ``level`` without their first token, whose entries on the
        level before are ``lower``."""
        if level == 2:
            return self.base(self.counts(1, lower))
        out = np.zeros(len(lower))
        for shard in self.levels[level - 3]:
            at = np.flatnonzero((lower >= shard.start) & (lower < shard.start + len(shard.prob)))
            out[at] = shard.prob[lower[at] - shard.start] / -QUANTA
        return out

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10(counts + 1) + self.unseen

    def walk(self, texts: list[str | None], levels: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Looks up all n-grams of the texts, up to ``levels``: (text of each token, its count, its
        log10 probability by the longest entry). Each text has an end token before it, as the
        context of its first token, which is left out of the result."""
        distinct, which, owner, opens = text_tokens(texts)
        numbers, counts = self.tokens(distinct)
        number, count = numbers[which], counts[which]
        entry, prob = number, self.base(counts)[which]
        for level in range(2, levels + 1):
            entry, p, weight = self.next_level(level, numbers, which, opens, entry)
            prob = np.where(entry >= 0, p, prob + weight)
        keep = ~opens
        return owner[keep], count[keep], prob[keep]

    def next_level(self, level: int, numbers: np.ndarray, which: np.ndarray, opens: np.ndarray, entry: np.ndarray) -> tuple:
        """Entries, probabilities and weights of a level from the entries of the level before. An
        n-gram whose end is no entry is none either, and is not looked up."""
        token = np.where(entry >= 0, numbers[which], -1)
        if level == 2:  # contexts are the distinct tokens
            return self.entries(level, numbers, before(which, opens), token)
        return self.entries(level, entry, before(np.arange(len(entry)), opens), token)


def before(which: np.ndarray, opens: np.ndarray) -> np.ndarray:
    """``which`` of the token before; -1 for a token that opens a text."""
    out = np.concatenate((np.full(1, -1, np.int64), which[:-1]))
    out[opens] = -1
    return out


def starts(ordered: np.ndarray) -> np.ndarray:
    """Where a run of equal values begins."""
    return np.concatenate((np.ones(min(1, len(ordered)), bool), ordered[1:] != ordered[:-1]))


def text_tokens(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hashes of the distinct tokens, which of them each token is, its text, whether it opens a
    text): an end token stands before and after the words of each text."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(texts, pa.large_string()).fill_null("")))
    words, of = split.flatten(), np.repeat(np.arange(len(texts)), split.value_lengths())
    full = pc.not_equal(words, "")  # white space at either end of a text leaves an empty word there
    coded, of = words.filter(full).dictionary_encode(), of[full.to_numpy(zero_copy_only=False)]
    distinct = (END.encode(), *coded.dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, distinct, repeat(SEED)), np.uint64, len(distinct))
    sizes = np.bincount(of, minlength=len(texts)) + 2
    which, opens = np.zeros(sizes.sum(), dtype=np.int64), np.zeros(sizes.sum(), dtype=bool)
    which[np.arange(len(of)) + 2 * of + 1] = coded.indices.to_numpy().astype(np.int64) + 1
    opens[np.cumsum(sizes) - sizes] = True
    return hashes, which, np.repeat(np.arange(len(texts)), sizes), opens


# --- training ---------------------------------------------------------------------------------


def _write_level(rows: DataFrame, folder: str, level: int, encode) -> list[tuple]:
    """One file per partition of ``rows`` (sorted), encoded by ``encode``; the shards in order."""
    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if got:
            columns = {n: np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in got]) for i, n in enumerate(got[0].schema.names)}
            key, first, arrays = encode(columns)
            path = f"{folder}/level-{level}/{first:020d}-{key:020d}.trie"
            write_arrays(path, arrays)
            yield pa.RecordBatch.from_pydict({"path": [path], "first": [int(first)], "key": [str(key)], "n": [len(columns["count"])]})

    made = sorted(rows.mapInArrow(written, "path string, first long, key string, n long").collect(), key=lambda r: (r["first"], int(r["key"])))
    out, start = [], 0
    for r in made:
        out.append((r["path"], start, int(r["key"]), r["first"], r["n"]))
        start += r["n"]
    return out


def _shards(n: int) -> int:
    return max(1, -(-n // SHARD_ENTRIES))


def train(texts: DataFrame, order: int = ORDER, min_count: tuple[int, ...] = MIN_COUNT, discount: float = DISCOUNT) -> Directory:
    """A model of the column ``text``; only the directory of its files comes to the driver."""
    spark = texts.sparkSession
    folder = shared_dir(spark, "ngram-trie")
    texts = texts.select(F.coalesce("text", F.lit("")).alias("text"))

    # level 1: every token
    counted = stored(texts.mapInArrow(_token_counts, "h long, count long").groupBy("h").agg(F.sum("count").alias("count")), "ngrams-1")
    n, total = counted.agg(F.count("*"), F.coalesce(F.sum("count"), F.lit(0))).first()
    # signed order is unsigned order with the top bit turned
    unsigned = F.col("h").bitwiseXOR(F.lit(-(1 << 63)))

    def encode_words(c: dict) -> tuple:
        hashes = c["h"].view(np.uint64) ^ np.uint64(1 << 63)
        return int(hashes[0]), int(hashes[0]) >> 1, [*EliasFano.encode(hashes - hashes[0]).arrays(), packed_counts(c["count"])]

    dealt = counted.select(unsigned.alias("h"), "count").repartitionByRange(_shards(n), "h").sortWithinPartitions("h")
    about = Directory(total, n, [_write_level(dealt, folder, 1, encode_words)] if n else [[]], order)

    for level in range(2, order + 1):
        below = spark.sparkContext.broadcast(about)
        least = min_count[min(level, len(min_count)) - 1]
        # parent and token are one number where it has room for both: such rows are grouped and sorted faster
        width = about.distinct if sum(entries for *_, entries in about.levels[-1]) * about.distinct < PACKED else 0

        def counts(batches: Iterator[pa.RecordBatch], level: int = level, below=below, least: int = least,
                   counted=partial(_packed, width=width) if width else _counted) -> Iterator[pa.RecordBatch]:
            trie = opened(below.value)
            held, n = [], 0
            for batch in batches:
                for part in chunks(batch.column(0), RUN_CHARS):
                    held.append(_new_grams(trie, part, level, least))
                    n += len(held[-1][0])
                    if n >= RUN_GRAMS:
                        yield counted(held)
                        held, n = [], 0
            if n:
                yield counted(held)

        # on level 2 the n-gram without its first token is the token
        more = [F.max("lower").alias("lower")] if level > 2 else []
        key = ["gram"] if width else ["parent", "token"]
        grams = texts.mapInArrow(counts, "".join(f"{c} long, " for c in [*key, *["lower"] * (level > 2)]) + "count long")
        # the runs of a task are counted: grouped once more before the shuffle they hardly shrink, so they are dealt first
        kept = stored(grams.repartition(*key).groupBy(*key).agg(F.sum("count").alias("count"), *more)
                      .where(F.col("count") >= least), f"ngrams-{level}")
        n = kept.count()
        if not n:
            about.levels.append([])
            break
        # all entries of a context come to one task, which adds up the mass that they hold
        rows = kept.repartitionByRange(_shards(n), F.expr(f"gram div {width}L") if width else "parent").sortWithinPartitions(*key)

        def encode(c: dict, level: int = level, below=below, width: int = width) -> tuple:
            trie = opened(below.value)
            parent, token = np.divmod(c["gram"], width) if width else (c["parent"], c["token"])
            count = c["count"]
            of_context = trie.counts(level - 1, parent).astype(float)
            begins = np.flatnonzero(np.concatenate(([True], parent[1:] != parent[:-1])))
            held = np.repeat(np.add.reduceat(count - discount, begins), np.diff(np.append(begins, len(parent))))
            # what they leave goes to the shorter context
            weight = np.maximum(1 - held / of_context, 1e-9)
            shorter = 10.0 ** trie.shorter(level, c["lower"] if level > 2 else token)
            prob = np.log10((count - discount) / of_context + weight * shorter)
            first = int(parent[0])
            back = np.zeros(int(parent[-1]) - first + 1)
            back[parent - first] = np.log10(weight)
            return int(token[0]), first, Shard.encode(first, parent, token, np.minimum(prob, 0), back, count)

        about = Directory(about.train_tokens, about.distinct, [*about.levels, _write_level(rows, folder, level, encode)], order)
    return about


def _token_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hashes of the distinct tokens of each run of texts with their counts."""
    for batch in batches:
        for part in chunks(batch.column(0), RUN_CHARS):
            distinct, which, _, opens = text_tokens(part)
            count = np.bincount(which[~opens], minlength=len(distinct))
            yield pa.RecordBatch.from_arrays([pa.array(distinct.view(np.int64)), pa.array(count.astype(np.int64))], names=["h", "count"])


def _new_grams(trie: Trie, texts: list[str | None], level: int, least: int) -> tuple[np.ndarray, ...]:
    """(parent, token[, lower]) of the n-grams of ``level`` whose context, and whose end without its
    first token, are entries frequent enough; lower is the entry of that end."""
    distinct, which, _, opens = text_tokens(texts)
    numbers, counts = trie.tokens(distinct)
    entry = numbers[which]
    for below in range(2, level):
        entry = trie.next_level(below, numbers, which, opens, entry)[0]
    parent = before(entry, opens)
    fit = np.flatnonzero((parent >= 0) & (entry >= 0) & (counts >= least)[which])
    return (parent[fit], numbers[which[fit]]) if level == 2 else (parent[fit], numbers[which[fit]], entry[fit])


def _counted(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    """The distinct n-grams of several runs with their counts."""
    parent, token, *lower = (np.concatenate(x) for x in zip(*held, strict=True))
    width = int(token.max()) + 1
    if not lower and (int(parent.max()) + 1) * width < 1 << 63:
        gram, n = _packed(held, width).columns
        return pa.RecordBatch.from_arrays([*(pa.array(x) for x in np.divmod(gram.to_numpy(), width)), n], names=["parent", "token", "count"])
    # one number for parent and token, among those of these runs
    p = np.unique(parent, return_inverse=True)[1]
    _, first, n = np.unique(p * width + token, return_index=True, return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (parent[first], token[first], *[x[first] for x in lower], n.astype(np.int64))],
                                      names=["parent", "token", *["lower"] * len(lower), "count"])


def _packed(held: list[tuple[np.ndarray, ...]], width: int) -> pa.RecordBatch:
    """As ``_counted``, with parent * width + token for the two, which must fit 63 bits."""
    gram = np.concatenate([parent * width + token for parent, token, *_ in held])
    if len(held[0]) == 2:
        # the number says all: sorted by itself, without the places it came from
        gram.sort()
        first, lower = np.flatnonzero(starts(gram)), []
        n = np.diff(np.append(first, len(gram)))
    else:
        _, first, n = np.unique(gram, return_index=True, return_counts=True)
        lower = [np.concatenate([x[2] for x in held])[first]]
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (gram[first], *lower, n.astype(np.int64))], names=["gram", *["lower"] * len(lower), "count"])


_OPEN: dict[str, Trie] = {}


def opened(about: Directory) -> Trie:
    """The trie of ``about``, opened once in each Python worker."""
    key = json.dumps(about.levels)
    if key not in _OPEN:
        _OPEN.clear()
        _OPEN[key] = Trie(about)
    return _OPEN[key]


def score(docs: DataFrame, about: Directory) -> DataFrame:
    """``docs`` with n_tokens, n_known, base_score and score of each text."""
    shared = docs.sparkSession.sparkContext.broadcast(about)

    def scored(texts: list[str | None]) -> dict:
        trie = opened(shared.value)
        owner, count, prob = trie.walk(texts, len(shared.value.levels))
        n = len(texts)
        return {"n_tokens": np.bincount(owner, minlength=n), "n_known": np.bincount(owner, weights=count > 0, minlength=n).astype(np.int64),
                "base_score": np.bincount(owner, weights=trie.base(count), minlength=n), "score": np.bincount(owner, weights=prob, minlength=n)}

    return map_texts(docs, {"n_tokens": "long", "n_known": "long", "base_score": "double", "score": "double"}, scored, chars=RUN_CHARS)


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    rest = crc_of_id(F.col("doc_id")) % 7
    about = train(docs.where(rest != 2))
    return score(docs, about).select("doc_id", (rest == 2).alias("held_out"), "n_tokens", "n_known",
                                     F.lit(about.train_tokens).cast("long").alias("train_tokens"), "base_score", "score")
