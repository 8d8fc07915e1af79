"""SimHash near-dedup by a byte-position inverted index with count filtering.

A fingerprint is 8 positional bytes. Two fingerprints that differ in at most ``max_bits`` bits
differ in at most that many bytes, so they share at least ``8 - max_bits`` positional bytes. A
posting list of one positional byte holds 1/256 of all fingerprints, and its pairs would grow with
the square of the table, so the index posts each fingerprint under every set of that many
positional bytes (70 sets of 4 out of 8 at the default): the tally that count filtering demands is
then met by being in one list together. The join condition tallies the shared positional bytes of
a pair, keeps it only in the first list that holds both (no pair comes out twice) and verifies the
bit distance.

Lists longer than ``LONG_LIST`` (many different fingerprints that agree in 4 bytes) would still
give a square of pairs. They take an exact way of linear size: the free bits of each member are
changed in every way of up to half the distance, and members that meet in one changed value are
within the distance of each other, and every pair within the distance meets in some value. (An
odd distance cannot be halved; there all lists are joined.)

NULL text counts as empty; a text without words has fingerprint zero and links like any other.
Repeated rows share a fingerprint. A NULL id stays in its row and its component takes the smallest
id of the others. Very long texts are hashed whole, their bits counted in runs; ties (equal ids) go by
the place in the stored table; an empty table gives an empty one. Extra columns of the input pass through
``keep_one`` untouched, whatever their names."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, fresh, map_texts, read, stored

SEED = 42
SHINGLE = 4
MAX_BITS = 4
#: Above this many members the changed values of a list are fewer than its pairs.
LONG_LIST = 1024


def simhash(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the word shingles of ``text``, as an unsigned number."""
    raw = (text or "").encode().lower().split()  # of bytes, both go by ASCII alone
    if not raw:
        return 0
    joined = b" ".join(raw)
    ends = np.cumsum([len(w) + 1 for w in raw]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1)).tolist()
    ends, k = ends.tolist(), min(shingle, len(raw))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[s:e], SEED) for s, e in zip(starts, ends[k - 1:], strict=False)], dtype="<u8")
    set_in = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 65536):  # bounds the unpacked bits of a very long text
        set_in += np.unpackbits(hashes[at:at + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * set_in > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) for each row; fp is the fingerprint as a signed long."""
    def hashed(texts: list[str | None]) -> dict:
        return {"fp": np.array([simhash(t, shingle) for t in texts], dtype=np.uint64).view(np.int64)}

    return map_texts(docs.select("doc_id", "text"), {"fp": "long"}, hashed).select("doc_id", "fp")


def _mask(positions: tuple[int, ...]) -> int:
    m = sum(0xFF << (8 * p) for p in positions)
    return m - (1 << 64) if m >= 1 << 63 else m


def links(fps: DataFrame, max_bits: int = MAX_BITS, long_list: int = LONG_LIST) -> DataFrame:
    """Edges (a, b) between different fingerprints of ``fps`` (column fp, distinct), such that
    they connect exactly what pairs within ``max_bits`` connect."""
    if not 1 <= max_bits <= 6:
        raise ValueError("max_bits must be 1 to 6")
    need = 8 - max_bits
    sets = list(combinations(range(8), need))
    masks = [_mask(s) for s in sets]
    index = fps.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("set", "key"))
    lists = index.groupBy("set", "key").agg(F.count("*").alias("n")).where("n > 1")
    posted = stored(index.join(lists, ["set", "key"]), "postings")
    if max_bits % 2:  # the way of long lists below halves the distance
        long_list = (1 << 31) - 1
    short = posted.where(F.col("n") <= long_list)
    x = short.select("set", "key", F.col("fp").alias("a"))
    y = short.select(F.col("set").alias("set_y"), F.col("key").alias("key_y"), F.col("fp").alias("b"))
    differ = F.col("a").bitwiseXOR(F.col("b"))
    same = [differ.bitwiseAND(F.lit(_mask((p,)))) == 0 for p in range(8)]
    # the first `need` shared positions name the one list that reports the pair
    first, tally = F.lit(0).cast("long"), F.lit(0)
    for p in range(8):
        first = first.bitwiseOR(F.when(same[p] & (tally < need), F.lit(_mask((p,)))).otherwise(F.lit(0)).cast("long"))
        tally = tally + same[p].cast("int")
    listed_under = F.element_at(F.array(*[F.lit(m).cast("long") for m in masks]), F.col("set") + 1)
    near = (F.col("a") < F.col("b")) & (F.bit_count(differ) <= max_bits) & (tally >= need) & (first == listed_under)
    pairs = x.join(y, (F.col("set") == F.col("set_y")) & (F.col("key") == F.col("key_y")) & near).select("a", "b")
    dense = posted.where(F.col("n") > long_list)
    if dense.isEmpty():
        return pairs
    return pairs.union(_by_changed_values(dense, sets, max_bits))


def _by_changed_values(dense: DataFrame, sets: list[tuple[int, ...]], max_bits: int) -> DataFrame:
    """Star edges over members of one list that meet in a value within half the distance of each."""
    half = max_bits // 2
    out = None
    for k, s in enumerate(sets):
        free = [8 * p + b for p in range(8) if p not in s for b in range(8)]
        flips = [0] + [sum(1 << b for b in c) for r in range(1, half + 1) for c in combinations(free, r)]
        flips = [f - (1 << 64) if f >= 1 << 63 else f for f in flips]
        part = dense.where(F.col("set") == k).select("fp", F.explode(F.array(*[F.lit(f) for f in flips])).alias("f"))
        part = part.select("fp", F.col("fp").bitwiseXOR(F.col("f")).alias("meet"))
        out = part if out is None else out.union(part)
    met = stored(out, "met")
    hub = met.groupBy("meet").agg(F.min("fp").alias("a"), F.max("fp").alias("z")).where("a <> z").drop("z")
    return met.join(hub, "meet").where("fp <> a").select("a", F.col("fp").alias("b")).distinct()


def near_components(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, long_list: int = LONG_LIST) -> DataFrame:
    """One row per row of ``docs``: doc_id, fp (signed long), component_id (smallest doc_id linked
    to it through any chain, its own included)."""
    rows = stored(fingerprints(docs, shingle), "fingerprints")
    fps = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    roots = components(links(fps.select("fp"), max_bits, long_list))
    grouped = fps.join(roots, fps.fp == roots.node, "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    ids = grouped.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_fp = grouped.join(ids, "root").select("fp", "component_id")
    return rows.join(of_fp, "fp").select("doc_id", "fp", "component_id")


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_components(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` that are first in their component: the row with the component's smallest
    id, or, where ids repeat or are all NULL, one of the rows with it."""
    fp, at = (fresh(c, docs.columns) for c in ("_simhash", "_simhash_at"))
    rows = stored(map_texts(docs, {fp: "long"}, lambda texts: {fp: np.array([simhash(t, shingle) for t in texts], dtype=np.uint64).view(np.int64)})
                  .withColumn(at, F.monotonically_increasing_id()), "hashed-documents")
    # smallest id first (NULL last), then the place in the stored table
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col(at).alias("at")))
    fps = stored(rows.groupBy(F.col(fp).alias("fp")).agg(first.alias("first")), "distinct-fingerprints")
    roots = components(links(fps.select("fp"), max_bits))
    grouped = fps.join(roots, fps.fp == roots.node, "left").select("first", F.coalesce("root", "fp").alias("root"))
    kept = grouped.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.at").alias("_kept"))
    return rows.join(kept, rows[at] == kept["_kept"], "left_semi").select(*docs.columns)
