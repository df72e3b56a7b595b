"""SimHash near-duplicates through a byte-position inverted index.

A 64-bit fingerprint is eight positional bytes.  Two fingerprints at most
``max_bits`` = 4 bits apart differ in at most four bytes, so they share at
least four (position, byte) entries: that is the guaranteed minimum the count
filter asks for.  Single-byte posting lists hold N/256 fingerprints each, so
their pairs would grow with N squared; the lists here are keyed by *three*
positions and their bytes.  The position triples form a covering design
(every four positions contain one of the triples), so a pair that reaches the
minimum always meets in a list, and a list is 2**24 times smaller than N.
Inside a list the shared positional bytes are tallied, pairs below the
minimum are dropped, and the rest is verified by its differing bits.

Within a list links are emitted as a spanning forest (at most one row per
fingerprint), never as all pairs; connectivity, and so every component, is
exact.  Lists longer than ``block`` are cut into block pairs.

Edge cases: null or blank text has fingerprint zero and is linked like any
other; repeated rows are one fingerprint; a null doc_id takes part but is
never the smallest of a component unless no other is there; an empty table
gives an empty result; columns other than doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiplens.llm.common import as_row, bounded_batches, from_row, read, runs, staged
from shiplens.llm.components import connected

WORDS = 4
MAX_BITS = 4
SEED = 42
BLOCK = 32768
_HASHES_AT_ONCE = 65536


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """Unsigned 64-bit SimHash of the word shingles of ``text`` (0 without words)."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    line = b" ".join(tokens)
    at = [0, *accumulate(len(t) + 1 for t in tokens)]
    spans = list(zip(at, at[words:])) or [(0, len(line) + 1)]
    ones = np.zeros(64, np.int64)
    for i in range(0, len(spans), _HASHES_AT_ONCE):
        digests = b"".join([xxhash.xxh64_digest(line[a : b - 1], SEED) for a, b in spans[i : i + _HASHES_AT_ONCE]])
        ones += np.unpackbits(np.frombuffer(digests, np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(spans)).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``(doc_id, fp)`` for each row, ``fp`` as a signed long."""
    bounded_batches(docs.sparkSession)

    def hashed(batches):
        for b in batches:
            fps = np.array([fingerprint(t, words) for t in b.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps)], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(hashed, "doc_id long, fp long")


def covering_triples() -> list[tuple[int, ...]]:
    """Position triples such that any four of the eight positions contain one.

    Positions fall in three groups; a triple is taken if it lies in one group,
    or has two positions in a group and one in the next group.
    """
    group = [0, 0, 0, 1, 1, 1, 2, 2]
    taken = []
    for t in combinations(range(8), 3):
        g = sorted(group[p] for p in t)
        if g[0] == g[2] or (g[0] == g[1] and g[2] == (g[0] + 1) % 3) or (g[1] == g[2] and g[0] == (g[1] + 1) % 3):
            taken.append(t)
    return taken


def _shared_bytes(x: np.ndarray) -> np.ndarray:
    """How many of the eight bytes of each XOR are zero."""
    return (x[..., None].view(np.uint8).reshape(*x.shape, 8) == 0).sum(-1)


def _near(x: np.ndarray, max_bits: int) -> np.ndarray:
    """Count filter on shared positional bytes, then the bit check."""
    kept = np.flatnonzero(np.bitwise_count(x) <= 8 * max_bits) if len(x) > 8 else np.arange(len(x))
    kept = kept[_shared_bytes(x[kept]) >= 8 - max_bits]
    return kept[np.bitwise_count(x[kept]) <= max_bits]


def spanning_links(fps: np.ndarray, max_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Star links (member, root) of the near-duplicate components inside one list.

    Each visited fingerprint is compared with those not reached yet, so a
    dense group of m members costs about m comparisons per level, and m - 1
    rows at most leave.
    """
    left = np.unique(fps).view(np.uint64)
    us, vs = [], []
    while len(left) > 1:
        root, left, frontier = left[0], left[1:], [left[0]]
        while frontier and len(left):
            hit = _near(left ^ frontier.pop(), max_bits)
            if len(hit):
                found = left[hit]
                us.append(found)
                vs.append(np.full(len(found), root))
                frontier.extend(found)
                left = np.delete(left, hit)
    none = np.empty(0, np.uint64)
    return (np.concatenate(us) if us else none).view(np.int64), (np.concatenate(vs) if vs else none).view(np.int64)


def links(fps: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """Distinct fingerprints ``fps(fp)`` -> links ``(u, v)`` that connect all near pairs."""
    if not 0 <= max_bits <= 4:
        raise ValueError("the position triples cover up to four differing bytes")

    def byte(p):
        return F.shiftrightunsigned("fp", 56 - 8 * p).bitwiseAND(F.lit(255))

    keys = [
        F.lit(i << 24) + byte(a) * 65536 + byte(b) * 256 + byte(c) for i, (a, b, c) in enumerate(covering_triples())
    ]
    postings = fps.select("fp", F.explode(F.array(*keys)).alias("list"))
    long = staged(postings.groupBy("list").count().where(F.col("count") > block), "simhash-long")
    if not long.isEmpty():  # split lists beyond the block size into block pairs
        cuts = long.select("list", F.ceil(F.col("count") / block).cast("int").alias("cuts"))
        own = F.pmod(F.xxhash64("fp"), F.col("cuts")).cast("int")
        pair = lambda j: F.least(j, own) * F.lit(1 << 20) + F.greatest(j, own)
        pairs = F.transform(F.sequence(F.lit(0), F.col("cuts") - 1), pair)
        postings = postings.join(cuts, "list", "left").select(
            "fp", "list", F.explode(F.when(F.col("cuts").isNull(), F.array(F.lit(-1))).otherwise(pairs)).alias("part")
        )
    else:
        postings = postings.withColumn("part", F.lit(0))

    def linked(batches):
        for (group,) in runs(batches, ["list", "part"], ["fp"]):
            u, v = spanning_links(group, max_bits)
            if len(u):
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    bounded_batches(fps.sparkSession, 20 * 1000)
    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = postings.repartition(n, "list", "part").sortWithinPartitions("list", "part")
    return ordered.mapInArrow(linked, "u long, v long").distinct()


def rooted(rows: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """``rows(doc_id, fp)`` -> ``(fp, doc_id, root)``: each fingerprint, its smallest doc_id and its component."""
    each = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("doc_id")), "simhash-distinct")
    roots = connected(links(each.select("fp"), max_bits, block), "simhash-links")
    found = each.join(roots, each.fp == roots.node, "left").select("fp", "doc_id", F.coalesce("root", "fp").alias("root"))
    return staged(found, "simhash-roots")


def near_duplicates(docs: DataFrame, words: int = WORDS, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """``(doc_id, fp, component_id)`` for every row of ``docs``."""
    rows = staged(fingerprints(docs, words), "simhash-rows")
    each = rooted(rows, max_bits, block)
    least = staged(each.groupBy("root").agg(F.min("doc_id").alias("component_id")), "simhash-components")
    component = staged(each.select("fp", "root").join(least, "root").select("fp", "component_id"), "simhash-classes")
    return rows.join(component, "fp")


def near_dedup(docs: DataFrame, words: int = WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each near-duplicate component of ``docs``, with all columns.

    The row has the smallest doc_id of the component (null if it has no
    other), then the smallest fingerprint.  Rows are told apart by doc_id and
    fingerprint, so different texts that share a doc_id, or have none, stay.
    """
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("long")
    def hashed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([fingerprint(t, words) for t in texts], np.uint64).view(np.int64))

    # written once: the rows that stay are those whose fingerprints were compared
    rows = as_row(docs).withColumn("fp", hashed(F.col("row.text").cast("string")))
    rows = staged(rows, "simhash-rows").withColumn("id", F.col("row.doc_id").cast("long"))
    each = rooted(rows.select(F.col("id").alias("doc_id"), "fp"), max_bits)
    # null is a value of its own, in columns that one shuffle of the rows serves
    own = [F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("number")]
    keep = each.groupBy("root").agg(F.min(F.struct(*own, "fp")).alias("first")).select("first.*")
    rows = rows.withColumns({"none": F.col("id").isNull(), "number": F.coalesce("id", F.lit(0))})
    key = ["none", "number", "fp"]
    return from_row(rows.dropDuplicates(key).join(keep, key, "left_semi"))


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document (4-word shingles, 4 bits)."""
    found = near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
