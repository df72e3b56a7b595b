"""Exact dedup through an extendible-hash index on shared files.

1. A pass over the texts counts entries (the different texts of each Arrow
   batch) per hash prefix.  From these bounded counts the directory is built:
   while a bucket holds more than ``capacity`` entries, it is split by one
   more bit of the hash, and the directory doubles when a bucket as deep as
   itself splits.
2. Each task collapses the equal texts of an Arrow batch, and the collapsed
   entries are shuffled to the bucket that the directory names.  A task keeps
   the texts it has seen lately, up to ``RESIDENT_BYTES``: an entry equal to one
   of them, byte by byte, travels without its text and names the entry that
   carried it.  So a text that a third of all rows hold travels once per task
   (a text longer than half of ``RESIDENT_BYTES`` once per batch).
3. The owner task of a bucket reads its entries in key order.  Entries with
   one key form a chain; their bytes are compared, and each different text
   of a chain gets its own number, as do the entries that name it.  The entries are written to the shared
   folder as the index: one folder per bucket, beside the directory.
4. Group sizes and the row that stays come from the index without its texts.

A bucket whose entries all share one key can't be split; its entries chain
in the bucket's files, streamed, however many there are.

Texts are equal when identical after deleting ASCII white space.  Of equal
texts the row with the most code points stays, then the smallest doc_id.

Edge cases: null counts as empty (all empty texts are one group); a null
doc_id loses ties; a row repeated with its doc_id is reported each time, and
each copy of the row that stays is marked kept (``exact_dedup`` returns one);
an empty table gives an empty result; extra columns aren't read.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiplens.llm.common import as_row, bounded_batches, from_row, read, staged
from shiplens.session import remove_at_exit, scratch_path

CAPACITY = 10_000
RESIDENT_BYTES = 8 << 20
# The directory has at most 2**MAX_DEPTH entries; beyond, buckets are larger.
MAX_DEPTH = 16
KEY_BITS = 64
_SPACE = b" \t\n\x0b\x0c\r"
_NO_ID = 2**63 - 1

_ENTRY = "bucket int, key long, text binary, origin long, sha string, chars int, least long, members array<struct<doc_id:bigint,chars:int>>"
_ARROW = pa.schema(
    [
        ("bucket", pa.int32()),
        ("key", pa.int64()),
        ("text", pa.binary()),
        ("origin", pa.int64()),
        ("sha", pa.string()),
        ("chars", pa.int32()),
        ("least", pa.int64()),
        ("members", pa.list_(pa.struct([("doc_id", pa.int64()), ("chars", pa.int32())]))),
    ]
)


def _normal(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").translate(None, _SPACE)


def _key(sha: bytes, key_bits: int = KEY_BITS) -> int:
    """The index key: the first ``key_bits`` bits of the digest, left-aligned, unsigned."""
    return int.from_bytes(sha[:8], "big") >> (64 - key_bits) << (64 - key_bits)


class _Carried:
    """Numbers of the texts that a task has sent; those seen lately are kept, in two generations of ``limit`` bytes in all."""

    def __init__(self, first: int, limit: int):
        self.next, self.half = first, limit // 2
        self.young, self.old, self.bytes = {}, {}, 0

    def number(self, text: bytes) -> tuple[int, bool]:
        """The number of ``text``, and whether it has to be sent (again)."""
        known = self.young.get(text)
        if known is not None:
            return known, False
        known = self.old.get(text)
        number = self.next if known is None else known
        self.next += known is None
        if self.bytes + len(text) > self.half:
            self.young, self.old, self.bytes = {}, self.young, 0
        if len(text) <= self.half:
            self.young[text] = number
            self.bytes += len(text)
        return number, known is None


class Directory:
    """Extendible-hash directory: the top ``depth`` bits of a key name its bucket."""

    def __init__(self, counts: np.ndarray, capacity: int, max_depth: int = MAX_DEPTH):
        """``counts`` has the number of entries of each ``max_depth``-bit prefix."""
        self.depth = 0
        self.entries = [0]
        self.local = [0]  # depth of each bucket
        upto = np.concatenate([[0], np.cumsum(counts)])
        pending = [(0, 0)]  # bucket, its prefix at its local depth
        while pending:
            bucket, prefix = pending.pop()
            d = self.local[bucket]
            width = 1 << (max_depth - d)
            if d == max_depth or upto[(prefix + 1) * width] - upto[prefix * width] <= capacity:
                continue
            if d == self.depth:
                self.entries = [b for b in self.entries for _ in range(2)]
                self.depth += 1
            new = len(self.local)
            self.local[bucket] = d + 1
            self.local.append(d + 1)
            span = 1 << (self.depth - d - 1)
            for i in range((2 * prefix + 1) * span, (2 * prefix + 2) * span):
                self.entries[i] = new
            pending += [(bucket, 2 * prefix), (new, 2 * prefix + 1)]

    def bucket(self, key: int) -> int:
        return self.entries[key >> (64 - self.depth)] if self.depth else 0


def build_directory(docs: DataFrame, capacity: int, key_bits: int, max_depth: int) -> Directory:
    """The directory for ``docs(doc_id, text)``: at most 2**max_depth counts reach the driver."""

    def counted(batches):
        for b in batches:
            keys = {_key(hashlib.sha256(t).digest(), key_bits) for t in {_normal(t) for t in b.column(1).to_pylist()}}
            prefix, n = np.unique(np.fromiter(keys, np.uint64, len(keys)) >> np.uint64(64 - max_depth), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(prefix.astype(np.int32)), pa.array(n)], names=["prefix", "n"])

    found = docs.mapInArrow(counted, "prefix int, n long").groupBy("prefix").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(1 << max_depth, np.int64)
    counts[found.column("prefix").to_numpy()] = found.column("n").to_numpy()
    return Directory(counts, capacity, max_depth)


def build_index(docs: DataFrame, capacity: int = CAPACITY, key_bits: int = KEY_BITS, max_depth: int = MAX_DEPTH, resident: int = RESIDENT_BYTES) -> DataFrame:
    """The index over ``docs``: ``(bucket, key, chain, sha, members, ...)``, written to shared files."""
    spark = docs.sparkSession
    bounded_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    directory = build_directory(docs, capacity, key_bits, max_depth)

    def collapsed(batches):
        carried = _Carried(TaskContext.get().partitionId() << 40, resident)
        for b in batches:
            entries: dict[bytes, list] = {}
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                entries.setdefault(_normal(text), []).append((doc_id, len(text or "")))
            rows = []
            for text, members in entries.items():
                sha = hashlib.sha256(text).digest()
                key = _key(sha, key_bits)
                chars = max(n for _, n in members)
                least = min((d for d, n in members if n == chars and d is not None), default=_NO_ID)
                listed = [{"doc_id": d, "chars": n} for d, n in members]
                origin, send = carried.number(text)
                sent = {"text": text if send else None, "origin": origin}
                rows.append(sent | {"bucket": directory.bucket(key), "key": key - (1 << 63), "sha": sha.hex(), "chars": chars, "least": least, "members": listed})
            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)

    def chained(batches):
        key, text, chain, number = None, None, 0, {}
        for b in batches:
            chains = []
            for k, t, origin in zip(b.column("key").to_pylist(), b.column("text").to_pylist(), b.column("origin").to_pylist()):
                if k != key:
                    key, text, chain, number = k, t, 0, {}
                if t is not None:
                    # a key's texts come ordered by their bytes, before the entries that name them: another text is the next link
                    chain, text = chain + (t != text), t
                    number[origin] = chain
                chains.append(number[origin])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(chains, pa.int32())], names=[*b.schema.names, "chain"])

    buckets = max(directory.entries) + 1
    owners = min(buckets, int(spark.conf.get("spark.sql.shuffle.partitions")))
    owned = docs.mapInArrow(collapsed, _ENTRY).repartition(owners, "bucket").sortWithinPartitions("bucket", "key", F.col("text").asc_nulls_last())
    path = scratch_path(spark, f"llm-exact-index-{uuid.uuid4().hex[:12]}")
    remove_at_exit(spark, path)
    owned.mapInArrow(chained, _ENTRY + ", chain int").write.partitionBy("bucket").parquet(f"{path}/buckets")
    named = spark.createDataFrame(pa.table({"depth": [directory.depth], "buckets": [directory.entries]}))
    named.coalesce(1).write.parquet(f"{path}/directory")
    return spark.read.schema(_ENTRY + ", chain int").parquet(f"{path}/buckets")


def duplicate_groups(docs: DataFrame, **index_options) -> DataFrame:
    """``(doc_id, chars, keep_id, keep_chars, group_size, kept, sha)`` for each row of ``docs``."""
    index = build_index(docs, **index_options).drop("text")
    groups = index.groupBy("key", "chain").agg(
        F.sum(F.size("members")).alias("group_size"),
        F.min(F.struct((-F.col("chars")).alias("n"), "least")).alias("first"),
    )
    groups = staged(groups, "exact-groups")
    rows = index.join(groups, ["key", "chain"]).select("*", F.explode("members").alias("m"))
    keep_id = F.when(F.col("first.least") != _NO_ID, F.col("first.least"))
    return rows.select(
        F.col("m.doc_id").alias("doc_id"),
        F.col("m.chars").alias("chars"),
        keep_id.alias("keep_id"),
        (-F.col("first.n")).alias("keep_chars"),
        "group_size",
        (F.col("m.doc_id").eqNullSafe(keep_id) & (F.col("m.chars") == -F.col("first.n"))).alias("kept"),
        "sha",
    )


def exact_dedup(docs: DataFrame, **index_options) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, each once."""
    found = duplicate_groups(docs, **index_options).where("kept")
    keep = found.select(F.col("doc_id").alias("keep_id"), F.col("sha").alias("keep_sha"), F.col("chars").alias("keep_chars")).distinct()
    text = F.coalesce(F.col("row.text"), F.lit(""))
    rows = as_row(docs).withColumns(
        {"id": F.col("row.doc_id"), "sha": F.sha2(F.regexp_replace(text, r"[ \t-\r]", ""), 256), "chars": F.char_length(text)}
    )
    same = F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("sha") == F.col("keep_sha")) & (F.col("chars") == F.col("keep_chars"))
    return from_row(rows.join(keep, same, "left_semi").dropDuplicates(["id", "sha", "chars"]))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of every document, dropped ones too."""
    found = duplicate_groups(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256"))


ORACLE_SQL = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         sha256(regexp_replace(coalesce(text, ''), '[ \t\n\x0B\f\r]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id
         ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id) = 1 AS kept,
       text_sha256
FROM n
"""
