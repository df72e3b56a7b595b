"""Exact top-k inner products by norm-bucketed retrieval.

Vectors are ordered by length and cut into buckets of at most ``bucket_rows``.
The queries travel in blocks.  A first pass scores each query block against
the bucket of the longest vectors: its k-th score is a lower bound that holds
for the whole search.  The second pass visits the other buckets with that
bound, ``theta``.  In a bucket with largest length L, a vector can only reach
the bound if its cosine to the query is at least theta / (|q| L), the local
threshold:

* above 1, nothing in the bucket can: the bucket is skipped.  Buckets lie in
  at most ``STRATA`` strata by length, and a block is only paired with those up
  to the last one it can reach, so skipped pairs are never formed but in that one;
* if it is high, coordinate pruning: with cosine >= t, the unit vector's value
  in the query's largest coordinate lies within an interval around it, and
  only vectors inside the interval are kept;
* otherwise length pruning: vectors shorter than theta / |q| are left out.

What is left is verified by exact integer products.  Bounds are compared with
a margin for rounding, and only scores strictly below the bound are pruned,
so ties stay exact.

Components become floor(256 * x); products are exact integers (64-bit floats
while sums stay below 2**53, Python integers beyond, saturating at the range
of a long).

Edge cases: a vector that is null or holds a null or non-finite component
takes no part, nor does a null vec_id; a shorter vector counts as ending in
zeros; rows that repeat a query's vec_id are its own and no candidates of it;
other repeated rows are candidates each; of several query rows
with one vec_id the least vector is searched; vectors may be of any length, and
a bucket is as wide as its longest; queries without candidates have no
rows; an empty table gives an empty result; other columns aren't read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shiplens.llm.common import bounded_batches, read, staged

K = 5
EVERY = 50
BUCKET_ROWS = 4096
BLOCK_ROWS = 512
COORDINATE_FROM = 0.6  # local threshold from which a coordinate prunes better than lengths
_MARGIN = 1e-9
_HIT_NAMES = ["query_id", "vec_id", "score"]
STRIPE = 32  # parts that one task visits for a query block, longest vectors first
STRATA = 4096  # groups of consecutive parts whose largest norms tell how far a query block has to look


def _floor(x):
    return F.when(F.abs(x) < float(2**52), F.floor(x).cast("double")).otherwise(x)


def quantised(vectors: DataFrame) -> DataFrame:
    """``(vec_id, v array<double>, norm)`` of the vectors that take part."""
    # rounded towards minus infinity as doubles: Spark's floor() would be a long and saturate
    whole = F.transform("embedding", lambda x: _floor(x.cast("double") * 256))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where("vec_id is not null and embedding is not null").where(finite)
    rows = rows.select(F.col("vec_id").cast("long"), whole.alias("v"))
    return rows.withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)))


def packed(rows: DataFrame, size: int, number: str) -> DataFrame:
    """Consecutive rows of each partition packed into blocks of at most ``size``.

    ``(part, number, top, ids, norms, v)``: the partition, the block's number, its
    largest norm, and its columns as binary arrays (``v`` row after row).
    """

    def pack(batches):
        part, chunk, held = TaskContext.get().partitionId(), 0, []

        def block(rows):
            width = max(len(r[1]) for r in rows)
            v = np.zeros((len(rows), width))
            for i, r in enumerate(rows):
                v[i, : len(r[1])] = r[1]
            norms = np.array([r[2] for r in rows])
            ids = np.array([r[0] for r in rows], np.int64)
            return pa.RecordBatch.from_pydict({"part": [part], number: [part << 24 | chunk], "top": [float(norms.max())], "ids": [ids.tobytes()], "norms": [norms.tobytes()], "v": [v.tobytes()]})

        for b in batches:
            held += zip(b.column("vec_id").to_pylist(), b.column("v").to_pylist(), b.column("norm").to_pylist())
            while len(held) >= size:
                yield block(held[:size])
                held, chunk = held[size:], chunk + 1
        if held:
            yield block(held)

    bounded_batches(rows.sparkSession)
    return rows.mapInArrow(pack, f"part long, {number} long, top double, ids binary, norms binary, v binary")


def _floats(b: bytes) -> np.ndarray:
    return np.frombuffer(b, np.float64)


def _matrix(v: bytes, rows: int) -> np.ndarray:
    return _floats(v).reshape(rows, -1)


def exact_products(query: np.ndarray, vectors: np.ndarray, small: bool) -> np.ndarray:
    """Integer inner products; ``small`` says that sums stay below 2**53."""
    if small:
        return (vectors @ query).astype(np.int64)
    q, top = [int(x) for x in query.tolist()], 2**63 - 1
    return np.array([max(-top - 1, min(top, sum(x * int(y) for x, y in zip(q, r)))) for r in vectors.tolist()], np.int64)


def candidates(query: np.ndarray, norm: float, theta: float, vectors: np.ndarray, norms: np.ndarray) -> np.ndarray:
    """Indices of the bucket's vectors (longest first) that may score ``theta`` or more."""
    if theta <= 0:  # lengths bound nothing
        return np.arange(len(norms))
    if norm == 0 or norms[0] == 0:
        return np.empty(0, np.int64)
    need = theta / norm * (1 - _MARGIN)
    local = need / norms[0]
    if local > 1:
        return np.empty(0, np.int64)
    upto = int(np.searchsorted(-norms, -need, side="right"))  # length pruning
    if local < COORDINATE_FROM:
        return np.arange(upto)
    # cos(q, p) >= local means that the angles of q and p to axis f differ by at most arccos(local)
    f = int(np.abs(query).argmax())
    angle, spread = np.arccos(np.clip(query[f] / norm, -1, 1)), np.arccos(local)
    low, high = np.cos(min(np.pi, angle + spread)) - 1e-7, np.cos(max(0.0, angle - spread)) + 1e-7
    value = vectors[:upto, f] / norms[:upto]
    return np.flatnonzero((value >= low) & (value <= high))


class _Block:
    """A block of queries with their best hits so far."""

    def __init__(self, ids: bytes, norms: bytes, v: bytes, thetas: bytes | None, k: int):
        self.ids, self.norms, self.k = np.frombuffer(ids, np.int64), _floats(norms), k
        self.v = _matrix(v, len(self.ids))
        self.thetas = np.full(len(self.ids), -np.inf) if thetas is None else _floats(thetas).copy()
        self.best = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in self.ids]
        self.top = np.abs(self.v).max(initial=0)

    def search(self, ids: bytes, norms: bytes, v: bytes) -> None:
        ids, norms = np.frombuffer(ids, np.int64), _floats(norms)
        order = np.argsort(-norms, kind="stable")
        ids, norms, vectors = ids[order], norms[order], _matrix(v, len(norms))[order]
        width = max(vectors.shape[1], self.v.shape[1])
        queries = np.pad(self.v, ((0, 0), (0, width - self.v.shape[1])))
        vectors = np.pad(vectors, ((0, 0), (0, width - vectors.shape[1])))
        small = self.top * np.abs(vectors).max(initial=0) * width < 2.0**53
        for i, query_id in enumerate(self.ids):
            at = candidates(queries[i], self.norms[i], self.thetas[i], vectors, norms)
            at = at[ids[at] != query_id]
            if len(at):
                found = np.concatenate([self.best[i][0], ids[at]])
                scores = np.concatenate([self.best[i][1], exact_products(queries[i], vectors[at], small)])
                best = np.lexsort((found, -scores))[: self.k]
                self.best[i] = found[best], scores[best]
                if len(best) == self.k:
                    self.thetas[i] = max(self.thetas[i], float(scores[best[-1]]))

    def hits(self) -> pa.RecordBatch:
        sizes = [len(b[0]) for b in self.best]
        joined = [np.concatenate([b[j] for b in self.best]) if sizes else np.empty(0, np.int64) for j in (0, 1)]
        return pa.RecordBatch.from_arrays([pa.array(np.repeat(self.ids, sizes)), *map(pa.array, joined)], names=_HIT_NAMES)


def longest_bucket(buckets: DataFrame) -> int:
    """Number of the bucket with the longest vectors (-1: there are none)."""
    row = buckets.select("bucket", "top").orderBy(F.col("top").desc(), "bucket").first()
    return -1 if row is None else row["bucket"]


def part_count(buckets: DataFrame) -> int:
    """Parts as they were written: a session may deal rows to more partitions than were asked for."""
    last = buckets.agg(F.max("part").alias("last")).first()["last"]
    return 1 if last is None else last + 1


def stratum(parts: int) -> Column:
    """The stratum of a part: ``STRATA`` at most, of consecutive parts."""
    return F.expr(f"part * {min(STRATA, parts)} div {parts}")


def strata_tops(buckets: DataFrame, parts: int) -> np.ndarray:
    """The largest norm in each stratum (none: minus infinity); at most ``STRATA`` numbers reach the driver."""
    tops = np.full(min(STRATA, parts), -np.inf)
    for r in buckets.groupBy(stratum(parts).alias("stratum")).agg(F.max("top").alias("top")).collect():
        tops[r["stratum"]] = r["top"]
    return tops


def bounds(blocks: DataFrame, buckets: DataFrame, longest: int, k: int, tops: np.ndarray) -> DataFrame:
    """``blocks`` with ``thetas``, from the bucket they name, the least length needed and the number of strata to visit."""
    first = buckets.where(F.col("bucket") == longest).select("bucket", *[F.col(c).alias(f"c_{c}") for c in ("ids", "norms", "v")])

    def bounded(batches):
        for b in batches:
            for r in b.to_pylist():
                block = _Block(r["ids"], r["norms"], r["v"], None, k)
                if r["c_ids"] is not None:
                    block.search(r["c_ids"], r["c_norms"], r["c_v"])
                with np.errstate(divide="ignore", invalid="ignore"):
                    need = np.where(block.thetas > 0, block.thetas / block.norms * (1 - _MARGIN), -np.inf)
                reach = int(np.flatnonzero(tops >= need.min()).max(initial=-1)) + 1
                out = {c: [r[c]] for c in ("block", "ids", "norms", "v")}
                yield pa.RecordBatch.from_pydict(out | {"thetas": [block.thetas.tobytes()], "need": [float(need.min())], "reach": [reach]})

    # the broadcast side is one row: one bucket
    joined = blocks.join(F.broadcast(first), "bucket", "left").drop("bucket", "part", "top")
    bounded_batches(blocks.sparkSession, 4)
    return joined.mapInArrow(bounded, "block long, ids binary, norms binary, v binary, thetas binary, need double, reach long")


def open_pairs(blocks: DataFrame, buckets: DataFrame, parts: int) -> DataFrame:
    """``(block, bucket, stripe)`` where the bucket has a vector as long as the block needs."""
    reached = blocks.where("reach > 0").select("block", "need", F.explode(F.expr("sequence(0L, reach - 1)")).alias("stratum"))
    layers = buckets.select(stratum(parts).alias("stratum"), "part", "bucket", "top")
    pairs = reached.join(layers, "stratum").where("top >= need")
    return pairs.select("block", "bucket", F.floor(F.col("part") / STRIPE).alias("stripe"))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, bucket_rows: int = BUCKET_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` of the best ``k`` of ``vectors`` for each of ``queries``."""
    rows = staged(quantised(vectors), "topk-vectors")
    asked_parts = max(1, -(-2 * rows.count() // bucket_rows))
    ranged = rows.repartitionByRange(asked_parts, F.col("norm").desc(), "vec_id").sortWithinPartitions(F.col("norm").desc(), "vec_id")
    buckets = staged(packed(ranged, bucket_rows, "bucket"), "topk-buckets")
    asked = staged(quantised(queries).groupBy("vec_id").agg(F.min(F.struct("v", "norm")).alias("q")).select("vec_id", "q.*"), "topk-queries")
    spread = asked.repartition(max(1, -(-asked.count() // block_rows)), "vec_id")
    longest, parts = longest_bucket(buckets), part_count(buckets)
    named = staged(packed(spread, block_rows, "block").withColumn("bucket", F.lit(longest).cast("long")), "topk-packed")
    blocks = staged(bounds(named, buckets, longest, k, strata_tops(buckets, parts)), "topk-blocks")
    # every block meets the buckets that can reach its bound, a stripe of the parts in a task
    pairs = open_pairs(blocks, buckets, parts)
    found = buckets.select("bucket", *[F.col(c).alias(f"c_{c}") for c in ("top", "ids", "norms", "v")]).join(pairs, "bucket").join(blocks, "block")
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = found.repartition(n, "block", "stripe").sortWithinPartitions("block", "stripe", F.col("c_top").desc())

    def searched(batches):
        now, block = None, None
        for b in batches:
            for r in b.to_pylist():
                if (r["block"], r["stripe"]) != now:
                    if block:
                        yield block.hits()
                    now, block = (r["block"], r["stripe"]), _Block(r["ids"], r["norms"], r["v"], r["thetas"], k)
                block.search(r["c_ids"], r["c_norms"], r["c_v"])
        if block:
            yield block.hits()

    bounded_batches(rows.sparkSession, 4)
    hits = ordered.mapInArrow(searched, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op9_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest of all embeddings for every embedding whose id is divisible by 50."""
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k(vectors, vectors.where(F.col("vec_id") % EVERY == 0))


ORACLE_SQL = f"""
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % {EVERY} = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= {K}
"""
