"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shiplens.session import stage_table

# Rows and bytes of an Arrow batch: together they bound what a Python worker
# holds at once (one very long document adds its own size).
ARROW_ROWS = 1000
ARROW_BYTES = 4 << 20
HASHES = 1 << 30


def bounded_batches(spark: SparkSession, rows: int = ARROW_ROWS, size: int = ARROW_BYTES) -> None:
    """Limit the rows and bytes of an Arrow batch for the Python stages of this session."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to Parquet in the shared folder, as a scan of it."""
    return stage_table(df, f"llm-{name}")[0]


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def as_row(df: DataFrame) -> DataFrame:
    """``df`` as one struct column ``row``, so that no added column can clash with its names."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))


def from_row(rows: DataFrame) -> DataFrame:
    """The columns that :func:`as_row` packed."""
    return rows.select("row.*")


def crc_fold(key: str, folds: int) -> Column:
    """``crc32(key as text) mod folds``; a null key has no fold (null)."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % F.lit(folds)


def hash_value(key: Column) -> Column:
    """A hash of ``key`` from 0 to ``HASHES`` - 1, the same on every run."""
    return F.xxhash64(key).bitwiseAND(F.lit(HASHES - 1))


def hash_below(key: Column, share: float) -> Column:
    """A row filter that keeps about ``share`` of all keys, the same on every run."""
    return (hash_value(key) < F.lit(int(share * HASHES))) | F.lit(share >= 1)


def byte_slices(batches: Iterable[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in slices of at most ``limit`` bytes of a binary column; a longer value stands alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(batch.schema.get_field_index(column))
        ends = np.frombuffer(values.buffers()[1], np.int32)[values.offset : values.offset + len(values) + 1].astype(np.int64)
        first = 0
        while first < batch.num_rows:
            last = max(first + 1, int(np.searchsorted(ends, ends[first] + limit, side="right")) - 1)
            yield batch.slice(first, last - first)
            first = last


def runs(batches: Iterable[pa.RecordBatch], keys: list[str], values: list[str]) -> Iterator[list[np.ndarray]]:
    """Groups of a key-sorted stream of non-null integer columns.

    Yields, for each stretch of equal ``keys``, the arrays of ``values``.
    Groups of one row are skipped without a Python step each.  Only the
    open group is carried from one Arrow batch to the next.
    """
    held: list[list[np.ndarray]] = []
    held_key: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        ks = [batch.column(batch.schema.get_field_index(k)).to_numpy() for k in keys]
        vs = [batch.column(batch.schema.get_field_index(v)).to_numpy() for v in values]
        new = np.zeros(batch.num_rows, bool)
        for k in ks:
            new[1:] |= k[1:] != k[:-1]
        first = tuple(k[0] for k in ks)
        new[0] = held_key is not None and first != held_key
        starts = np.flatnonzero(new)
        # rows before the first boundary continue the held group
        cut = int(starts[0]) if len(starts) else batch.num_rows
        if cut:
            held.append([v[:cut] for v in vs])
        if len(starts):
            if sum(len(h[0]) for h in held) > 1:
                yield [np.concatenate(p) for p in zip(*held, strict=True)]
            ends = np.append(starts[1:], batch.num_rows)
            long = np.flatnonzero(ends - starts > 1)
            for i in long[long < len(starts) - 1]:
                yield [v[starts[i] : ends[i]] for v in vs]
            held = [[v[starts[-1] :] for v in vs]]
        held_key = tuple(k[-1] for k in ks)
    if held and sum(len(h[0]) for h in held) > 1:
        yield [np.concatenate(p) for p in zip(*held, strict=True)]
