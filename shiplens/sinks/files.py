"""File, document and JDBC sinks (SNK-1..6, SNK-8).

All writers are DataFrame writers: executors write their own partitions in
parallel, nothing is collected to the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiplens.functions.dates import ingest_time
from shiplens.sinks.snapshots import write_run


def write_parquet_batch(df: DataFrame, path: str, batch_id: int, col: str = "batch_id") -> None:
    """Write one micro-batch under ``col=batch_id`` (SNK-1, STR-11).

    Dynamic partition overwrite replaces only that batch's folder, so a batch
    replayed after a failure replaces its earlier output instead of doubling it.
    """
    out = df.withColumn(col, F.lit(batch_id).cast("long"))
    (
        out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(col)
        .parquet(path)
    )


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    """Plain Parquet write (SNK-2)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_csv(df: DataFrame, path: str, single_file: bool = False, mode: str = "overwrite") -> None:
    """CSV with a header (SNK-5).

    ``single_file`` funnels the frame into one task: use it only for small
    results such as a rollup (one row per market); large frames are written
    by every partition in parallel.
    """
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).option("header", True).csv(path)


# Lines of one compressed text file: one task reads a whole one.
LINES_PER_FILE = 500_000


def write_lines(df: DataFrame, path: str, lines_per_file: int = LINES_PER_FILE) -> None:
    """The one text column of ``df`` as gzip text, a line per row.

    JSON lines repeat their field names, so plain text takes several times the
    space.  A compressed file can't be split between readers, so its lines are bounded.
    """
    df.write.option("compression", "gzip").option("maxRecordsPerFile", lines_per_file).text(path)


def aggregate_documents(
    agg: DataFrame,
    group_col: str,
    batch_id: int | None = None,
    ts: Column | None = None,
) -> DataFrame:
    """Rollup rows shaped as stored documents (SNK-6).

    ``n_orders`` null → 0, ``sum_sales`` null → 0.0, ``avg_delivery_days``
    stays null.  Stream documents carry ``batch_id``; batch documents carry
    ``group_by`` and ``region_or_market``; ``market`` is the group value.
    """
    ts = ts if ts is not None else ingest_time()
    base = [
        ts.alias("ts"),
        F.col(group_col).cast("string").alias("market"),
        F.coalesce(F.col("n_orders"), F.lit(0)).cast("long").alias("n_orders"),
        F.col("avg_delivery_days").cast("double").alias("avg_delivery_days"),
        F.coalesce(F.col("sum_sales").cast("double"), F.lit(0.0)).alias("sum_sales"),
    ]
    if batch_id is not None:
        extra = [F.lit(batch_id).cast("long").alias("batch_id")]
    else:
        extra = [F.lit(group_col).alias("group_by"), F.col(group_col).cast("string").alias("region_or_market")]
    return agg.select(*base, *extra)


def write_documents(df: DataFrame, path_or_target: str, run: str, fmt: str = "json", options: dict | None = None) -> None:
    """Store documents with any DataFrame writer format (json by default).

    File formats become a run of :mod:`sinks.snapshots`, partitioned by the
    ``day`` of ``ts``.  A run's name identifies what was rolled up: writing it
    again replaces that run's documents at once and no others, so a rerun never
    doubles a total, a failed write loses nothing, and earlier runs stay as
    history.  A document-store connector is chosen by ``fmt`` and ``options``
    alone, so the job has no client library and no per-row inserts; it should write by a key it upserts.
    """
    if fmt in ("json", "parquet", "orc", "csv"):
        write_run(df.withColumn("day", F.to_date("ts")), path_or_target, run, fmt, options, partition_by=["day"])
    else:
        df.write.format(fmt).mode("append").options(**(options or {})).save()


# Fixed value: text type used for columns without an explicit JDBC type.
DEFAULT_TEXT_TYPE = "VARCHAR(255)"


def jdbc_column_types(df: DataFrame, overrides: dict[str, str] | None = None) -> str:
    """``createTableColumnTypes`` text: overrides first, then text as VARCHAR(255) (SNK-4).

    Numeric and other columns keep Spark's own JDBC mapping.
    """
    overrides = overrides or {}
    parts = []
    for f in df.schema.fields:
        if f.name in overrides:
            parts.append(f"{f.name} {overrides[f.name]}")
        elif isinstance(f.dataType, T.StringType):
            parts.append(f"{f.name} {DEFAULT_TEXT_TYPE}")
    return ", ".join(parts)


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: dict | None = None,
    column_types: dict[str, str] | None = None,
    batchsize: int = 10_000,
    num_partitions: int | None = None,
) -> None:
    """Append to a JDBC table (SNK-3); credentials come from ``properties``.

    Executors insert their partitions in parallel; ``num_partitions`` caps the
    number of concurrent connections.
    """
    w = (
        df.write.format("jdbc")
        .mode("append")
        .option("url", url)
        .option("dbtable", table)
        .option("batchsize", batchsize)
        .options(**(properties or {}))
    )
    types = jdbc_column_types(df, column_types)
    if types:
        w = w.option("createTableColumnTypes", types)
    if num_partitions:
        w = w.option("numPartitions", num_partitions)
    w.save()


@dataclass
class Sink:
    name: str
    write: Callable[[DataFrame], None]
    optional: bool = False


class SinkErrors(RuntimeError):
    def __init__(self, failures: dict[str, BaseException]):
        self.failures = failures
        super().__init__("sinks failed: " + ", ".join(f"{k}: {v!r}" for k, v in failures.items()))


def fan_out(
    df: DataFrame,
    sinks: Sequence[Sink],
    storage: StorageLevel = StorageLevel.MEMORY_AND_DISK,
    persist: bool = True,
) -> dict:
    """Write one frame to several sinks; one failure does not stop the others (SNK-8).

    A computed frame (a micro-batch) is persisted once so every sink reads
    the same rows.  A frame that is already a scan of written files needs
    no copy: pass ``persist=False``.  After all sinks ran, failures of
    required sinks are raised together, so a streaming batch is not committed
    with a lost write; optional sinks only report.
    """
    if persist:
        df.persist(storage)
    failures: dict[str, BaseException] = {}
    try:
        for s in sinks:
            try:
                s.write(df)
            except Exception as exc:  # collected and re-raised below
                failures[s.name] = exc
    finally:
        if persist:
            df.unpersist()
    required = {k: v for k, v in failures.items() if not next(s for s in sinks if s.name == k).optional}
    if required:
        raise SinkErrors(required)
    return failures
