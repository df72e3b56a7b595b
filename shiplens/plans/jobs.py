"""User-facing jobs (JOB-1..7): operators composed with I/O only at the edges.

Each job takes a session and storage paths; nothing here builds a session at
import time, and no job collects row-level data to the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiplens.operators import features, model as ml, profile, rollup, schema
from shiplens.session import stage_table
from shiplens.sinks import snapshots
from shiplens.sinks.files import Sink, aggregate_documents, fan_out, write_documents, write_jdbc, write_parquet
from shiplens.sources import lines
from shiplens.sources.tables import read_csv, read_csv_tagged
from shiplens.streaming import late, scoring, windows

KEY_COLUMNS = ["order_id", "customer_id"]


def prepare(
    spark: SparkSession,
    csv_path: str,
    out_path: str,
    sample_path: str | None = None,
    csv_schema=None,
    sample_fraction: float = 0.1,
) -> DataFrame:
    """JOB-1: raw CSV → normalised names → derived columns → feature table (Parquet).

    ``market`` is carried so the scoring rollup can group by it.  The sample
    for the scoring job is a key-hash sample, identical on every rerun.
    """
    raw = read_csv(spark, csv_path, schema=csv_schema, infer_schema=csv_schema is None)
    df = features.add_delivery_features(schema.normalize_columns(raw))
    table = features.feature_table(df)
    write_parquet(table, out_path)
    stored = spark.read.parquet(out_path)
    if sample_path:
        keys = schema.present(stored, KEY_COLUMNS) or stored.columns
        write_parquet(features.sample_hash(stored, keys, sample_fraction), sample_path)
    return stored


def train(
    spark: SparkSession,
    prepared_path: str,
    model_path: str,
    allow_leak: bool = False,
    train_fraction: float = 0.8,
    num_trees: int = ml.NUM_TREES,
) -> dict:
    """JOB-2: prepared table → fitted pipeline + metrics; the model is saved."""
    table = spark.read.parquet(prepared_path)
    keys = schema.present(table, KEY_COLUMNS) or table.columns
    split = features.split_hash(table, keys, train_fraction)
    res = ml.train_late_model(split, allow_leak=allow_leak, num_trees=num_trees)
    ml.save_model(res.model, model_path)
    return {"auc": res.auc, "accuracy": res.accuracy, "n_train": res.n_train, "n_test": res.n_test}


def score(
    spark: SparkSession,
    input_path: str,
    model_path: str,
    predictions_path: str,
    documents_path: str | None = None,
    jdbc: dict | None = None,
) -> DataFrame:
    """JOB-3: table + model → predictions (Parquet, optional JDBC) + rollup documents.

    Rows without an id get a deterministic key, so every sink and every retry
    sees the same key.  The predictions are computed once, into Parquet in
    shared storage; the JDBC sink and the rollup read that written table,
    so nothing of table size is held in executor memory and a lost executor
    costs a re-read, not a re-score.
    """
    model = ml.load_model(model_path)
    df = spark.read.parquet(input_path)
    if "order_id" not in df.columns:
        df = schema.with_row_key(df, "order_id")
    write_parquet(ml.score(model, df), predictions_path)
    stored = spark.read.parquet(predictions_path)
    if jdbc:
        fan_out(stored, [jdbc_sink(jdbc)], persist=False)
    if documents_path:
        key = schema.resolve(stored, rollup.GROUP_ALIASES)
        docs = aggregate_documents(rollup.market_summary(stored, out_key=key), key)
        write_documents(docs, documents_path, run=run_name(spark, input_path))
    return stored


def run_name(spark: SparkSession, input_path: str) -> str:
    """Name of a batch run: the input's path and version (its size, number of files and time of writing).

    Scoring the same data again replaces its documents; new data at the same
    path is a new run, and the documents of the old data stay.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(input_path)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    size = fs.getContentSummary(path)
    done = spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    written = [fs.getFileStatus(p).getModificationTime() for p in (path, done) if fs.exists(p)]
    version = (input_path.rstrip("/"), size.getLength(), size.getFileCount(), *written)
    return hashlib.sha1(repr(version).encode()).hexdigest()[:16]


def jdbc_sink(jdbc: dict) -> Sink:
    """A sink from the options of ``write_jdbc``, plus ``optional``."""
    options = {k: v for k, v in jdbc.items() if k != "optional"}
    return Sink("jdbc", lambda d: write_jdbc(d, **options), optional=bool(jdbc.get("optional", False)))


class MissingInputs(ValueError):
    """An upload lacks columns that the model needs."""

    def __init__(self, columns: list[str]):
        self.columns = columns
        super().__init__(f"the upload lacks required columns: {columns}")


def score_csv(spark: SparkSession, csv_path: str, model_path: str, csv_schema=None, quarantine_path: str | None = None) -> DataFrame:
    """SRC-7: every row and column of an uploaded CSV with its prediction and probability.

    Empty cells are filled for the model; absent columns raise :class:`MissingInputs`.
    With ``quarantine_path`` (needs ``csv_schema``) lines that don't read as
    the schema are stored there as they came, and the others are scored.
    """
    model = ml.load_model(model_path)
    if quarantine_path is not None:
        if csv_schema is None:
            raise ValueError("a quarantine needs a schema that lines can fail")
        tagged = read_csv_tagged(spark, csv_path, csv_schema)
        write_parquet(tagged.where("status = 'quarantine'").select("raw"), quarantine_path)
        raw = tagged.where("status = 'ok'").drop("status", "raw")
    else:
        raw = read_csv(spark, csv_path, schema=csv_schema, infer_schema=csv_schema is None)
    uploaded = schema.normalize_columns(raw)
    df = features.add_delivery_features(uploaded)
    missing = ml.missing_inputs(model, df)
    if missing:
        raise MissingInputs(missing)
    return ml.score(model, df, keep=uploaded.columns)


def stream_windows(
    spark: SparkSession,
    source_path: str,
    out_path: str,
    checkpoint: str,
    source_format: str = "text",
    event_time: str | None = None,
    window: str = windows.WINDOW_DURATION,
    watermark: str = windows.WATERMARK_DELAY,
    trigger: dict | None = None,
    source_options: dict | None = None,
    mode: str = "append",
):
    """JOB-4: order lines → decoded → watermark + tumbling windows by market → Parquet.

    Windows are on arrival time (``ingest_ts``), so no line is ever late and
    each good line is counted in one window.  With ``event_time`` naming a
    column, lines later than the watermark are left out by Spark; run
    :func:`stream_quarantine` beside it for the lines that don't decode.
    ``append`` writes each window once, when it is closed; ``complete``
    rewrites all windows, open ones too, after each batch.
    """
    src = lines.read_lines_stream(spark, source_format, source_path, source_options)
    good, _ = lines.split_quarantine(lines.decode_with_quarantine(src))
    enriched = windows.enrich_orders(good)
    ts = event_time or "ingest_ts"
    agg = windows.windowed_stats(enriched, ts, key="market", window=window, watermark=watermark)
    if mode == "complete":
        w = agg.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
        w = w.foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(out_path))
        return w.trigger(**(trigger or {"processingTime": "30 seconds"})).start()
    return _append_query(agg, out_path, checkpoint, trigger)


def stream_quarantine(
    spark: SparkSession,
    source_path: str,
    out_path: str,
    checkpoint: str,
    source_format: str = "text",
    trigger: dict | None = None,
    source_options: dict | None = None,
):
    """The lines that JOB-4 can't decode, as they came, appended to Parquet."""
    src = lines.read_lines_stream(spark, source_format, source_path, source_options)
    _, bad = lines.split_quarantine(lines.decode_with_quarantine(src))
    return _append_query(bad, out_path, checkpoint, trigger)


def stream_late_windows(
    spark: SparkSession,
    source_path: str,
    base_path: str,
    checkpoint: str,
    event_time: str = "order_ts",
    window: str = windows.WINDOW_DURATION,
    watermark: str = windows.WATERMARK_DELAY,
    source_format: str = "text",
    trigger: dict | None = None,
    source_options: dict | None = None,
    compact_every: int = 0,
):
    """JOB-4 on event time with every line accounted for: windows, late lines and quarantine under ``base_path``.

    Unlike :func:`stream_windows`, which leaves lines behind the watermark out, they are kept beside the windows.
    """
    src = lines.decode_with_quarantine(lines.read_lines_stream(spark, source_format, source_path, source_options))
    fn = late.late_writer(base_path, event_time, window, watermark, compact_every)
    return windows.start_foreach(src, fn, checkpoint, trigger or {"processingTime": "30 seconds"})


def _append_query(stream: DataFrame, out_path: str, checkpoint: str, trigger: dict | None):
    w = stream.writeStream.outputMode("append").format("parquet")
    w = w.option("path", out_path).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"processingTime": "30 seconds"})).start()


def stream_score(
    spark: SparkSession,
    source_path: str,
    model_path: str,
    predictions_path: str,
    checkpoint: str,
    quarantine_path: str | None = None,
    documents_path: str | None = None,
    source_format: str = "text",
    trigger: dict | None = None,
    source_options: dict | None = None,
    jdbc: dict | None = None,
):
    """JOB-5: order lines → quarantine split → model scoring → predictions + per-batch rollups.

    Predictions and rollup documents are written per batch (``batch_id``
    partition, dynamic overwrite), so a replay after a failure adds nothing.
    ``jdbc`` adds a database sink per batch (options of ``write_jdbc``, plus
    ``optional``); it is an append, so its table should be keyed.
    """
    model = ml.load_model(model_path)
    src = lines.read_lines_stream(spark, source_format, source_path, source_options)
    tagged = lines.decode_with_quarantine(src)
    sinks = [jdbc_sink(jdbc)] if jdbc else []
    fn = scoring.scoring_writer(model, predictions_path, quarantine_path, sinks, documents_path=documents_path)
    return windows.start_foreach(tagged, fn, checkpoint, trigger or {"processingTime": "30 seconds"})


def report(
    spark: SparkSession,
    documents: DataFrame,
    date_from: str,
    date_to: str,
    market: str | None = None,
    latest: int = 200,
) -> dict[str, DataFrame]:
    """JOB-6: stored aggregates → KPIs, hourly series, market table, latest rows, markets.

    The picked rows are staged once; the five results read that.
    """
    picked, _ = stage_table(rollup.filter_market(pick_days(documents, date_from, date_to), market), "report")
    return {
        "kpis": rollup.dashboard_kpis(picked),
        "hourly": rollup.resample_hourly(picked),
        "by_market": rollup.rollup_of_rollups(picked),
        "latest": rollup.latest_n(picked, latest, "ts", tie_break=[c for c in ("market",) if c in picked.columns]),
        "markets": rollup.distinct_values(picked, "market"),
    }


def profile_table(df: DataFrame, histogram_col: str | None = None, numeric: Sequence[str] | None = None) -> dict:
    """JOB-7: counts, missingness, correlations, histogram and density of a table, in two scans."""
    num, _ = schema.split_by_type(df)
    return profile.combined_profile(df, list(numeric) if numeric is not None else num, histogram_col)


def pick_days(documents: DataFrame, date_from: str, date_to: str) -> DataFrame:
    """Documents of an inclusive range of days; where they are stored by day, others aren't read."""
    if "day" in documents.columns:
        day = F.col("day").cast("date")
        documents = documents.where((day >= F.lit(date_from).cast("date")) & (day <= F.lit(date_to).cast("date")))
    return rollup.filter_time_range(documents, date_from, date_to)


def read_documents(spark: SparkSession, path: str, fmt: str = "json", schema_=None) -> DataFrame:
    """SRC-6: stored aggregate documents with ``ts`` as a UTC timestamp."""
    from shiplens.functions.dates import epoch_or_iso_to_ts

    if snapshots.exists(spark, path):
        df = snapshots.read_runs(spark, path, fmt, schema_)
    else:
        reader = spark.read.format(fmt)
        df = (reader.schema(schema_) if schema_ is not None else reader).load(path)
    if "ts" in df.columns and dict(df.dtypes)["ts"] not in ("timestamp",):
        df = df.withColumn("ts", epoch_or_iso_to_ts("ts"))
    return df.withColumn("n_orders", F.col("n_orders").cast("long"))


def run_order_streams(
    spark: SparkSession,
    source_path: str,
    model_path: str,
    base_path: str,
    trigger: dict | None = None,
    timeout_sec: float | None = None,
    source_options: dict | None = None,
    window: str = windows.WINDOW_DURATION,
    watermark: str = windows.WATERMARK_DELAY,
    window_mode: str = "append",
) -> dict[str, str]:
    """STR-7/8: the window and scoring streams over one source, run together.

    Each query keeps its own checkpoint under ``base_path``; the first failure
    stops the other (``run_streams``).  Returns the output folders.
    """
    import os

    out = {
        "windows": os.path.join(base_path, "windows"),
        "predictions": os.path.join(base_path, "predictions"),
        "quarantine": os.path.join(base_path, "quarantine"),
        "documents": os.path.join(base_path, "documents"),
    }
    q1 = stream_windows(spark, source_path, out["windows"], os.path.join(base_path, "ck-windows"),
                        window=window, watermark=watermark, trigger=trigger, source_options=source_options,
                        mode=window_mode)
    q2 = stream_score(spark, source_path, model_path, out["predictions"], os.path.join(base_path, "ck-score"),
                      quarantine_path=out["quarantine"], documents_path=out["documents"], trigger=trigger,
                      source_options=source_options)
    windows.run_streams([q1, q2], timeout_sec=timeout_sec)
    return out
