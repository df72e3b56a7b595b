"""End-to-end jobs on a CSV export cut from the driver's tables (sf0.001)."""

import os

import pytest
from pyspark.sql import functions as F

from shiplens import fixtures
from shiplens.operators import features, model as ml, schema
from shiplens.plans import jobs
from shiplens.sinks.files import write_csv
from tests.conftest import SF_SMALL


def test_prepare_train_score_report(spark, tmp_dir):
    raw = fixtures.raw_orders(spark, SF_SMALL)
    csv = os.path.join(tmp_dir, "raw")
    write_csv(raw, csv)
    prepared = jobs.prepare(spark, csv, os.path.join(tmp_dir, "prepared"), os.path.join(tmp_dir, "sample"),
                            csv_schema=raw.schema)
    assert "late_delivery_risk" in prepared.columns and "market" in prepared.columns
    assert prepared.count() == raw.count()
    sample = spark.read.parquet(os.path.join(tmp_dir, "sample")).count()
    assert 0 < sample < raw.count()

    metrics = jobs.train(spark, os.path.join(tmp_dir, "prepared"), os.path.join(tmp_dir, "model"), allow_leak=True)
    assert metrics["n_train"] > metrics["n_test"] > 0

    preds = jobs.score(spark, os.path.join(tmp_dir, "sample"), os.path.join(tmp_dir, "model"),
                       os.path.join(tmp_dir, "predictions"), os.path.join(tmp_dir, "docs"))
    assert {"prediction", "prob_class_1", "market"} <= set(preds.columns)
    docs = jobs.read_documents(spark, os.path.join(tmp_dir, "docs"))
    assert docs.agg(F.sum("n_orders")).first()[0] == sample

    out = jobs.report(spark, docs, "2000-01-01", "2100-01-01")
    assert out["kpis"].first()["total_orders"] == sample
    assert out["markets"].count() == docs.select("market").distinct().count()

    # an upload's own columns stay, empty cells are filled for the model only
    upload = raw.withColumn("My Note", F.lit("x")).withColumn("Sales", F.when(F.col("Order Id") % 3 == 0, F.col("Sales")))
    write_csv(upload, os.path.join(tmp_dir, "upload"))
    scored = jobs.score_csv(spark, os.path.join(tmp_dir, "upload"), os.path.join(tmp_dir, "model"), csv_schema=upload.schema)
    assert scored.columns == [*schema.normalize_columns(upload).columns, "prediction", "prob_class_1"]
    assert scored.count() == raw.count() and scored.where("prob_class_1 is null or my_note <> 'x'").count() == 0
    assert scored.where("sales is null").count() == upload.where("Sales is null").count() > 0
    no_sales = raw.drop("Sales")
    csv2 = os.path.join(tmp_dir, "raw-no-sales")
    write_csv(no_sales, csv2)
    with pytest.raises(jobs.MissingInputs) as err:
        jobs.score_csv(spark, csv2, os.path.join(tmp_dir, "model"), csv_schema=no_sales.schema)
    assert err.value.columns == ["sales"]

    # a rerun replaces the run's documents; another input adds its own
    docs_path, args = os.path.join(tmp_dir, "docs"), (os.path.join(tmp_dir, "model"), os.path.join(tmp_dir, "predictions2"))
    jobs.score(spark, os.path.join(tmp_dir, "sample"), *args, docs_path)
    assert jobs.read_documents(spark, docs_path).agg(F.sum("n_orders")).first()[0] == sample
    jobs.score(spark, os.path.join(tmp_dir, "prepared"), *args, docs_path)
    assert jobs.read_documents(spark, docs_path).agg(F.sum("n_orders")).first()[0] == sample + raw.count()


def test_score_job_jdbc_sink_failure_is_optional_or_fatal(spark, tmp_dir):
    """No database here: a URL no JDBC driver accepts fails at once, locally."""
    from shiplens.sinks.files import SinkErrors

    s = fixtures.shipments(spark, SF_SMALL).withColumn("geo_distance_km", F.lit(0.0))
    table = features.feature_table(s)
    data = os.path.join(tmp_dir, "input")
    table.write.parquet(data)
    res = ml.train_late_model(features.split_hash(table, ["order_id"], 0.8), allow_leak=True, num_trees=3)
    model = os.path.join(tmp_dir, "model")
    ml.save_model(res.model, model)
    bad = {"url": "jdbc:no-such-driver:nowhere", "table": "predictions"}

    out = jobs.score(spark, data, model, os.path.join(tmp_dir, "p1"), os.path.join(tmp_dir, "d1"),
                     jdbc={**bad, "optional": True})
    assert out.count() == table.count()  # predictions and documents still written
    assert jobs.read_documents(spark, os.path.join(tmp_dir, "d1")).agg(F.sum("n_orders")).first()[0] == table.count()
    with pytest.raises(SinkErrors) as err:
        jobs.score(spark, data, model, os.path.join(tmp_dir, "p2"), None, jdbc={**bad, "optional": False})
    assert "jdbc" in err.value.failures and "optional" not in str(err.value.failures["jdbc"])


def test_profile_table(spark):
    df = fixtures.dirty_shipments(spark, SF_SMALL)
    out = jobs.profile_table(df, "delivery_days", ["sales", "delivery_days"])
    assert out["counts"].first()["n_rows"] == df.count()
    assert out["histogram"].count() == 30
    assert out["correlations"].count() == 4


def test_stream_windows_job_on_damaged_lines(spark, tmp_dir):
    from shiplens.sources import lines
    from shiplens.streaming.windows import run_streams

    s = fixtures.shipments(spark, SF_SMALL)
    keyed = s.select("order_key", F.to_json(F.struct(*fixtures.STREAM_FIELDS)).alias("value"))
    damaged = lines.damaged_lines(keyed, F.col("order_key"))
    src = os.path.join(tmp_dir, "lines")
    damaged.repartition(3).write.text(src)
    out, ck = os.path.join(tmp_dir, "windows"), os.path.join(tmp_dir, "ck")
    bad = os.path.join(tmp_dir, "bad")
    options = {"trigger": {"availableNow": True}, "source_options": {"maxFilesPerTrigger": 1}}
    run_streams([
        jobs.stream_windows(spark, src, out, ck, mode="complete", **options),
        jobs.stream_quarantine(spark, src, bad, ck + "-bad", **options),
    ], timeout_sec=300)
    got = spark.read.parquet(out)
    assert {"market", "n_events", "avg_delivery_days", "avg_sales", "window_start", "window_end"} <= set(got.columns)
    good = s.where(~((F.col("order_key") % 50 == 0) | (F.col("order_key") % 97 == 0) | (F.col("order_key") % 89 == 0)))
    # windows on arrival: no line is late, and the two outputs add up to the input
    assert got.agg(F.sum("n_events")).first()[0] == good.count()
    assert spark.read.parquet(bad).count() + good.count() == s.count()


def test_run_order_streams_together(spark, tmp_dir):
    from shiplens.sources import lines

    s = fixtures.shipments(spark, SF_SMALL)
    keyed = s.select("order_key", F.to_json(F.struct(*fixtures.STREAM_FIELDS)).alias("value"))
    src = os.path.join(tmp_dir, "lines")
    lines.damaged_lines(keyed, F.col("order_key")).write.text(src)
    # a model trained on the same table
    table = features.split_hash(features.feature_table(s.withColumn("geo_distance_km", F.lit(0.0))), ["order_id"], 0.8)
    res = ml.train_late_model(table, allow_leak=True, num_trees=5)
    model_path = os.path.join(tmp_dir, "model")
    ml.save_model(res.model, model_path)
    out = jobs.run_order_streams(spark, src, model_path, os.path.join(tmp_dir, "run"),
                                 trigger={"availableNow": True}, timeout_sec=600, window_mode="complete")
    preds = spark.read.parquet(out["predictions"])
    bad = spark.read.parquet(out["quarantine"]).count()
    assert preds.count() + bad == s.count()
    assert bad > 0 and preds.where(F.col("prob_class_1").isNull()).count() == 0
    docs = spark.read.parquet(out["documents"])
    assert docs.agg(F.sum("n_orders")).first()[0] == preds.count()
    assert set(docs.columns) >= {"ts", "market", "n_orders", "avg_delivery_days", "sum_sales", "batch_id"}
    assert spark.read.parquet(out["windows"]).agg(F.sum("n_events")).first()[0] == preds.count()
