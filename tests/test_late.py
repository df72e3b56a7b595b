"""Late lines beside windows, the state audit, and the one-shuffle late-event report."""

import os
import re

import pytest
from pyspark.sql import functions as F

from shiplens.operators import lateness
from shiplens.sinks import snapshots
from shiplens.sources import lines
from shiplens.streaming import late
from shiplens.streaming.windows import run_available, windowed_stats


def line(ts, market="EU", sales=1.5, days="2024-01-05 00:00:00"):
    return f'{{"order_id":"1","market":"{market}","order_date_dateorders":"{ts}","shipping_date_dateorders":"{days}","sales":{sales}}}'


def batch(spark, *values):
    return lines.decode_with_quarantine(spark.createDataFrame([(v,) for v in values], "value string"))


def counts(spark, base):
    windows = {(r["market"], str(r["window_start"])): r["n_events"] for r in late.read_windows(spark, base).collect()}
    late_rows = sorted(str(r["order_ts"]) for r in snapshots.read_runs(spark, f"{base}/late", "parquet").collect())
    return windows, late_rows, snapshots.read_runs(spark, f"{base}/quarantine", "parquet").count()


def test_every_line_is_in_a_window_late_or_in_quarantine(spark, tmp_dir):
    write = late.late_writer(tmp_dir, "order_ts", window="1 hour", delay="30 minutes", compact_every=2)
    first = batch(spark, line("2024-01-01 10:10:00"), line("2024-01-01 12:00:00"), "broken", "")
    # watermark 11:30: the window of 10 has ended, that of 11 not
    second = batch(spark, line("2024-01-01 10:59:59"), line("2024-01-01 11:00:00"), line("no date"), lines.HEARTBEAT)
    write(first, 0)
    write(second, 1)
    want = ({("EU", "2024-01-01 10:00:00"): 1, ("EU", "2024-01-01 12:00:00"): 1, ("EU", "2024-01-01 11:00:00"): 1}, ["2024-01-01 10:59:59", "None"], 3)
    assert counts(spark, tmp_dir) == want
    # a replay after a failure replaces its own rows, under the watermark it had
    write(second, 1)
    write(first, 0)
    assert counts(spark, tmp_dir) == want


def test_windows_add_up_odd_amounts_over_batches(spark, tmp_dir):
    write = late.late_writer(tmp_dir, "order_ts", window="1 hour")
    for i, sales in enumerate((0.1, 0.2, 1e18, "null")):
        write(batch(spark, line("2024-01-01 10:10:00", sales=sales)), i)
    write(batch(spark), 4)  # an empty batch
    row = late.read_windows(spark, tmp_dir).collect()
    assert len(row) == 1 and row[0]["n_events"] == 4 and row[0]["avg_delivery_days"] == 4.0
    assert row[0]["avg_sales"] == (1e18 + 0.3) / 3


def test_open_windows_and_their_layout(spark, tmp_dir):
    rows = [(f"2024-01-01 {h:02d}:{m:02d}:00", "EU", 2.0, 3) for h in range(5) for m in (0, 20, 40)]
    df = spark.createDataFrame(rows, "t string, market string, sales double, delivery_days int").withColumn("ts", F.col("t").cast("timestamp")).drop("t")
    df.coalesce(1).write.parquet(os.path.join(tmp_dir, "in"))
    stream = spark.readStream.schema(df.schema).parquet(os.path.join(tmp_dir, "in"))
    ck = os.path.join(tmp_dir, "ck")
    emitted = run_available(windowed_stats(stream, "ts", window="1 hour"), os.path.join(tmp_dir, "out"), ck)
    still = late.open_windows(spark, ck)
    assert emitted.count() + still.count() == 5 and still.count() >= 1
    assert {(r["n_events"], r["avg_delivery_days"], r["avg_sales"]) for r in still.collect()} == {(3, 3.0, 2.0)}
    with pytest.raises(ValueError, match="not the sums"):
        late.open_windows(spark, ck, days=False)


def brute(rows, delay):
    out = []
    for i, (k, t) in enumerate(rows):
        prior = [u for j, u in rows if j is not None and k is not None and j < k and u is not None]
        out.append((k, t, max(prior, default=None), bool(prior) and t is not None and t < max(prior) - delay))
    return sorted(out, key=str)


@pytest.mark.parametrize("per_range", [5, 40, 10**6])
def test_late_events_with_hot_and_negative_arrivals(spark, per_range):
    rows = [((i * 37) % 101 - 50, (i * 53) % 400) for i in range(200)]
    rows += [(7, (i * 11) % 500) for i in range(150)]  # one number that fills many ranges
    rows += [(7, 3)] * 60 + [(None, 5), (None, 900), (20, None), (-(2**40), 10), (2**60, 0)]
    df = spark.createDataFrame(rows, "`arr.ival` long, s long").withColumn("ts", F.timestamp_seconds("s")).repartition(5)
    out = lateness.late_events(df, "arr.ival", "ts", delay_seconds=100, rows_per_range=per_range)
    assert out.columns == ["arr.ival", "s", "ts", "prior_max_ts", "is_late"]
    got = [(r[0], r[1], None if r[3] is None else int(r[3].timestamp()), r[4]) for r in out.collect()]
    assert sorted(got, key=str) == brute(rows, 100)


def test_late_events_shuffles_its_rows_once(spark):
    df = spark.range(20_000).select((F.col("id") % 5000).alias("a"), F.timestamp_seconds(F.col("id") % 977).alias("ts"), F.lit("wide").alias("w"))
    out = lateness.late_events(df, "a", "ts", rows_per_range=1000)
    plan = out._jdf.queryExecution().executedPlan().toString()
    wide = [x for x in plan.split("\n") if "Exchange" in x and "Broadcast" not in x]
    # the rows by range; ranges' maxima (partial sums) and their one small window
    assert sum("hashpartitioning(__range" in x and "__piece" in x for x in wide) == 1
    assert not re.search(r"SortMergeJoin|ShuffledHashJoin|CartesianProduct|NestedLoop", plan)
    out.write.format("noop").mode("overwrite").save()


def test_a_hot_arrival_is_spread_over_pieces(spark):
    df = spark.range(4000).select(F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).cast("long").alias("a"), F.timestamp_seconds("id").alias("ts"))
    bounds = lateness.range_bounds(df.withColumn("__k", F.col("a")), "__k", 4000, 40)
    assert bounds[7] >= 15 and max(n for k, n in bounds.items() if k != 7) == 1
