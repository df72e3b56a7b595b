"""Stand-ins for the reference's inputs, derived from the driver's tables.

* ``shipments``     -- the wide order/shipment table (one row per line item)
* ``order_lines_json`` -- the stream record: one JSON object per line
* ``typed_events``  -- ``events`` with a zone-aware ``ts``
* ``agg_history``   -- the stored aggregate documents read by the dashboard

Every builder is a plain DataFrame plan over the parquet tables, so its work
grows with the tables.  The nation and region dimensions are broadcast after a
bounded row check (``operators.joins.is_small``); every other join starts
as a shuffled join, and AQE broadcasts a side only once its measured shuffle
size is below the adaptive threshold (static broadcast from file sizes is
off, see session.py).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiplens.functions.dates import day_diff
from shiplens.functions.numeric import LATE_THRESHOLD_DAYS, money, money_sum
from shiplens.operators.joins import is_small
from shiplens.sources.lines import ORDER_RECORD_SCHEMA, encode_json
from shiplens.sources.tables import as_utc_timestamps, read_table

# The two text layouts the stream producer uses for dates.
US_LAYOUT = "M/d/yyyy H:mm:ss"
ISO_LAYOUT = "yyyy-MM-dd HH:mm:ss"

# Fields of the stream order record, in the declared order.
STREAM_FIELDS = ORDER_RECORD_SCHEMA.fieldNames()


# Outcome of the size checks per application and folder: a plan is built for
# every query, the dimension needs to be measured once.
_SMALL: dict[tuple, bool] = {}


def _hinted(df: DataFrame, sf_dir: str, name: str) -> DataFrame:
    key = (df.sparkSession.sparkContext.applicationId, sf_dir, name)
    if key not in _SMALL:
        _SMALL[key] = is_small(df)
    return F.broadcast(df) if _SMALL[key] else df


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem ⋈ orders ⋈ customer ⋈ nation ⋈ region as the wide order table."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_shipdate"
    )
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"
    )
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")

    # nation x region is a fixed-size dimension; broadcast it (after a size
    # check) so the customer table is never shuffled on its 25 nation keys
    region = _hinted(region, sf_dir, "region")
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", "n_name", "r_name"
    )
    geo = _hinted(geo, sf_dir, "geo")
    cust_geo = cust.join(geo, cust.c_nationkey == geo.n_nationkey).select(
        "c_custkey", "c_mktsegment", "n_name", "r_name"
    )
    # Enrich the orders first (orders-sized), then join the line items once on
    # the order key: the line-item side, the largest by far, is shuffled one
    # time only.  A customer or order holding a third of all rows is split by
    # AQE's skew-join handling rather than landing in one task.
    orders_geo = orders.join(cust_geo, orders.o_custkey == cust_geo.c_custkey)
    joined = li.join(orders_geo, li.l_orderkey == orders_geo.o_orderkey)

    order_ts = F.col("o_orderdate").cast("timestamp")
    ship_ts = F.col("l_shipdate").cast("timestamp")
    odd = (F.col("l_orderkey") % 2) == 1
    delivery = day_diff(ship_ts, order_ts)
    return joined.select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("l_orderkey").alias("order_key"),
        F.col("l_linenumber").alias("line_number"),
        F.col("o_custkey").alias("customer_key"),
        F.col("l_suppkey").alias("supplier_key"),
        F.col("r_name").alias("market"),
        F.col("n_name").alias("order_region"),
        F.col("c_mktsegment").alias("customer_segment"),
        F.col("o_orderpriority").alias("shipping_mode"),
        order_ts.alias("order_ts"),
        ship_ts.alias("shipping_ts"),
        F.when(odd, F.date_format(order_ts, US_LAYOUT))
        .otherwise(F.date_format(order_ts, ISO_LAYOUT))
        .alias("order_date_dateorders"),
        F.when(odd, F.date_format(ship_ts, US_LAYOUT))
        .otherwise(F.date_format(ship_ts, ISO_LAYOUT))
        .alias("shipping_date_dateorders"),
        F.col("l_linenumber").alias("days_for_shipment_scheduled"),
        delivery.alias("days_for_shipping_real"),
        delivery.alias("delivery_days"),
        # fixed-point product, so the rounding is exact in every engine
        F.round(money("l_extendedprice") * money("l_discount"), 2).cast("double").alias("benefit_per_order"),
        F.col("l_extendedprice").alias("sales"),
        F.col("l_extendedprice").alias("order_item_product_price"),
        F.col("l_quantity").cast("int").alias("num_orders"),
        F.when(delivery > LATE_THRESHOLD_DAYS, 1).otherwise(0).alias("late_delivery_risk"),
    )


def order_lines_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream record as text: ``value`` holds one JSON object per line."""
    return encode_json(shipments(spark, sf_dir), STREAM_FIELDS)


def typed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` with ``ts`` as a zone-aware timestamp (UTC session)."""
    return as_utc_timestamps(read_table(spark, sf_dir, "events"))


def agg_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored aggregate documents: ``events`` per hour and event type.

    ``batch_id`` numbers the hours from the epoch so it is stable under any
    partitioning; ``market`` plays the event type.
    """
    ev = typed_events(spark, sf_dir)
    hour = F.date_trunc("hour", F.col("ts"))
    return (
        ev.groupBy(hour.alias("ts"), F.col("event_type").alias("market"))
        .agg(
            F.count(F.lit(1)).alias("n_orders"),
            (money_sum("value") / F.count(F.lit(1))).alias("avg_delivery_days"),
            money_sum("value").alias("sum_sales"),
        )
        .withColumn("batch_id", (F.unix_timestamp("ts") / 3600).cast("long"))
    )


# CSV-style headers of the raw order export, mapped to the
# fixture columns they carry.
RAW_HEADERS = {
    "Order Id": "order_id",
    "Customer Id": "customer_id",
    "Market": "market",
    "Order Region": "order_region",
    "Customer Segment": "customer_segment",
    "Shipping Mode": "shipping_mode",
    "order date (DateOrders)": "order_date_dateorders",
    "shipping date (DateOrders)": "shipping_date_dateorders",
    "Days for shipment (scheduled)": "days_for_shipment_scheduled",
    "Days for shipping (real)": "days_for_shipping_real",
    "Benefit per order": "benefit_per_order",
    "Sales": "sales",
    "Order Item Product Price": "order_item_product_price",
    "Order Item Quantity": "num_orders",
    "Origin Latitude": "origin_latitude",
    "Origin Longitude": "origin_longitude",
    "Dest Latitude": "dest_latitude",
    "Dest Longitude": "dest_longitude",
}


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order table as the raw export names its columns, with both ends' coordinates."""
    s = with_coordinates(shipments(spark, sf_dir))
    return s.select(*[F.col(src).alias(raw) for raw, src in RAW_HEADERS.items()])


def dirty_shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``shipments`` with missing values injected by a rule on the order key.

    sales null when key % 7 = 0, customer_segment blank when key % 11 = 0,
    order_region null when key % 13 = 0, delivery_days null when key % 17 = 0,
    benefit_per_order NaN when key % 19 = 0.  Every row is kept.
    """
    s = shipments(spark, sf_dir)
    k = F.col("order_key")
    return s.select(
        "order_id", "customer_id", "order_key", "line_number", "market",
        F.when(k % 13 == 0, F.lit(None).cast("string")).otherwise(F.col("order_region")).alias("order_region"),
        F.when(k % 11 == 0, F.lit("  ")).otherwise(F.col("customer_segment")).alias("customer_segment"),
        "shipping_mode",
        F.when(k % 17 == 0, F.lit(None).cast("int")).otherwise(F.col("delivery_days")).alias("delivery_days"),
        F.when(k % 19 == 0, F.lit(float("nan"))).otherwise(F.col("benefit_per_order")).alias("benefit_per_order"),
        F.when(k % 7 == 0, F.lit(None).cast("double")).otherwise(F.col("sales")).alias("sales"),
        "num_orders",
        "late_delivery_risk",
    )


def with_coordinates(df: DataFrame) -> DataFrame:
    """``df`` with the supplier's place as origin and the customer's as destination."""
    slat, slon = coordinates("supplier_key")
    clat, clon = coordinates("customer_key")
    places = {"origin_latitude": slat, "origin_longitude": slon, "dest_latitude": clat, "dest_longitude": clon}
    return df.withColumns({name: place.cast("double") for name, place in places.items()})


def coordinates(key: str) -> tuple:
    """Synthetic (lat, lon) for a numeric key: the tables carry no coordinates."""
    return (F.col(key) % 180) - 90, (F.col(key) % 360) - 180
