"""DuckDB-runnable SQL that states what each registered query must return.

The views ``region nation customer supplier part orders lineitem events`` are
registered over the same parquet files.  Shared fixtures are written once as
CTE text and reused.  Timestamps are compared as ``yyyy-MM-dd HH:mm:ss`` text
and money as fixed-point sums (ten digits behind the point) cast to double, so
both engines produce the same bits.
"""

from __future__ import annotations

from shiplens.operators.forest import scoring_sql
from shiplens.operators.model import MAX_DEPTH, PROBABILITY_DIGITS
from shiplens.plans.published import sql_source

# Date difference in whole days between the line's ship date and the order date.
_DAYS = "CAST(date_diff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) AS INTEGER)"

SHIPMENTS_CTE = f"""
shipments AS (
  SELECT
    CAST(l.l_orderkey AS VARCHAR) AS order_id,
    CAST(o.o_custkey AS VARCHAR) AS customer_id,
    l.l_orderkey AS order_key,
    l.l_linenumber AS line_number,
    o.o_custkey AS customer_key,
    l.l_suppkey AS supplier_key,
    r.r_name AS market,
    n.n_name AS order_region,
    c.c_mktsegment AS customer_segment,
    o.o_orderpriority AS shipping_mode,
    CAST(o.o_orderdate AS TIMESTAMP) AS order_ts,
    CAST(l.l_shipdate AS TIMESTAMP) AS shipping_ts,
    CASE WHEN l.l_orderkey % 2 = 1 THEN strftime(o.o_orderdate, '%-m/%-d/%Y %-H:%M:%S')
         ELSE strftime(o.o_orderdate, '%Y-%m-%d %H:%M:%S') END AS order_date_dateorders,
    CASE WHEN l.l_orderkey % 2 = 1 THEN strftime(l.l_shipdate, '%-m/%-d/%Y %-H:%M:%S')
         ELSE strftime(l.l_shipdate, '%Y-%m-%d %H:%M:%S') END AS shipping_date_dateorders,
    l.l_linenumber AS days_for_shipment_scheduled,
    {_DAYS} AS days_for_shipping_real,
    {_DAYS} AS delivery_days,
    CAST(round(CAST(l.l_extendedprice AS DECIMAL(18,2)) * CAST(l.l_discount AS DECIMAL(18,2)), 2) AS DOUBLE)
      AS benefit_per_order,
    l.l_extendedprice AS sales,
    l.l_extendedprice AS order_item_product_price,
    CAST(l.l_quantity AS INTEGER) AS num_orders,
    CASE WHEN {_DAYS} > 5 THEN 1 ELSE 0 END AS late_delivery_risk
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
)"""

DIRTY_CTE = """
dirty AS (
  SELECT order_id, customer_id, order_key, line_number, market,
    CASE WHEN order_key % 13 = 0 THEN NULL ELSE order_region END AS order_region,
    CASE WHEN order_key % 11 = 0 THEN '  ' ELSE customer_segment END AS customer_segment,
    shipping_mode,
    CASE WHEN order_key % 17 = 0 THEN NULL ELSE delivery_days END AS delivery_days,
    CASE WHEN order_key % 19 = 0 THEN CAST('NaN' AS DOUBLE) ELSE benefit_per_order END AS benefit_per_order,
    CASE WHEN order_key % 7 = 0 THEN NULL ELSE sales END AS sales,
    num_orders, late_delivery_risk
  FROM shipments
)"""

EVENTS_CTE = """
ev AS (SELECT event_id, CAST(ts AS TIMESTAMP) AS ts, user_id, event_type, value, props FROM events)"""

AGG_HISTORY_CTE = """
agg_history AS (
  SELECT date_trunc('hour', ts) AS ts,
         event_type AS market,
         count(*) AS n_orders,
         CAST(sum(CAST(value AS DECIMAL(28,10))) AS DOUBLE) / count(*) AS avg_delivery_days,
         CAST(sum(CAST(value AS DECIMAL(28,10))) AS DOUBLE) AS sum_sales,
         CAST(floor(epoch(date_trunc('hour', ts)) / 3600) AS BIGINT) AS batch_id
  FROM ev GROUP BY 1, 2
)"""


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + body


ORACLE: dict[str, str] = {}


def _place(key: str) -> tuple[str, str]:
    return f"CAST(({key} % 180) - 90 AS DOUBLE)", f"CAST(({key} % 360) - 180 AS DOUBLE)"


_FROM, _TO = _place("supplier_key"), _place("customer_key")
_PLACES = (
    f"{_FROM[0]} AS origin_latitude, {_FROM[1]} AS origin_longitude, "
    f"{_TO[0]} AS dest_latitude, {_TO[1]} AS dest_longitude"
)


def register(name: str, sql: str) -> None:
    ORACLE[name] = sql.strip()


register(
    "market_summary",
    with_ctes(
        SHIPMENTS_CTE,
        body="""
SELECT market,
       count(*) AS n_orders,
       avg(delivery_days) AS avg_delivery_days,
       CAST(sum(CAST(sales AS DECIMAL(28,10))) AS DOUBLE) AS sum_sales
FROM shipments GROUP BY market""",
    ),
)


def _hist_text(where: str = "", extra: str = "") -> str:
    return with_ctes(
        EVENTS_CTE,
        AGG_HISTORY_CTE,
        body=f"""
SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, market, n_orders, avg_delivery_days, sum_sales, batch_id
FROM agg_history {where} {extra}""",
    )


register(
    "resolve_group_column",
    with_ctes(
        SHIPMENTS_CTE,
        body="""
SELECT 'order_region' AS group_by, order_region AS group_value,
       count(*) AS n_orders,
       avg(delivery_days) AS avg_delivery_days,
       CAST(sum(CAST(sales AS DECIMAL(28,10))) AS DOUBLE) AS sum_sales
FROM shipments GROUP BY order_region""",
    ),
)

_REGION_STATS = """
SELECT order_region,
       count(*) AS region_order_count,
       CAST(sum(CAST(sales AS DECIMAL(28,10))) AS DOUBLE) / count(sales) AS region_avg_sales,
       avg(delivery_days) AS region_avg_delivery_days
FROM {src} GROUP BY order_region"""

register("region_stats", with_ctes(SHIPMENTS_CTE, body=_REGION_STATS.format(src="shipments")))

register(
    "join_group_stats",
    with_ctes(
        SHIPMENTS_CTE,
        DIRTY_CTE,
        "stats AS (" + _REGION_STATS.format(src="dirty") + ")",
        body="""
SELECT d.order_key, d.line_number, d.order_region,
       CAST(s.region_order_count AS DOUBLE) AS region_order_count, s.region_avg_sales, s.region_avg_delivery_days
FROM dirty d LEFT JOIN stats s ON d.order_region = s.order_region""",
    ),
)

register(
    "filter_time_range",
    _hist_text("WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts <= TIMESTAMP '2024-01-10 23:59:59.999999'"),
)
register("filter_market", _hist_text("WHERE market = 'click'"))

register(
    "dashboard_kpis",
    with_ctes(
        EVENTS_CTE,
        AGG_HISTORY_CTE,
        body="""
SELECT CAST(coalesce(sum(n_orders), 0) AS BIGINT) AS total_orders,
       round(avg(avg_delivery_days), 6) AS avg_delivery_days,
       round(sum(avg_delivery_days * n_orders) / sum(CASE WHEN avg_delivery_days IS NOT NULL THEN n_orders END), 6)
         AS weighted_avg_delivery_days,
       coalesce(CAST(sum(CAST(sum_sales AS DECIMAL(28,10))) AS DOUBLE), 0.0) AS total_sales
FROM agg_history""",
    ),
)

register(
    "rollup_of_rollups",
    with_ctes(
        EVENTS_CTE,
        AGG_HISTORY_CTE,
        body="""
SELECT market, CAST(sum(n_orders) AS BIGINT) AS n_orders,
       round(avg(avg_delivery_days), 6) AS avg_delivery_days,
       CAST(sum(CAST(sum_sales AS DECIMAL(28,10))) AS DOUBLE) AS sum_sales
FROM agg_history WHERE market IS NOT NULL GROUP BY market""",
    ),
)

register(
    "resample_hourly",
    with_ctes(
        EVENTS_CTE,
        AGG_HISTORY_CTE,
        """
h AS (SELECT market, date_trunc('hour', ts) AS hour, sum(n_orders) AS total FROM agg_history GROUP BY 1, 2),
spine AS (SELECT market, unnest(generate_series(min(hour), max(hour), INTERVAL 1 HOUR)) AS hour FROM h GROUP BY 1)""",
        body="""
SELECT spine.market, strftime(spine.hour, '%Y-%m-%d %H:%M:%S') AS ts, CAST(coalesce(h.total, 0) AS BIGINT) AS n_orders
FROM spine LEFT JOIN h ON spine.hour = h.hour AND spine.market = h.market""",
    ),
)

register(
    "distinct_markets",
    with_ctes(EVENTS_CTE, AGG_HISTORY_CTE, body="SELECT DISTINCT market FROM agg_history WHERE market IS NOT NULL"),
)

register("latest_n", _hist_text("", "ORDER BY ts DESC, market DESC LIMIT 200"))
register("preview_rows", _hist_text("", "ORDER BY ts, market LIMIT 20"))

register(
    "subcent_sums",
    with_ctes(
        SHIPMENTS_CTE,
        "p AS (SELECT market, CAST(CAST(sales AS DECIMAL(18,2)) * CAST(0.0371 AS DECIMAL(5,4)) AS DOUBLE) AS sales FROM shipments)",
        body="""
SELECT market, count(*) AS n_orders, CAST(sum(CAST(sales AS DECIMAL(28,10))) AS DOUBLE) AS sum_sales,
       CAST(sum(CAST(sales AS DECIMAL(28,10))) AS DOUBLE) AS rolled_up, round(avg(sales), 9) AS avg_sales
FROM p GROUP BY market""",
    ),
)

register(
    "normalize_columns",
    with_ctes(
        SHIPMENTS_CTE,
        body="""
SELECT order_id, customer_id, market, order_region, customer_segment, shipping_mode,
       order_date_dateorders, shipping_date_dateorders, days_for_shipment_scheduled,
       days_for_shipping_real, benefit_per_order, sales, order_item_product_price,
       num_orders AS order_item_quantity, """
        + _PLACES
        + """
FROM shipments""",
    ),
)

register(
    "select_present",
    with_ctes(
        SHIPMENTS_CTE,
        body="""
SELECT order_id, customer_id, market, order_region, shipping_mode, customer_segment, delivery_days, sales
FROM shipments""",
    ),
)

register(
    "ensure_column",
    with_ctes(
        SHIPMENTS_CTE,
        body="""
SELECT order_key, line_number, days_for_shipping_real AS delivery_days, 0.0 AS geo_distance_km,
       1 AS num_orders, CASE WHEN days_for_shipping_real > 5 THEN 1 ELSE 0 END AS late_delivery_risk
FROM shipments""",
    ),
)

register(
    "cast_numeric",
    with_ctes(
        SHIPMENTS_CTE,
        body="SELECT CAST(order_id AS BIGINT) AS order_id, CAST(customer_id AS BIGINT) AS customer_id, line_number "
        "FROM shipments",
    ),
)

register(
    "surrogate_key",
    with_ctes(
        SHIPMENTS_CTE,
        body="""
SELECT order_key, line_number,
       md5(concat(length(order_id), ':', order_id, length(CAST(line_number AS VARCHAR)), ':', line_number,
                  length(customer_id), ':', customer_id, length(market), ':', market)) AS row_key
FROM shipments""",
    ),
)

register(
    "late_label",
    with_ctes(
        SHIPMENTS_CTE,
        DIRTY_CTE,
        body="SELECT order_key, line_number, CAST(delivery_days AS DOUBLE) AS delivery_days, "
        "CASE WHEN delivery_days > 5 THEN 1 ELSE 0 END AS late "
        "FROM dirty",
    ),
)

register(
    "parse_dates",
    with_ctes(
        SHIPMENTS_CTE,
        body="""
SELECT order_key, line_number,
       strftime(order_ts, '%Y-%m-%d %H:%M:%S') AS order_ts,
       strftime(shipping_ts, '%Y-%m-%d %H:%M:%S') AS shipping_ts
FROM shipments""",
    ),
)

register(
    "delivery_days",
    with_ctes(SHIPMENTS_CTE, body="SELECT order_key, line_number, delivery_days FROM shipments"),
)

register(
    "coerce_numeric",
    """
SELECT event_id,
       TRY_CAST(trim(CASE WHEN event_id % 5 = 0 THEN 'n/a' ELSE ' ' || CAST(value AS VARCHAR) END) AS DOUBLE)
         AS value_num
FROM events""",
)

register(
    "coerce_typed_in",
    """
WITH t AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN ' -' || event_id WHEN 1 THEN (event_id % 1000) || '.5 '
                                WHEN 2 THEN ' n/a ' || event_id END AS typed FROM events)
SELECT event_id, CASE WHEN regexp_full_match(trim(typed), '-?[0-9]+') THEN CAST(trim(typed) AS DOUBLE) END AS whole,
       CASE WHEN NOT regexp_full_match(trim(typed), '-?[0-9]+') THEN TRY_CAST(trim(typed) AS DOUBLE) END AS number,
       CASE WHEN TRY_CAST(trim(typed) AS DOUBLE) IS NULL THEN trim(typed) END AS text
FROM t""",
)

_LAT = "(({k} % 180) - 90)"
_LON = "(({k} % 360) - 180)"


def _haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    root = (
        f"sqrt(pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) + "
        f"cos(radians({lat1})) * cos(radians({lat2})) * pow(sin((radians({lon2}) - radians({lon1})) / 2), 2))"
    )
    return f"coalesce(2 * 6371.0 * asin(CASE WHEN {root} > 1.0 THEN 1.0 ELSE {root} END), 0.0)"


register(
    "haversine",
    with_ctes(
        SHIPMENTS_CTE,
        body=f"""
SELECT order_key, line_number,
       round({_haversine_sql(_LAT.format(k='supplier_key'), _LON.format(k='supplier_key'),
                             _LAT.format(k='customer_key'), _LON.format(k='customer_key'))}, 6) AS geo_distance_km
FROM shipments""",
    ),
)

register(
    "impute_constant",
    with_ctes(
        SHIPMENTS_CTE,
        DIRTY_CTE,
        body="""
SELECT order_key, line_number,
       coalesce(order_region, 'unknown') AS order_region,
       coalesce(customer_segment, 'unknown') AS customer_segment,
       coalesce(delivery_days, 0) AS delivery_days,
       CASE WHEN benefit_per_order IS NULL OR isnan(benefit_per_order) THEN 0.0 ELSE benefit_per_order END
         AS benefit_per_order,
       CASE WHEN sales IS NULL OR isnan(sales) THEN 0.0 ELSE sales END AS sales
FROM dirty""",
    ),
)

register(
    "impute_median",
    with_ctes(
        SHIPMENTS_CTE,
        DIRTY_CTE,
        "m AS (SELECT quantile_disc(delivery_days, 0.5) AS md, quantile_disc(sales, 0.5) AS ms FROM dirty)",
        body="""
SELECT order_key, line_number,
       coalesce(order_region, 'unknown') AS order_region,
       coalesce(delivery_days, m.md) AS delivery_days,
       coalesce(sales, m.ms) AS sales
FROM dirty, m""",
    ),
)

register(
    "median_columns",
    with_ctes(
        SHIPMENTS_CTE,
        DIRTY_CTE,
        body="""
SELECT 'delivery_days' AS column_name, CAST(quantile_disc(delivery_days, 0.5) AS DOUBLE) AS median FROM dirty
UNION ALL SELECT 'sales', CAST(quantile_disc(sales, 0.5) AS DOUBLE) FROM dirty
UNION ALL SELECT 'num_orders', CAST(quantile_disc(num_orders, 0.5) AS DOUBLE) FROM dirty""",
    ),
)

DIRTY_COLUMNS = [
    "order_id", "customer_id", "order_key", "line_number", "market", "order_region", "customer_segment",
    "shipping_mode", "delivery_days", "benefit_per_order", "sales", "num_orders", "late_delivery_risk",
]


def _missing_sql() -> str:
    parts = [
        f"SELECT '{c}' AS column_name, "
        f"CAST(sum(CASE WHEN {c} IS NULL OR trim(CAST({c} AS VARCHAR)) = '' THEN 1 ELSE 0 END) AS BIGINT) AS n_missing, "
        f"count(*) AS n_rows FROM dirty"
        for c in DIRTY_COLUMNS
    ]
    return with_ctes(
        SHIPMENTS_CTE,
        DIRTY_CTE,
        "p AS (" + "\nUNION ALL ".join(parts) + ")",
        body="SELECT column_name, n_missing, n_rows, "
        "CASE WHEN n_rows > 0 THEN n_missing / n_rows END AS missing_ratio FROM p",
    )


register("profile_missing", _missing_sql())
register(
    "profile_counts",
    with_ctes(SHIPMENTS_CTE, DIRTY_CTE, body=f"SELECT count(*) AS n_rows, {len(DIRTY_COLUMNS)} AS n_columns FROM dirty"),
)
register(
    "drop_sparse_columns",
    with_ctes(SHIPMENTS_CTE, DIRTY_CTE, body="SELECT order_key, line_number, order_region, customer_segment FROM dirty"),
)

_CORR_COLS = ["delivery_days", "sales", "num_orders", "benefit_per_order"]


def _corr_sql() -> str:
    def v(c: str) -> str:
        return f"CASE WHEN NOT isnan(CAST({c} AS DOUBLE)) THEN CAST({c} AS DOUBLE) END"

    parts = [
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({v(a)}, {v(b)}), 6) AS r FROM dirty"
        for a in _CORR_COLS
        for b in _CORR_COLS
    ]
    return with_ctes(SHIPMENTS_CTE, DIRTY_CTE, body="\nUNION ALL ".join(parts))


register("correlation_matrix", _corr_sql())

register(
    "histogram",
    with_ctes(
        SHIPMENTS_CTE,
        """
x AS (SELECT CAST(delivery_days AS DOUBLE) AS x FROM shipments WHERE delivery_days IS NOT NULL),
b AS (SELECT min(x) AS lo, max(x) AS hi, (max(x) - min(x)) / 30.0 AS w FROM x),
c AS (SELECT CAST(least(floor((x.x - b.lo) / b.w), 29) AS INTEGER) AS bin, count(*) AS n FROM x, b GROUP BY 1),
spine AS (SELECT CAST(range AS INTEGER) AS bin FROM range(30))""",
        body="""
SELECT spine.bin, b.lo + spine.bin * b.w AS bin_lo, b.lo + (spine.bin + 1) * b.w AS bin_hi,
       CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM spine CROSS JOIN b LEFT JOIN c ON spine.bin = c.bin""",
    ),
)

register(
    "density_curve",
    with_ctes(
        SHIPMENTS_CTE,
        """
x AS (SELECT CAST(delivery_days AS DOUBLE) AS x FROM shipments WHERE delivery_days IS NOT NULL),
st AS (SELECT count(*) AS n, min(x) AS lo, max(x) AS hi, stddev_samp(x) AS sd FROM x),
prm AS (SELECT n, lo, (hi - lo) / 49 AS step, sd * pow(n, -1.0 / 5.0) AS h FROM st),
grid AS (SELECT CAST(range AS INTEGER) AS point, prm.lo + range * prm.step AS g, prm.h, prm.n FROM range(50), prm)""",
        body="""
SELECT grid.point, grid.g AS x,
       round(sum(exp(-0.5 * pow((grid.g - x.x) / grid.h, 2))) * (1.0 / (grid.n * grid.h * sqrt(2.0 * pi()))), 12)
         AS density
FROM grid, x GROUP BY grid.point, grid.g, grid.h, grid.n""",
    ),
)

register(
    "density_binned",
    with_ctes(
        SHIPMENTS_CTE,
        """
st AS (SELECT count(*) AS n, min(sales) AS lo, max(sales) AS hi, stddev_samp(sales) AS sd FROM shipments),
prm AS (SELECT n, lo, hi, (hi - lo) / 511 AS cell, (hi - lo) / 49 AS step, sd * pow(n, -1.0 / 5.0) AS h FROM st),
placed AS (SELECT (sales - lo) / cell AS u, least(floor((sales - lo) / cell), 510) AS c FROM shipments, prm),
sums AS (SELECT CAST(c AS INTEGER) AS c, count(*) AS n, sum(u - c) AS f FROM placed GROUP BY 1),
w AS (SELECT e, sum(w) AS w FROM (SELECT c AS e, n - f AS w FROM sums UNION ALL SELECT c + 1, f FROM sums) GROUP BY e),
far AS (SELECT CAST(p.range AS INTEGER) AS point, prm.lo + p.range * prm.step AS x, ((prm.lo + p.range * prm.step) - (prm.lo + w.e * prm.cell)) / prm.h AS d, w.w, prm.n, prm.h
        FROM range(50) p, prm, w)""",
        body="""
SELECT point, x, round(sum(CASE WHEN abs(d) <= 6 THEN exp(-0.5 * d * d) * w ELSE 0 END) / (any_value(n) * any_value(h) * sqrt(2 * pi())), 9) AS density
FROM far GROUP BY point, x""",
    ),
)
register(
    "quantile_sketches",
    with_ctes(
        SHIPMENTS_CTE,
        DIRTY_CTE,
        body=" UNION ALL ".join(
            f"SELECT market, '{c}' AS column_name, count({c}) AS n, {q}::DOUBLE AS q, CAST(quantile_disc({c}, {q}) AS DOUBLE) AS value FROM dirty GROUP BY market"
            for c in ("sales", "delivery_days")
            for q in (0.1, 0.5, 0.99)
        ),
    ),
)


def _wide_correlations() -> str:
    base = {"delivery_days": 10, "sales": 1000, "num_orders": 10, "benefit_per_order": 10}
    number = {c: f"(CASE WHEN isnan(CAST({c} AS DOUBLE)) THEN NULL ELSE CAST({c} AS DOUBLE) END / {d}.0)" for c, d in base.items()}
    cols = [(f"{c}_{p}", f"pow({number[c]}, {p})") for c in base for p in (1, 2, 3, 4, 5)]
    wide = "w AS (SELECT " + ", ".join(f"{x} AS {name}" for name, x in cols) + " FROM dirty)"
    aggs = [(a, b, f"c{i}_{j}") for i, (a, _) in enumerate(cols) for j, (b, _) in enumerate(cols) if i <= j]
    r = "r AS (SELECT " + ", ".join(f"corr({a}, {b}) AS {name}" for a, b, name in aggs) + " FROM w)"
    rows = [(a, b, name) for a, b, name in aggs] + [(b, a, name) for a, b, name in aggs if a != b]
    table = ", ".join(f"{{'col_a': '{a}', 'col_b': '{b}', 'r': round({name}, 6)}}" for a, b, name in rows)
    return with_ctes(SHIPMENTS_CTE, DIRTY_CTE, wide, r, body=f"SELECT x.col_a, x.col_b, x.r FROM (SELECT unnest([{table}]) AS x FROM r)")


register("wide_correlations", _wide_correlations())
register(
    "csv_quarantine",
    with_ctes(
        SHIPMENTS_CTE,
        "t AS (SELECT *, order_key % 50 = 0 OR order_key % 97 = 0 OR order_key % 89 = 0 AS bad FROM shipments)",
        body="""
SELECT 'ok' AS status, market, count(*) AS n_lines, CAST(sum(CAST(sales AS DECIMAL(28,10))) AS DOUBLE) AS sum_sales, 0 AS n_raw
FROM t WHERE NOT bad GROUP BY market
UNION ALL SELECT 'quarantine', NULL, count(*), NULL, count(*) FROM t WHERE bad""",
    ),
)

_HASH_KEY = "substr(md5(concat_ws(':', coalesce(order_id, ''), coalesce(CAST(line_number AS VARCHAR), ''))), 1, 8)"

register(
    "sample_hash",
    with_ctes(
        SHIPMENTS_CTE,
        body=f"SELECT order_key, line_number, sales FROM shipments WHERE {_HASH_KEY} < '{format(int(0.1 * 16**8), '08x')}'",
    ),
)

register(
    "split_hash",
    with_ctes(
        SHIPMENTS_CTE,
        body=f"""
SELECT CASE WHEN {_HASH_KEY} < '{format(int(0.8 * 16**8), '08x')}' THEN 'train' ELSE 'test' END AS split,
       count(*) AS n_rows, CAST(sum(late_delivery_risk) AS BIGINT) AS n_late,
       CAST(sum(CAST(sales AS DECIMAL(28,10))) AS DOUBLE) AS sum_sales
FROM shipments GROUP BY 1""",
    ),
)

register(
    "feature_table",
    with_ctes(
        SHIPMENTS_CTE,
        DIRTY_CTE,
        body="""
SELECT 0.0 AS geo_distance_km,
       coalesce(order_region, 'unknown') AS order_region,
       coalesce(shipping_mode, 'unknown') AS shipping_mode,
       coalesce(customer_segment, 'unknown') AS customer_segment,
       CASE WHEN sales IS NULL OR isnan(sales) THEN 0.0 ELSE sales END AS sales,
       coalesce(delivery_days, 0) AS delivery_days,
       coalesce(num_orders, 0) AS num_orders,
       late_delivery_risk, order_id, customer_id, market
FROM dirty""",
    ),
)

register(
    "json_decode",
    "SELECT event_id, TRY_CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events",
)

register(
    "json_roundtrip",
    with_ctes(
        SHIPMENTS_CTE,
        body="""
SELECT order_id, customer_id, market, customer_segment, shipping_mode, order_date_dateorders,
       shipping_date_dateorders, days_for_shipment_scheduled, days_for_shipping_real, benefit_per_order,
       sales, order_item_product_price
FROM shipments""",
    ),
)

register(
    "json_quarantine",
    with_ctes(
        SHIPMENTS_CTE,
        """
tagged AS (
  SELECT CASE WHEN order_key % 50 = 0 OR order_key % 97 = 0 OR order_key % 89 = 0 THEN 'quarantine' ELSE 'ok' END
           AS status,
         sales
  FROM shipments)""",
        body="""
SELECT status, count(*) AS n_lines,
       CAST(sum(CASE WHEN status = 'ok' THEN CAST(sales AS DECIMAL(28,10)) END) AS DOUBLE) AS sum_sales
FROM tagged GROUP BY status""",
    ),
)

register(
    "late_events",
    with_ctes(
        SHIPMENTS_CTE,
        """
k AS (SELECT order_key * 8 + line_number AS arrival, max(order_ts) AS kmax FROM shipments GROUP BY 1),
p AS (SELECT arrival, max(kmax) OVER (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior
      FROM k)""",
        body="""
SELECT s.order_key, s.line_number, strftime(p.prior, '%Y-%m-%d %H:%M:%S') AS prior_max_ts,
       coalesce(s.order_ts < p.prior - INTERVAL 30 DAY, false) AS is_late
FROM shipments s JOIN p ON s.order_key * 8 + s.line_number = p.arrival""",
    ),
)

_NORMALIZED = ORACLE["normalize_columns"]
register("src_csv_roundtrip", _NORMALIZED)
register("sink_parquet_idempotent", _hist_text())
register("sink_parquet_overwrite", ORACLE["market_summary"])
register("sink_csv_market_summary", ORACLE["market_summary"])
register(
    "agg_documents",
    with_ctes(
        SHIPMENTS_CTE,
        body="""
SELECT market, count(*) AS n_orders, avg(delivery_days) AS avg_delivery_days,
       coalesce(CAST(sum(CAST(sales AS DECIMAL(28,10))) AS DOUBLE), 0.0) AS sum_sales,
       'market' AS group_by, market AS region_or_market
FROM shipments GROUP BY market""",
    ),
)
register(
    "agg_readback",
    _hist_text(
        "WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts <= TIMESTAMP '2024-01-10 23:59:59.999999' "
        "AND market = 'view'"
    ),
)

# JOB-1: the raw export read back from CSV, names normalised, delivery
# features derived, missing values imputed (the export has none).
_DISTANCE = _haversine_sql(*_FROM, *_TO)
_PREPARED = with_ctes(
    SHIPMENTS_CTE,
    body=f"""
SELECT round({_DISTANCE}, 6) AS geo_distance_km, order_region, shipping_mode, customer_segment, sales,
       days_for_shipping_real AS delivery_days, num_orders,
       CASE WHEN days_for_shipping_real > 5 THEN 1 ELSE 0 END AS late_delivery_risk,
       order_id, customer_id, market
FROM shipments""",
)
register("job_prepare", _PREPARED)
register("documents_readback", _hist_text())
_ORDER_HASH = "substr(md5(concat_ws(':', coalesce(order_id, ''), coalesce(customer_id, ''))), 1, 8)"
register(
    "job_prepare_sample",
    f"SELECT * FROM ({_PREPARED}) p WHERE {_ORDER_HASH} < '{format(int(0.1 * 16**8), '08x')}'",
)

_WINDOWS_CTE = """
w AS (
  SELECT event_type AS market, time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
         time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
         count(*) AS n_events, CAST(sum(CAST(value AS DECIMAL(28,10))) AS DOUBLE) / count(value) AS avg_sales
  FROM ev GROUP BY 1, 2
)"""

_WINDOW_SELECT = """
SELECT market, n_events, avg_sales,
       strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(window_end, '%Y-%m-%d %H:%M:%S') AS window_end
FROM w"""

register("window_tumbling", with_ctes(EVENTS_CTE, _WINDOWS_CTE, body=_WINDOW_SELECT))
register("stream_window", with_ctes(EVENTS_CTE, _WINDOWS_CTE, body=_WINDOW_SELECT))
register(
    "stream_window_append",
    with_ctes(
        EVENTS_CTE,
        _WINDOWS_CTE,
        body=_WINDOW_SELECT + " WHERE window_end <= (SELECT max(ts) - INTERVAL 30 SECOND FROM ev)",
    ),
)
register("stream_lines", with_ctes(SHIPMENTS_CTE, body="SELECT count(*) AS n_lines FROM shipments"))
register(
    "stream_enrich",
    with_ctes(
        SHIPMENTS_CTE,
        body="""
SELECT order_id, strftime(order_ts, '%Y-%m-%d %H:%M:%S') AS order_ts,
       strftime(shipping_ts, '%Y-%m-%d %H:%M:%S') AS shipping_ts, delivery_days
FROM shipments""",
    ),
)
register(
    "stream_batch_rollup",
    with_ctes(
        SHIPMENTS_CTE,
        body="""
SELECT market, count(*) AS n_orders, CAST(sum(CAST(sales AS DECIMAL(28,10))) AS DOUBLE) AS sum_sales
FROM shipments GROUP BY market""",
    ),
)


def _index_sql(col: str) -> str:
    return f"""
SELECT '{col}' AS column_name, value, CAST(row_number() OVER (ORDER BY n DESC, value ASC) - 1 AS INTEGER) AS idx, n
FROM (SELECT {col} AS value, count(*) AS n FROM shipments GROUP BY 1)"""


register(
    "string_index",
    with_ctes(
        SHIPMENTS_CTE,
        body="\nUNION ALL ".join(_index_sql(c) for c in ("shipping_mode", "customer_segment", "order_region")),
    ),
)

register(
    "one_hot",
    with_ctes(
        SHIPMENTS_CTE,
        """
ix AS (SELECT value, n, CAST(row_number() OVER (ORDER BY n DESC, value ASC) - 1 AS INTEGER) AS idx,
              count(*) OVER () AS k
       FROM (SELECT customer_segment AS value, count(*) AS n FROM shipments GROUP BY 1))""",
        body="""
SELECT value AS customer_segment,
       concat(repeat('0,', idx), '1', repeat(',0', CAST(k - 1 - idx AS INTEGER))) AS one_hot,
       n
FROM ix""",
    ),
)

register(
    "standard_scale",
    with_ctes(
        SHIPMENTS_CTE,
        body="""
SELECT order_key, line_number,
       round(sales / stddev_samp(sales) OVER (), 6) AS scaled_sales,
       round(delivery_days / stddev_samp(delivery_days) OVER (), 6) AS scaled_delivery_days
FROM shipments""",
    ),
)


def _kind_and_number(x: str, name: str) -> str:
    kind = f"CASE WHEN isnan({x}) THEN 'NaN' WHEN {x} = 'inf'::DOUBLE THEN 'inf' WHEN {x} = '-inf'::DOUBLE THEN '-inf' ELSE 'number' END"
    return f"{kind} AS {name}_kind, CASE WHEN isfinite({x}) THEN {x} END AS {name}"


register(
    "extreme_sums",
    with_ctes(
        SHIPMENTS_CTE,
        """
odd AS (SELECT order_region, CAST(substr(order_region, 8, 2) AS INTEGER) % 5 AS kind, order_key % 50 = 0 AS odd, line_number, sales FROM shipments),
ext AS (SELECT order_region, kind, count(*) AS n, count(*) FILTER (WHERE odd) AS n_odd,
          count(*) FILTER (WHERE odd AND line_number % 2 = 0) AS n_even,
          CAST(coalesce(sum(CAST(sales AS DECIMAL(28,10))) FILTER (WHERE NOT (odd AND kind < 4)), 0) AS DOUBLE) AS plain
        FROM odd GROUP BY 1, 2),
t AS (SELECT order_region, n, CASE
          WHEN kind = 4 OR n_odd = 0 THEN plain WHEN kind = 0 THEN 'nan'::DOUBLE WHEN kind = 1 THEN 'inf'::DOUBLE
          WHEN kind = 2 AND n_even = 0 THEN '-inf'::DOUBLE WHEN kind = 2 AND n_even = n_odd THEN 'inf'::DOUBLE WHEN kind = 2 THEN 'nan'::DOUBLE
          ELSE n_odd * 1152921504606846976.0::DOUBLE + plain END AS total FROM ext)""",
        body=f"""
SELECT order_region, n AS n_orders, {_kind_and_number("total", "sum_sales")}, {_kind_and_number("total", "rolled_up")},
       {_kind_and_number("total / n", "region_avg_sales")}
FROM t""",
    ),
)

# ---------------------------------------------------------------- order windows
def _order_windows(days: int) -> str:
    # Spark's windows of whole days start at the epoch
    start = f"epoch_ms(CAST(floor(epoch(order_ts) / {86400 * days}) * {86400 * days} * 1000 AS BIGINT))"
    return with_ctes(
        SHIPMENTS_CTE,
        f"w AS (SELECT market, {start} AS s, delivery_days, sales FROM shipments)",
        body=f"""
SELECT market, count(*) AS n_events, round(avg(delivery_days), 6) AS avg_delivery_days,
       CAST(sum(CAST(sales AS DECIMAL(28,10))) AS DOUBLE) / count(sales) AS avg_sales,
       strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(s + INTERVAL {days} DAY, '%Y-%m-%d %H:%M:%S') AS window_end
FROM w GROUP BY market, s""",
    )


register("window_orders", _order_windows(30))
register("stream_window_update", _order_windows(30))
_BAD = "(order_key % 50 = 0 OR order_key % 97 = 0 OR order_key % 89 = 0)"
register(
    "job_stream_windows",
    with_ctes(
        SHIPMENTS_CTE,
        body=f"""
SELECT market, count(*) AS n_events, round(avg(delivery_days), 6) AS avg_delivery_days
FROM shipments WHERE NOT {_BAD} GROUP BY market
UNION ALL SELECT '(quarantine)', count(*), NULL FROM shipments WHERE {_BAD}""",
    ),
)

register(
    "stream_state_audit",
    with_ctes(
        EVENTS_CTE,
        _WINDOWS_CTE,
        body=_WINDOW_SELECT.replace(
            "SELECT market,",
            "SELECT CASE WHEN window_end <= (SELECT max(ts) - INTERVAL 30 SECOND FROM ev) THEN 'emitted' ELSE 'open' END AS state, market,",
        ),
    ),
)
register(
    "stream_late_split",
    with_ctes(
        SHIPMENTS_CTE,
        f"""
good AS (SELECT order_key % 4 AS f, market, order_ts, sales, delivery_days,
           epoch_ms(CAST(floor(epoch(order_ts) / {86400 * 30}) * {86400 * 30} * 1000 AS BIGINT)) AS s
         FROM shipments WHERE NOT {_BAD}),
wm AS (SELECT a.f, (SELECT max(order_ts) FROM good g WHERE g.f < a.f) - INTERVAL 1800 DAY AS w FROM (SELECT unnest([0, 1, 2, 3]) AS f) a),
split AS (SELECT g.*, coalesce(s + INTERVAL 30 DAY <= wm.w, false) AS late FROM good g JOIN wm ON wm.f = g.f)""",
        body=f"""
SELECT 'window' AS kind, market, strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS n_events,
       CAST(sum(CAST(sales AS DECIMAL(28,10))) AS DOUBLE) / count(sales) AS avg_sales, round(avg(delivery_days), 6) AS avg_delivery_days
FROM split WHERE NOT late GROUP BY market, s
UNION ALL SELECT 'late', market, NULL, count(*), NULL, NULL FROM split WHERE late GROUP BY market
UNION ALL SELECT 'quarantine', NULL, NULL, count(*), NULL, NULL FROM shipments WHERE {_BAD}""",
    ),
)

# ---------------------------------------------------------------- jobs and model
_SPLIT = f"CASE WHEN {_HASH_KEY} < '{format(int(0.8 * 16**8), '08x')}' THEN 'train' ELSE 'test' END"
_ORDER_SPLIT = f"CASE WHEN {_ORDER_HASH} < '{format(int(0.8 * 16**8), '08x')}' THEN 'train' ELSE 'test' END"
_MODEL_ROWS = f"""
m AS (SELECT order_id, customer_id, market, line_number, order_region, shipping_mode, customer_segment, delivery_days, sales, num_orders,
        late_delivery_risk, {_DISTANCE} AS geo_distance_km FROM shipments)"""


def _forest(rows: str, nodes: str) -> str:
    """CTEs that score the query ``rows`` by the published node table ``nodes``."""
    texts = ["order_region", "shipping_mode", "customer_segment"]
    return scoring_sql(rows, sql_source(nodes), texts, ["geo_distance_km", "sales", "delivery_days", "num_orders"], MAX_DEPTH)


# exact AUC by rank sum and accuracy, over the scored rows
_AUC = f"""
auc_rows AS (SELECT round(prob_class_1, {PROBABILITY_DIGITS}) AS p, late_delivery_risk AS y, prediction FROM forest_scored),
auc_counts AS (SELECT p, count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y = 0) AS neg FROM auc_rows GROUP BY p),
auc_below AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM auc_counts),
auc AS (SELECT CAST(sum(pos * (2 * below + neg)) AS DOUBLE) / CAST(2 * sum(pos) * sum(neg) AS DOUBLE) AS auc,
        (SELECT count(*) FROM auc_rows) AS n, (SELECT avg(CASE WHEN y = prediction THEN 1.0 ELSE 0.0 END) FROM auc_rows) AS accuracy FROM auc_below)"""

register(
    "job_train",
    with_ctes(
        SHIPMENTS_CTE,
        _MODEL_ROWS,
        _forest(f"SELECT * FROM m WHERE {_ORDER_SPLIT} = 'test'", "job-forest"),
        _AUC,
        body=f"""
SELECT (SELECT count(*) FROM m WHERE {_ORDER_SPLIT} = 'train') AS n_train, n AS n_test, round(auc, 9) AS auc, round(accuracy, 9) AS accuracy
FROM auc""",
    ),
)
register(
    "job_score",
    with_ctes(
        SHIPMENTS_CTE,
        f"""
runs AS (SELECT market, sales FROM shipments UNION ALL SELECT market, sales FROM shipments WHERE {_SPLIT} = 'test')""",
        body="SELECT market, 2::BIGINT AS n_runs, count(*) AS n_orders, round(CAST(sum(CAST(sales AS DECIMAL(28,10))) AS DOUBLE), 2) AS sum_sales "
        "FROM runs GROUP BY market",
    ),
)
register(
    "job_report",
    with_ctes(
        EVENTS_CTE,
        AGG_HISTORY_CTE,
        """
d AS (SELECT * FROM agg_history WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-21'),
h AS (SELECT date_trunc('hour', ts) AS hour, sum(n_orders) AS total FROM d GROUP BY 1),
spine AS (SELECT unnest(generate_series(min(hour), max(hour), INTERVAL 1 HOUR)) AS hour FROM h),
l AS (SELECT * FROM d ORDER BY ts DESC, market DESC LIMIT 50)""",
        body="""
SELECT 'kpis' AS section, 'all' AS key, CAST(sum(n_orders) AS DOUBLE) AS n_orders,
       round(CAST(sum(CAST(sum_sales AS DECIMAL(28,10))) AS DOUBLE), 2) AS value FROM d
UNION ALL SELECT 'hourly', strftime(spine.hour, '%Y-%m-%d %H:%M:%S'), CAST(coalesce(h.total, 0) AS DOUBLE), NULL
  FROM spine LEFT JOIN h ON spine.hour = h.hour
UNION ALL SELECT 'by_market', market, CAST(sum(n_orders) AS DOUBLE),
       round(CAST(sum(CAST(sum_sales AS DECIMAL(28,10))) AS DOUBLE), 2) FROM d GROUP BY market
UNION ALL SELECT 'latest', strftime(ts, '%Y-%m-%d %H:%M:%S') || '|' || market, CAST(n_orders AS DOUBLE), round(sum_sales, 2) FROM l
UNION ALL SELECT DISTINCT 'markets', market, NULL, NULL FROM d""",
    ),
)
_DIRTY_HISTOGRAM = ORACLE["histogram"].replace("FROM shipments WHERE", "FROM dirty WHERE").replace(SHIPMENTS_CTE, SHIPMENTS_CTE + "," + DIRTY_CTE)
register(
    "job_profile",
    f"""
SELECT 'counts' AS section, 'rows' AS key, CAST(n_rows AS DOUBLE) AS value FROM ({ORACLE["profile_counts"]})
UNION ALL SELECT 'missing', column_name, CAST(n_missing AS DOUBLE) FROM ({ORACLE["profile_missing"]})
UNION ALL SELECT 'correlations', col_a || '|' || col_b, r FROM ({ORACLE["correlation_matrix"]})
UNION ALL SELECT 'histogram', CAST(bin AS VARCHAR), CAST(n AS DOUBLE) FROM ({_DIRTY_HISTOGRAM})""",
)

_FOREST = "late-forest"
_SCORED = f"prediction, round(prob_class_1, {PROBABILITY_DIGITS}) AS prob_class_1"
_TEST = _forest(f"SELECT * FROM m WHERE {_SPLIT} = 'test'", _FOREST)
register(
    "train_late_model",
    with_ctes(
        SHIPMENTS_CTE,
        _MODEL_ROWS,
        f"sp AS (SELECT *, {_SPLIT} AS split FROM m)",
        _TEST,
        _AUC,
        body="""
SELECT count(*) FILTER (WHERE split = 'train') AS n_train, count(*) FILTER (WHERE split = 'test') AS n_test, 100 AS num_trees,
       CAST(count(DISTINCT shipping_mode) FILTER (WHERE split = 'train') + count(DISTINCT customer_segment) FILTER (WHERE split = 'train')
            + count(DISTINCT order_region) FILTER (WHERE split = 'train') + 4 AS INTEGER) AS num_features,
       (SELECT round(auc, 9) FROM auc) AS auc, (SELECT round(accuracy, 9) FROM auc) AS accuracy
FROM sp""",
    ),
)
def _batch(nodes: str) -> str:
    return with_ctes(
        SHIPMENTS_CTE,
        _MODEL_ROWS,
        _forest("SELECT * FROM m", nodes),
        body=f"""
SELECT order_id, customer_id, market, order_region, shipping_mode, customer_segment, delivery_days, sales, {_SCORED}
FROM forest_scored""",
    )


register("score_batch", _batch(_FOREST))
register("score_natively", _batch(_FOREST))
register(
    "evaluate_model",
    with_ctes(
        SHIPMENTS_CTE, _MODEL_ROWS, _TEST, _AUC, body="SELECT n AS n_test, round(auc, 9) AS auc, round(accuracy, 9) AS accuracy FROM auc"
    ),
)


def _column_auc(column: str) -> str:
    return f"""
SELECT '{column}' AS score, CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(neg) AS BIGINT) AS negatives,
       round(CAST(sum(pos * (2 * below + neg)) AS DOUBLE) / CAST(2 * sum(pos) * sum(neg) AS DOUBLE), 12) AS auc
FROM (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
      FROM (SELECT {column} AS x, count(*) FILTER (WHERE late_delivery_risk = 1) AS pos, count(*) FILTER (WHERE late_delivery_risk = 0) AS neg
            FROM dirty WHERE {column} IS NOT NULL GROUP BY 1))"""


register("rank_sum_auc", with_ctes(SHIPMENTS_CTE, DIRTY_CTE, body=" UNION ALL ".join(map(_column_auc, ("sales", "num_orders", "delivery_days")))))
register(
    "confusion_matrix",
    with_ctes(
        SHIPMENTS_CTE,
        _MODEL_ROWS,
        _TEST,
        body="SELECT late_delivery_risk AS label, CAST(prediction AS INTEGER) AS prediction, count(*) AS n FROM forest_scored GROUP BY 1, 2",
    ),
)
_UPLOAD = f"""
SELECT *, {_haversine_sql("origin_latitude", "origin_longitude", "dest_latitude", "dest_longitude")} AS geo_distance_km,
       days_for_shipping_real AS delivery_days, order_item_quantity AS num_orders FROM ({_NORMALIZED}) n"""
register(
    "score_uploaded_csv",
    "WITH " + _forest(_UPLOAD, _FOREST) + f"SELECT * EXCLUDE (rid, geo_distance_km, delivery_days, num_orders, prediction, prob_class_1), {_SCORED} FROM forest_scored",
)
_STREAM_ROWS = """
SELECT market, 'unknown' AS order_region, shipping_mode, customer_segment, 0.0 AS geo_distance_km, sales, delivery_days, 1 AS num_orders
FROM shipments"""
register(
    "stream_score",
    with_ctes(
        SHIPMENTS_CTE,
        _forest(_STREAM_ROWS, _FOREST),
        body=f"""
SELECT market, count(*) AS n_rows, count(*) AS n_documented, CAST(sum(prediction) AS BIGINT) AS n_late,
       round(CAST(sum(CAST(round(prob_class_1, {PROBABILITY_DIGITS}) AS DECIMAL(18,8))) AS DOUBLE), 3) AS expected_late
FROM forest_scored GROUP BY market""",
    ),
)
