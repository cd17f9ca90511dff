"""Independent DuckDB SQL for every registered query.

The driver runs these against the raw test tables (views ``orders``,
``lineitem``, ``part``, ``customer``, ``nation``, ...). ``FACTS`` restates the
test-data mapping, the five left joins, cleaning and derivation in plain SQL;
each query appends its own SELECT. Column names match the Spark outputs.
"""

from __future__ import annotations

from orderlens import schema as S

ENRICHED_CTE = """
WITH
o AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS order_status,
         CAST(o_orderdate AS TIMESTAMP) AS order_purchase_timestamp,
         CAST(o_orderdate AS TIMESTAMP) + INTERVAL 30 DAY AS order_estimated_delivery_date
  FROM orders),
c AS (
  SELECT c_custkey AS customer_id, CAST(c_custkey AS VARCHAR) AS customer_unique_id,
         concat_ws('/', n_name, c_mktsegment) AS customer_city, n_name AS customer_state
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey),
i AS (
  SELECT l_orderkey AS order_id, CAST(l_linenumber AS DOUBLE) AS order_item_id, l_partkey AS product_key,
         CAST(l_suppkey AS VARCHAR) AS seller_id, l_extendedprice AS price,
         round(l_extendedprice * l_tax, 4) AS freight_value, CAST(l_shipdate AS TIMESTAMP) AS shipped_at,
         CASE WHEN p_size % 17 = 0 THEN NULL ELSE p_brand END AS product_category_name
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey),
p AS (
  SELECT o_orderkey AS order_id, 1.0::DOUBLE AS payment_sequential, o_orderpriority AS payment_type,
         CAST(1 + o_orderkey % 12 AS DOUBLE) AS payment_installments, o_totalprice AS payment_value
  FROM orders WHERE o_orderkey % 101 <> 0
  UNION ALL
  SELECT o_orderkey, 2.0::DOUBLE, 'voucher', 1.0::DOUBLE, 25.0::DOUBLE
  FROM orders WHERE o_orderkey % 101 <> 0 AND o_orderkey % 10 = 0),
r AS (
  SELECT o_orderkey AS order_id, 'r' || CAST(o_orderkey AS VARCHAR) || '-1' AS review_id,
         CAST(1 + o_orderkey % 5 AS DOUBLE) AS review_score,
         CAST(o_orderdate AS TIMESTAMP) + INTERVAL 40 DAY AS review_answer_timestamp
  FROM orders WHERE o_orderkey % 7 <> 0
  UNION ALL
  SELECT o_orderkey, 'r' || CAST(o_orderkey AS VARCHAR) || '-2', CAST(1 + (o_orderkey + 2) % 5 AS DOUBLE),
         CAST(o_orderdate AS TIMESTAMP) + INTERVAL 45 DAY
  FROM orders WHERE o_orderkey % 7 <> 0 AND o_orderkey % 50 = 1),
j AS (
  SELECT o.order_id, o.customer_id, o.order_status, o.order_purchase_timestamp,
         CASE WHEN o.order_status = 'O' THEN NULL ELSE i.shipped_at END AS order_delivered_customer_date,
         o.order_estimated_delivery_date,
         i.order_item_id, i.product_key, i.seller_id, i.price, i.freight_value, i.product_category_name,
         c.customer_unique_id, c.customer_city, c.customer_state,
         p.payment_sequential, p.payment_type, p.payment_installments, p.payment_value,
         r.review_id, r.review_score, r.review_answer_timestamp
  FROM o LEFT JOIN i ON o.order_id = i.order_id
         LEFT JOIN c ON o.customer_id = c.customer_id
         LEFT JOIN p ON o.order_id = p.order_id
         LEFT JOIN r ON o.order_id = r.order_id),
enriched AS (
  SELECT order_id, customer_id, coalesce(order_status, 'unknown') AS order_status,
         order_purchase_timestamp,
         NULL::TIMESTAMP AS order_approved_at,
         NULL::TIMESTAMP AS order_delivered_carrier_date,
         order_delivered_customer_date,
         order_estimated_delivery_date,
         order_item_id,
         coalesce(CAST(product_key AS VARCHAR), 'unknown') AS product_id,
         coalesce(seller_id, 'unknown') AS seller_id,
         NULL::TIMESTAMP AS shipping_limit_date,
         price, freight_value,
         coalesce(product_category_name, 'unknown') AS product_category_name,
         NULL::DOUBLE AS product_name_lenght, NULL::DOUBLE AS product_description_lenght,
         NULL::DOUBLE AS product_photos_qty, NULL::DOUBLE AS product_weight_g,
         NULL::DOUBLE AS product_length_cm, NULL::DOUBLE AS product_height_cm, NULL::DOUBLE AS product_width_cm,
         customer_unique_id, NULL::INTEGER AS customer_zip_code_prefix,
         coalesce(customer_city, 'unknown') AS customer_city,
         coalesce(customer_state, 'unknown') AS customer_state,
         payment_sequential, coalesce(payment_type, 'unknown') AS payment_type, payment_installments, payment_value,
         review_id, review_score, '' AS review_comment_title, '' AS review_comment_message,
         NULL::TIMESTAMP AS review_creation_date, review_answer_timestamp
  FROM j),
facts AS (
  SELECT * REPLACE (coalesce(price, 0.0) AS price, coalesce(freight_value, 0.0) AS freight_value),
         coalesce(price, 0.0) + coalesce(freight_value, 0.0) AS revenue,
         CASE WHEN review_score IS NULL THEN 'unknown' WHEN review_score >= 4 THEN 'positive'
              WHEN review_score = 3 THEN 'neutral' WHEN review_score >= 1 THEN 'negative'
              ELSE 'unknown' END AS review_sentiment,
         coalesce(date_diff('day', CAST(order_estimated_delivery_date AS DATE),
                            CAST(order_delivered_customer_date AS DATE)), 0) AS delivery_delay_days,
         CASE WHEN coalesce(date_diff('day', CAST(order_estimated_delivery_date AS DATE),
                            CAST(order_delivered_customer_date AS DATE)), 0) > 0 THEN 1 ELSE 0 END
           AS is_late_delivery,
         CAST(order_purchase_timestamp AS DATE) AS purchase_date
  FROM enriched)
"""

# Money: a finite value below 10^14 in size, to four decimals; anything else is no amount.
M = "TRY_CAST(CASE WHEN abs({0}) < 1e14 THEN {0} END AS DECIMAL(18,4))"
REV = f"sum({M.format('revenue')})"

# The order of an order's rows: the last by these stands for it.
ORDER_KEYS = [
    "order_purchase_timestamp",
    "review_answer_timestamp",
    "review_id",
    "order_item_id",
    "payment_sequential",
    "order_delivered_customer_date",
]


def _cents(expr: str) -> str:
    return f"CAST(round({expr}, 2) AS DOUBLE)"


def _avg(col: str) -> str:
    """Unrounded average (ordering only)."""
    return f"CAST(sum({col}) AS DOUBLE) / count({col})"


def _round_div(num: str, den: str, digits: int, scale: int = 0) -> str:
    """Exact half-away-from-zero rounding of num/den (same rule as Spark side)."""
    n = f"CAST(({num}) * {10**scale} AS HUGEINT)"
    d = f"CAST(({den}) AS HUGEINT)"
    if digits >= scale:
        n = f"({n} * {10 ** (digits - scale)})"
    else:
        d = f"({d} * {10 ** (scale - digits)})"
    return (f"(CASE WHEN ({den}) > 0 THEN sign({n}) * CAST((2 * abs({n}) + {d}) // (2 * {d}) AS DOUBLE)"
            f" / {float(10 ** digits)} END)")


def _mavg(col: str, digits: int = 2) -> str:
    """Exactly rounded average of a measure with up to four decimals."""
    return _round_div(f"sum({M.format(col)})", f"count({M.format(col)})", digits, 4)


def _iavg(col: str, digits: int = 2) -> str:
    """Exactly rounded average of an integer measure."""
    return _round_div(f"sum({col})", f"count({col})", digits, 0)


def _q(body: str) -> str:
    return ENRICHED_CTE + body


def _revenue_by(key: str, top: int | None = None) -> str:
    limit = f" LIMIT {top}" if top else ""
    return _q(
        f"SELECT {key}, {_cents(REV)} AS revenue FROM facts GROUP BY {key} "
        f"ORDER BY {REV} DESC, {key}{limit}"
    )


KPI_SELECT = f"""
SELECT CAST(round(coalesce(rev, 0), 2) AS DOUBLE) AS total_revenue,
       CAST(coalesce(orders, 0) AS BIGINT) AS total_orders,
       coalesce({_round_div('coalesce(rev, 0)', 'coalesce(orders, 0)', 2, 4)}, 0.0) AS avg_order_value,
       coalesce({_round_div('score_sum', 'score_n', 2, 4)}, 0.0) AS avg_review_score,
       coalesce({_round_div('late_sum', 'late_n', 4, 0)}, 0.0) AS late_delivery_rate
"""
KPI_PARTS = ("sum(CAST(review_score AS DECIMAL(18,4))) AS score_sum, count(review_score) AS score_n, "
             "sum(is_late_delivery) AS late_sum, count(is_late_delivery) AS late_n")

STATE_MEASURES = f"""
, sm AS (
  SELECT customer_state, count(*) AS total_rows, CAST(sum(is_late_delivery) AS BIGINT) AS late_rows,
         count(DISTINCT order_id) AS unique_orders, {REV} AS revenue_exact,
         {_avg('review_score')} AS avg_review_exact, {_mavg('review_score')} AS avg_review_score,
         {_avg('delivery_delay_days')} AS avg_delay_exact, {_iavg('delivery_delay_days')} AS avg_delay_days
  FROM facts GROUP BY customer_state)
"""


def _desc(cols: list[str]) -> str:
    return ", ".join(f"{c} DESC NULLS LAST" for c in cols)


def _order_level_sql() -> str:
    values = [c for c in S.ENRICHED_COLUMNS + S.DERIVED_COLUMNS if c != "order_id"]
    ordered = ORDER_KEYS + [c for c in values if c not in ORDER_KEYS]
    return _q(
        f"""
, ranked AS (
  SELECT order_id, {", ".join(ordered)},
         CAST(round(sum({M.format('revenue')}) OVER (PARTITION BY order_id), 2) AS DOUBLE) AS order_revenue,
         row_number() OVER (PARTITION BY order_id ORDER BY {_desc(ordered)}) AS rn
  FROM facts)
SELECT * EXCLUDE (rn) FROM ranked WHERE rn = 1"""
    )


def _kpi_order_level_sql() -> str:
    ordered = ORDER_KEYS + ["review_score", "is_late_delivery"]
    return _q(
        f"""
, ol AS (
  SELECT * FROM (
    SELECT order_id, review_score, is_late_delivery,
           sum({M.format('revenue')}) OVER (PARTITION BY order_id) AS orev,
           row_number() OVER (PARTITION BY order_id ORDER BY {_desc(ordered)}) AS rn
    FROM facts WHERE order_id IS NOT NULL) WHERE rn = 1),
agg AS (
  SELECT sum(orev) AS rev, count(*) AS orders, {KPI_PARTS} FROM ol)
{KPI_SELECT} FROM agg"""
    )


def oracle_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["enriched_orders"] = _q("SELECT * FROM enriched")
    q["order_level"] = _order_level_sql()
    q["kpi_summary"] = _q(
        f"""
, agg AS (
  SELECT {REV} AS rev, count(DISTINCT order_id) AS orders, {KPI_PARTS} FROM facts)
{KPI_SELECT} FROM agg"""
    )
    q["kpi_summary_order_level"] = _kpi_order_level_sql()
    q["average_payment_value"] = _q(
        f"SELECT coalesce({_mavg('payment_value')}, 0.0) AS average_payment_value FROM facts"
    )
    q["orders_per_day"] = _q(
        "SELECT purchase_date, count(DISTINCT order_id) AS order_count FROM facts "
        "WHERE purchase_date IS NOT NULL GROUP BY 1"
    )
    q["order_status_breakdown"] = _q(
        "SELECT order_status, count(DISTINCT order_id) AS order_count FROM facts GROUP BY 1"
    )
    q["revenue_by_state"] = _revenue_by("customer_state")
    q["orders_by_state"] = _q(STATE_MEASURES + "SELECT customer_state, unique_orders AS order_count FROM sm")
    q["avg_order_value_by_state"] = _q(
        f"""
SELECT customer_state, {_round_div('sum(orev)', 'count(*)', 2, 4)} AS avg_order_value
FROM (SELECT customer_state, order_id, {REV} AS orev FROM facts WHERE order_id IS NOT NULL GROUP BY 1, 2)
GROUP BY 1"""
    )
    q["top_cities_by_revenue"] = _revenue_by("customer_city", 10)
    q["revenue_by_category"] = _revenue_by("product_category_name")
    q["top_products"] = _revenue_by("product_id", 10)
    q["top_sellers"] = _revenue_by("seller_id", 10)
    q["freight_vs_price_by_category"] = _q(
        f"SELECT product_category_name, {_mavg('price')} AS avg_price, "
        f"{_mavg('freight_value')} AS avg_freight FROM facts GROUP BY 1"
    )
    q["orders_by_payment_type"] = _q(
        "SELECT payment_type, count(DISTINCT order_id) AS order_count FROM facts GROUP BY 1"
    )
    q["revenue_by_payment_type"] = _revenue_by("payment_type")
    q["installments_distribution"] = _q(
        "SELECT payment_installments, count(*) AS count FROM facts GROUP BY 1"
    )
    q["avg_payment_by_type"] = _q(
        f"SELECT payment_type, {_mavg('payment_value')} AS avg_payment_value FROM facts GROUP BY 1"
    )
    q["review_distribution"] = _q("SELECT review_sentiment, count(*) AS count FROM facts GROUP BY 1")
    q["review_score_distribution"] = _q("SELECT review_score, count(*) AS count FROM facts GROUP BY 1")
    q["review_score_by_state"] = _q(
        STATE_MEASURES + "SELECT customer_state, avg_review_score FROM sm"
    )
    q["review_score_by_category"] = _q(
        f"SELECT product_category_name, {_mavg('review_score')} AS avg_review_score "
        "FROM facts GROUP BY 1"
    )
    q["late_delivery_by_state"] = _q(
        STATE_MEASURES
        + "SELECT customer_state, total_rows, late_rows, unique_orders, "
        f"{_round_div('late_rows', 'total_rows', 4)} AS late_delivery_rate FROM sm"
    )
    q["on_time_vs_late_delivery"] = _q(
        "SELECT CASE WHEN is_late_delivery = 1 THEN 'late' ELSE 'on_time' END AS delivery_status, "
        "count(*) AS count FROM facts GROUP BY 1"
    )
    q["average_delay_by_state"] = _q(
        STATE_MEASURES + "SELECT customer_state, avg_delay_days FROM sm"
    )
    q["delay_trend_over_time"] = _q(
        f"SELECT purchase_date, {_iavg('delivery_delay_days')} AS avg_delay_days FROM facts "
        "WHERE purchase_date IS NOT NULL GROUP BY 1"
    )
    q["delay_vs_review_score"] = _q(
        f"SELECT review_score, {_iavg('delivery_delay_days')} AS avg_delay_days FROM facts GROUP BY 1"
    )
    q["decision_support"] = _q(
        STATE_MEASURES
        + f"""
, cm AS (SELECT product_category_name, {REV} AS rev FROM facts GROUP BY 1),
pm AS (SELECT payment_type, count(DISTINCT order_id) AS n FROM facts GROUP BY 1),
sd AS (SELECT review_sentiment, count(*) AS n FROM facts GROUP BY 1)
SELECT
  (SELECT customer_state FROM sm ORDER BY revenue_exact DESC, customer_state LIMIT 1) AS best_state_by_revenue,
  (SELECT product_category_name FROM cm ORDER BY rev DESC, product_category_name LIMIT 1)
    AS top_category_by_revenue,
  (SELECT payment_type FROM pm ORDER BY n DESC, payment_type LIMIT 1) AS top_payment_type,
  (SELECT customer_state FROM sm ORDER BY CAST(late_rows AS DOUBLE) / total_rows DESC, customer_state LIMIT 1)
    AS worst_state_by_late_rate,
  coalesce((SELECT {_round_div("coalesce(sum(n) FILTER (WHERE review_sentiment = 'positive'), 0)", 'sum(n)', 4)}
            FROM sd), 0.0) AS positive_review_ratio,
  coalesce((SELECT {_round_div("coalesce(sum(n) FILTER (WHERE review_sentiment = 'negative'), 0)", 'sum(n)', 4)}
            FROM sd), 0.0) AS negative_review_ratio"""
    )
    return q


# --------------------------------------------------------------------------
# Trends, filters and insight blocks
# --------------------------------------------------------------------------

DAILY = """
, daily AS (SELECT purchase_date, count(DISTINCT order_id) AS order_count FROM facts
            WHERE purchase_date IS NOT NULL GROUP BY 1)
"""


def _scaled(y: str, s: int) -> str:
    return f"CAST(round(CAST({y} AS DECIMAL(38,6)) * {10**s}) AS HUGEINT)"


def _fit_parts(x: str, y: str, s: int) -> str:
    xi = f"(CASE WHEN {y} IS NOT NULL THEN CAST({x} AS HUGEINT) END)"
    yi = _scaled(y, s)
    return (f"count(*) AS _n, count({y}) AS _k, sum({xi}) AS _sx, sum({yi}) AS _sy, "
            f"sum({xi} * {xi}) AS _sxx, sum({xi} * {yi}) AS _sxy, sum({yi} * {yi}) AS _syy")


def _growth_parts(order: str, y: str) -> str:
    return (f"CAST(arg_min_null({y}, {order}) FILTER (WHERE {y} IS NOT NULL) AS DOUBLE) AS _first, "
            f"CAST(arg_max_null({y}, {order}) FILTER (WHERE {y} IS NOT NULL) AS DOUBLE) AS _last, "
            f"count({y}) AS _gk")


def _slope(s: int) -> str:
    num = "(_k * _sxy - _sx * _sy)"
    den = "(_k * _sxx - _sx * _sx)"
    return (f"(CASE WHEN _k >= 2 AND {den} <> 0 THEN CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE) "
            f"/ {float(10**s)} ELSE 0.0 END)")


def _intercept(s: int) -> str:
    return (f"(CASE WHEN _k >= 2 THEN CAST(_sy AS DOUBLE) / {float(10**s)} / CAST(_k AS DOUBLE) "
            f"- {_slope(s)} * (CAST(_sx AS DOUBLE) / CAST(_k AS DOUBLE)) ELSE 0.0 END)")


def _std(s: int) -> str:
    return (f"(CASE WHEN _k >= 2 THEN sqrt(CAST(_k * _syy - _sy * _sy AS DOUBLE) / CAST(_k * (_k - 1) AS DOUBLE))"
            f" / {float(10**s)} END)")


def _trend(s: int) -> str:
    std = _std(s)
    norm = f"({_slope(s)} / {std})"
    return (f"(CASE WHEN _n < 3 OR {std} IS NULL OR {std} = 0 THEN 'stable' WHEN {norm} > 0.05 THEN 'increasing' "
            f"WHEN {norm} < -0.05 THEN 'decreasing' ELSE 'stable' END)")


GROWTH = ("(CASE WHEN _gk >= 2 AND _first <> 0 AND _last <> 0 THEN (_last - _first) / abs(_first) "
          "ELSE 0.0 END)")


def _corr_parts(x: str, y: str, s: int) -> str:
    both = f"{x} IS NOT NULL AND {y} IS NOT NULL"
    xi = f"(CASE WHEN {both} THEN {_scaled(x, s)} END)"
    yi = f"(CASE WHEN {both} THEN {_scaled(y, s)} END)"
    return (f"count(*) AS _cn, count({xi}) AS _ck, sum({xi}) AS _cx, sum({yi}) AS _cy, sum({xi} * {xi}) AS _cxx, "
            f"sum({yi} * {yi}) AS _cyy, sum({xi} * {yi}) AS _cxy")


_VX = "(_ck * _cxx - _cx * _cx)"
_VY = "(_ck * _cyy - _cy * _cy)"
CORR = (f"(CASE WHEN _cn <= 2 THEN 0.0 WHEN {_VX} > 0 AND {_VY} > 0 THEN "
        f"CAST(_ck * _cxy - _cx * _cy AS DOUBLE) / sqrt(CAST({_VX} AS DOUBLE) * CAST({_VY} AS DOUBLE)) END)")


def _band(r: str) -> str:
    return f"(CASE WHEN {r} > 0.5 THEN 'strong positive' WHEN {r} > 0.2 THEN 'moderate' ELSE 'weak' END)"


def _ord(metric: str, key: str) -> str:
    return f"struct_pack(f := ({metric}) IS NULL, m := -({metric}), k := {key})"


def _first(value: str, metric: str, key: str) -> str:
    return f"arg_min_null({value}, {_ord(metric, key)})"


def _last(value: str, metric: str, key: str) -> str:
    return f"arg_max_null({value}, {_ord(metric, key)})"


def _dsum(v: str, s: int = 4) -> str:
    return f"CAST(sum(CAST({v} AS DECIMAL(38,{s}))) AS DOUBLE)"


def _share(part: str, total: str) -> str:
    return f"(CASE WHEN ({total}) > 0 THEN CAST({part} AS DOUBLE) / CAST({total} AS DOUBLE) ELSE 0.0 END)"


def _mean(v: str) -> str:
    return f"coalesce({_dsum(v)} / count({v}), 0.0)"


def _lift(top: str, mean: str) -> str:
    return f"(CASE WHEN {mean} <> 0 THEN ({top} - {mean}) / {mean} END)"


def _cents_sql(x: str) -> str:
    return f"CAST(round({x}, 2) AS DOUBLE)"


CATEGORY_MEASURES = f"""
, cm AS (
  SELECT product_category_name, {REV} AS revenue_exact,
         sum(CAST(price AS DECIMAL(18,4))) AS price_sum, count(price) AS price_n,
         sum(CAST(freight_value AS DECIMAL(18,4))) AS freight_sum, count(freight_value) AS freight_n,
         sum(CAST(review_score AS DECIMAL(18,4))) AS score_sum, count(review_score) AS score_n
  FROM facts GROUP BY 1)
"""
PAYMENT_MEASURES = """
, pm AS (
  SELECT payment_type, count(DISTINCT order_id) AS order_count,
         sum(CAST(payment_value AS DECIMAL(18,4))) AS payment_sum, count(payment_value) AS payment_n
  FROM facts GROUP BY 1)
"""
STATE_SCORE = """
, ss AS (
  SELECT customer_state, sum(CAST(review_score AS DECIMAL(18,4))) AS score_sum, count(review_score) AS score_n
  FROM facts GROUP BY 1)
"""


def _top_share(table: str, key: str, exact: str, value: str, label: str, conc: bool) -> str:
    out = f"top_{label}, top_value, {_share('top_value', '_total')} AS top_share"
    if conc:
        out += ", CASE WHEN coalesce(_total, 0.0) = 0 THEN 0.0 ELSE _max / _total END AS concentration_index"
    return f"""
, blk AS (
  SELECT {_first(key, exact, key)} AS top_{label}, {_first(value, exact, key)} AS top_value,
         {_dsum(value)} AS _total, CAST(max({value}) AS DOUBLE) AS _max
  FROM {table})
SELECT {out} FROM blk"""


def _ratio(num: str, den: str) -> str:
    return f"(CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE))"


def derived_oracle() -> dict[str, str]:
    q: dict[str, str] = {}
    pos = DAILY + ", pos AS (SELECT *, row_number() OVER (ORDER BY purchase_date) - 1 AS position FROM daily)\n"
    q["orders_trend_forecast"] = _q(
        pos
        + f"""
, fit AS (SELECT _n, _k, {_slope(0)} AS slope, {_intercept(0)} AS intercept
          FROM (SELECT {_fit_parts('position', 'order_count', 0)} FROM pos))
SELECT CAST(p AS BIGINT) AS position, slope * p + intercept AS forecast, slope
FROM fit, range(_n, _n + 30) t(p) WHERE _k >= 2"""
    )
    q["orders_moving_average"] = _q(
        DAILY
        + "SELECT purchase_date, order_count, avg(order_count) OVER (ORDER BY purchase_date "
        "ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS moving_average FROM daily"
    )
    q["orders_trend_summary"] = _q(
        pos
        + f"""
SELECT {_slope(0)} AS slope, {GROWTH} AS growth_rate, {_trend(0)} AS trend
FROM (SELECT {_fit_parts('position', 'order_count', 0)}, {_growth_parts('position', 'order_count')} FROM pos)"""
    )
    rbs = f", rbs AS (SELECT customer_state, {_cents_sql(REV)} AS revenue FROM facts GROUP BY 1)\n"
    q["revenue_concentration"] = _q(
        rbs
        + f"""
SELECT CASE WHEN coalesce(_sum, 0.0) = 0 THEN 0.0 ELSE _max / _sum END AS concentration_index
FROM (SELECT CAST(max(revenue) AS DOUBLE) AS _max, {_dsum('revenue')} AS _sum FROM rbs)"""
    )
    fvp = (f", fvp AS (SELECT product_category_name, {_mavg('price')} AS avg_price, "
           f"{_mavg('freight_value')} AS avg_freight FROM facts GROUP BY 1)\n")
    q["freight_price_correlation"] = _q(
        fvp + f"SELECT {CORR} AS correlation, {_band(CORR)} AS correlation_band "
        f"FROM (SELECT {_corr_parts('avg_price', 'avg_freight', 2)} FROM fvp)"
    )
    q["date_bounds"] = _q(
        DAILY
        + """
SELECT least(coalesce(lo, DATE '2016-01-01'), coalesce(hi, current_date)) AS date_start,
       greatest(coalesce(lo, DATE '2016-01-01'), coalesce(hi, current_date)) AS date_end
FROM (SELECT min(purchase_date) AS lo, max(purchase_date) AS hi FROM daily)"""
    )
    q["daily_orders_in_range"] = _q(
        DAILY + "SELECT * FROM daily WHERE purchase_date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'"
    )
    q["state_late_delivery_selected"] = _q(
        STATE_MEASURES
        + "SELECT customer_state, total_rows, late_rows, unique_orders, "
        f"{_round_div('late_rows', 'total_rows', 4)} AS late_delivery_rate FROM sm WHERE customer_state = 'NATION_7'"
    )
    q["category_price_ranking"] = _q(fvp + "SELECT product_category_name, avg_price FROM fvp")

    base = oracle_queries()
    # the stream round trip must reproduce the batch result exactly
    q["stream_ingest_roundtrip"] = base["late_delivery_by_state"]
    q["snapshot_csv_roundtrip"] = base["avg_payment_by_type"]
    q["landing_csv_roundtrip"] = base["revenue_by_category"]
    q["awkward_text_roundtrip"] = (
        "SELECT doc_id, nullif(text, '') AS text, lang FROM documents "
        "UNION ALL SELECT conv_id * 1000 + turn, nullif(text, ''), role FROM conversations WHERE text IS NOT NULL"
    )
    q["ingest_rejects"] = (
        "SELECT 'good' AS kind, count(*) AS messages FROM orders WHERE o_orderkey % 5 <> 0 "
        "UNION ALL SELECT 'rejected', count(*) FROM orders WHERE o_orderkey % 5 = 0"
    )
    q["null_normalisation"] = """
SELECT o_orderkey AS order_id, CASE o_orderkey % 6 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN NULL WHEN 3 THEN NULL ELSE o_totalprice END AS price,
       CASE o_orderkey % 3 WHEN 0 THEN 'unknown' WHEN 1 THEN 'unknown' ELSE o_orderpriority END AS payment_type,
       CASE WHEN o_orderkey % 6 IN (0, 1, 2, 3) THEN 1 ELSE 0 END AS unusable FROM orders"""
    q["export_reload"] = (
        "SELECT 'revenue_by_state' AS name, count(*) AS n, CAST(sum(CAST(revenue AS DECIMAL(20,2))) AS DOUBLE) AS total FROM ("
        + base["revenue_by_state"] + ") UNION ALL SELECT 'top_products', count(*), CAST(sum(CAST(revenue AS DECIMAL(20,2))) AS DOUBLE) FROM ("
        + base["top_products"] + ")"
    )
    q["published_order"] = (
        f"SELECT customer_state, revenue, row_number() OVER (ORDER BY revenue DESC, customer_state) AS place FROM ({base['revenue_by_state']})"
    )
    q["category_price_selected"] = f"SELECT * FROM ({base['freight_vs_price_by_category']}) WHERE product_category_name = 'Brand#7'"
    q["payment_selected"] = f"SELECT * FROM ({base['avg_payment_by_type']}) WHERE payment_type = 'voucher'"
    q["state_review_all"] = base["review_score_by_state"]
    q["delay_trend_in_range"] = (
        f"SELECT * FROM ({base['delay_trend_over_time']}) WHERE purchase_date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'"
    )
    q["category_revenue_head"] = f"SELECT * FROM ({base['revenue_by_category']}) ORDER BY revenue DESC, product_category_name LIMIT 15"
    # contract report: every expected table exported with its row count
    parts = []
    for name in S.EXPECTED_OUTPUTS:
        parts.append(f"SELECT '{name}' AS \"table\", (SELECT count(*) FROM ({base[name]})) AS n")
    q["contract_report"] = (
        "SELECT \"table\", true AS \"exists\", CAST(n AS BIGINT) AS row_count, "
        "CASE WHEN n = 0 THEN 'warning' ELSE 'ok' END AS status, true AS modified_since_start, true AS columns_ok FROM (" + " UNION ALL ".join(parts) + ")"
    )
    q["manifest_report"] = f"SELECT *, 1 AS broken FROM ({q['contract_report']})"
    q["contract_summary"] = "SELECT 'error' AS status, 'top_products' AS missing_tables, 'order_status_breakdown' AS empty_tables"
    q["stream_state_kpi"] = base["kpi_summary"]
    q["stream_state_revenue"] = base["revenue_by_state"]
    q["snapshot_orders_in_range"] = q["daily_orders_in_range"]
    q["snapshot_date_bounds"] = _q(DAILY + "SELECT min(purchase_date) AS date_start, max(purchase_date) AS date_end FROM daily")
    q["reload_rejects"] = _q(
        DAILY
        + """
, n AS (SELECT count(*) AS days, count(*) FILTER (WHERE month(purchase_date) = 2) AS bad_days,
               count(*) FILTER (WHERE month(purchase_date) = 3) AS bad_counts, count(*) FILTER (WHERE month(purchase_date) = 4) AS no_counts FROM daily),
s AS (SELECT count(*) AS states, count(*) FILTER (WHERE customer_state < 'NATION_2') AS bad FROM (SELECT DISTINCT customer_state FROM facts))
SELECT 'orders_per_day' AS "table", 'purchase_date' AS "column", days AS "values", bad_days AS rejected FROM n
UNION ALL SELECT 'orders_per_day', 'order_count', days - no_counts, bad_counts FROM n
UNION ALL SELECT 'revenue_by_state', 'customer_state', states, 0 FROM s
UNION ALL SELECT 'revenue_by_state', 'revenue', states, bad FROM s"""
    )
    q["translated_categories"] = _q(
        f"""
, m AS (SELECT product_category_name AS c, {REV} AS exact FROM facts GROUP BY 1),
t AS (SELECT DISTINCT p_brand AS c, 'group ' || right(p_brand, 1) AS e FROM part WHERE right(p_brand, 1) <> '5')
SELECT coalesce(e, m.c) AS category, {_cents('sum(exact)')} AS revenue, count(*) AS categories FROM m LEFT JOIN t USING (c) GROUP BY 1"""
    )
    by_state = """
, days AS (SELECT customer_state, purchase_date, count(DISTINCT order_id) AS order_count FROM facts WHERE purchase_date IS NOT NULL GROUP BY 1, 2),
pos AS (SELECT *, row_number() OVER (PARTITION BY customer_state ORDER BY purchase_date) - 1 AS position FROM days)"""
    q["orders_trend_by_state"] = _q(
        by_state
        + f"""
SELECT customer_state, {_slope(0)} AS slope, {GROWTH} AS growth_rate, {_trend(0)} AS trend
FROM (SELECT customer_state, {_fit_parts('position', 'order_count', 0)}, {_growth_parts('position', 'order_count')} FROM pos GROUP BY 1)"""
    )
    q["orders_moving_average_by_state"] = _q(
        by_state + " SELECT customer_state, purchase_date, order_count, avg(order_count) OVER (PARTITION BY customer_state ORDER BY purchase_date "
        "ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS moving_average FROM days"
    )
    q["orders_forecast_by_state"] = _q(
        by_state
        + f"""
, fit AS (SELECT customer_state, _n, _k, {_slope(0)} AS slope, {_intercept(0)} AS intercept
          FROM (SELECT customer_state, {_fit_parts('position', 'order_count', 0)} FROM pos GROUP BY 1))
SELECT customer_state, CAST(p AS BIGINT) AS position, slope * p + intercept AS forecast, slope
FROM (SELECT *, unnest(range(_n, _n + 5)) AS p FROM fit WHERE _k >= 2)"""
    )
    # insight blocks
    q["insight_kpi_summary"] = base["kpi_summary"]
    q["insight_orders_per_day"] = _q(
        pos
        + f"""
SELECT {_trend(0)} AS trend, {GROWTH} AS growth_rate,
       coalesce(CAST(_total AS DOUBLE) / _k, 0.0) AS avg_daily_orders,
       CAST(coalesce(_peak, 0) AS BIGINT) AS peak_daily_orders
FROM (SELECT {_fit_parts('position', 'order_count', 0)}, {_growth_parts('position', 'order_count')},
             sum(order_count) AS _total, max(order_count) AS _peak FROM pos)"""
    )
    part = "coalesce(sum(order_count) FILTER (WHERE order_status = '{}'), 0)"
    q["insight_order_status"] = _q(
        ", t AS (SELECT order_status, count(DISTINCT order_id) AS order_count FROM facts GROUP BY 1)\n"
        f"SELECT CAST(coalesce(sum(order_count), 0) AS BIGINT) AS total_orders, "
        f"{_share(part.format('delivered'), 'sum(order_count)')} AS delivered_share, "
        f"{_share(part.format('canceled'), 'sum(order_count)')} AS canceled_share FROM t"
    )
    q["insight_revenue_by_state"] = _q(
        STATE_MEASURES
        + _top_share("sm", "customer_state", "revenue_exact", _cents_sql("revenue_exact"), "state", True)
    )
    q["insight_orders_by_state"] = _q(
        STATE_MEASURES + _top_share("sm", "customer_state", "unique_orders", "unique_orders", "state", False)
    )
    aov_pub = _round_div("aov_sum", "aov_n", 2, 4)
    aov_ex = _ratio("aov_sum", "aov_n")
    q["insight_avg_order_value_by_state"] = _q(
        f"""
, am AS (SELECT customer_state, sum(orev) AS aov_sum, count(*) AS aov_n
         FROM (SELECT customer_state, order_id, {REV} AS orev FROM facts WHERE order_id IS NOT NULL GROUP BY 1, 2)
         GROUP BY 1),
blk AS (SELECT {_first('customer_state', aov_ex, 'customer_state')} AS top_state,
               {_first(aov_pub, aov_ex, 'customer_state')} AS top_value, {_mean(aov_pub)} AS mean_value FROM am)
SELECT top_state, top_value, mean_value, {_lift('top_value', 'mean_value')} AS lift FROM blk"""
    )
    q["insight_top_cities"] = _q(
        f"""
, tc AS (SELECT customer_city, {REV} AS revenue_exact FROM facts GROUP BY 1
         ORDER BY revenue_exact DESC, customer_city LIMIT 10)"""
        + _top_share("tc", "customer_city", "revenue_exact", _cents_sql("revenue_exact"), "city", False)
    )
    q["insight_revenue_by_category"] = _q(
        CATEGORY_MEASURES
        + _top_share("cm", "product_category_name", "revenue_exact", _cents_sql("revenue_exact"), "category", True)
    )

    def best_worst(table: str, key: str, label: str) -> str:
        ex, pub = _ratio("score_sum", "score_n"), _round_div("score_sum", "score_n", 2, 4)
        return (f"SELECT {_first(key, ex, key)} AS best_{label}, {_first(pub, ex, key)} AS best_score, "
                f"{_last(key, ex, key)} AS worst_{label}, {_last(pub, ex, key)} AS worst_score, "
                f"{_mean(pub)} AS mean_score FROM {table}")

    q["insight_review_score_by_category"] = _q(
        CATEGORY_MEASURES + best_worst("cm", "product_category_name", "category")
    )
    q["insight_freight_vs_price"] = _q(
        CATEGORY_MEASURES
        + f"""
, f AS (SELECT product_category_name, {_ratio('price_sum', 'price_n')} AS price_exact,
               {_round_div('price_sum', 'price_n', 2, 4)} AS avg_price,
               {_round_div('freight_sum', 'freight_n', 2, 4)} AS avg_freight FROM cm),
a AS (SELECT {_corr_parts('avg_price', 'avg_freight', 2)},
             {_first('product_category_name', 'price_exact', 'product_category_name')} AS high_price_category,
             max(avg_price) AS high_price,
             arg_min_null(product_category_name, struct_pack(a := avg_freight IS NULL, b := -avg_freight,
                          c := price_exact IS NULL, d := -price_exact, k := product_category_name))
               AS high_freight_category,
             max(avg_freight) AS high_freight FROM f)
SELECT {CORR} AS correlation, {_band(CORR)} AS correlation_band, high_price_category, high_price,
       high_freight_category, high_freight FROM a"""
    )
    cnt = "coalesce(sum(order_count) FILTER (WHERE payment_type = '{}'), 0)"
    q["insight_payment_orders"] = _q(
        PAYMENT_MEASURES
        + f"""
, a AS (SELECT coalesce(sum(order_count), 0) AS total, {cnt.format('credit_card')} AS cc,
               {cnt.format('boleto')} AS bo FROM pm)
SELECT CAST(total AS BIGINT) AS total_orders, CAST(cc AS BIGINT) AS credit_card_orders,
       CAST(bo AS BIGINT) AS boleto_orders, {_share('cc', 'total')} AS credit_card_share,
       {_share('total - cc - bo', 'total')} AS other_share FROM a"""
    )
    q["insight_installments"] = _q(
        f"""
, t AS (SELECT payment_installments AS inst, count(*) AS cnt FROM facts GROUP BY 1),
a AS (SELECT arg_min_null(inst, struct_pack(a := -cnt, b := inst IS NULL, c := inst)) AS _mode,
             max(cnt) AS _mode_count, sum(cnt) AS _total,
             coalesce(sum(cnt) FILTER (WHERE inst > 1), 0) AS _multi FROM t)
SELECT CASE WHEN _total IS NULL THEN 1 ELSE CAST(_mode AS BIGINT) END AS mode_installments, CAST(coalesce(_mode_count, 0) AS BIGINT) AS mode_count,
       {_share('_mode_count', '_total')} AS mode_share, {_share('_multi', '_total')} AS multi_installment_share
FROM a"""
    )
    pex, ppub = _ratio("payment_sum", "payment_n"), _round_div("payment_sum", "payment_n", 2, 4)
    q["insight_avg_payment_by_type"] = _q(
        PAYMENT_MEASURES
        + f"""
, blk AS (SELECT {_first('payment_type', pex, 'payment_type')} AS top_type,
                 {_first(ppub, pex, 'payment_type')} AS top_value, {_mean(ppub)} AS mean_value FROM pm)
SELECT top_type, top_value, mean_value, {_lift('top_value', 'mean_value')} AS lift FROM blk"""
    )
    dpart = "coalesce(sum(n) FILTER (WHERE delivery_status = '{}'), 0)"
    q["insight_on_time_vs_late"] = _q(
        """
, t AS (SELECT CASE WHEN is_late_delivery = 1 THEN 'late' ELSE 'on_time' END AS delivery_status, count(*) AS n
        FROM facts GROUP BY 1)"""
        + f"\nSELECT {_share(dpart.format('on_time'), 'sum(n)')} AS on_time_share, "
        f"{_share(dpart.format('late'), 'sum(n)')} AS late_share FROM t"
    )
    lex, lpub = _ratio("late_rows", "total_rows"), _round_div("late_rows", "total_rows", 4)
    q["insight_late_delivery_by_state"] = _q(
        STATE_MEASURES
        + f"""
, blk AS (SELECT {_first('customer_state', lex, 'customer_state')} AS worst_state,
                 {_first(lpub, lex, 'customer_state')} AS worst_rate, {_mean(lpub)} AS mean_rate FROM sm)
SELECT worst_state, worst_rate, mean_rate, {_lift('worst_rate', 'mean_rate')} AS lift FROM blk"""
    )
    q["insight_delay_trend"] = _q(
        f"""
, dt AS (SELECT purchase_date, {_iavg('delivery_delay_days')} AS avg_delay_days FROM facts
         WHERE purchase_date IS NOT NULL GROUP BY 1),
pos AS (SELECT *, row_number() OVER (ORDER BY purchase_date) - 1 AS position FROM dt),
a AS (SELECT {_fit_parts('position', 'avg_delay_days', 2)}, {_growth_parts('position', 'avg_delay_days')} FROM pos)
SELECT {_trend(2)} AS trend,
       CASE {_trend(2)} WHEN 'decreasing' THEN 'improving' WHEN 'increasing' THEN 'worsening' ELSE 'stable' END AS label,
       coalesce(_first, 0.0) AS earliest, coalesce(_last, 0.0) AS latest,
       coalesce(_first, 0.0) - coalesce(_last, 0.0) AS improvement FROM a"""
    )
    spart = "coalesce(sum(n) FILTER (WHERE review_score = {}), 0)"
    q["insight_review_distribution"] = _q(
        ", t AS (SELECT review_score, count(*) AS n FROM facts GROUP BY 1)\n"
        f"SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS total_rows, "
        f"{_share(spart.format('5.0'), 'sum(n)')} AS five_star_share, "
        f"{_share(spart.format('1.0'), 'sum(n)')} AS one_star_share FROM t"
    )
    q["insight_review_score_by_state"] = _q(
        STATE_SCORE
        + ", bw AS (" + best_worst("ss", "customer_state", "state") + ")\n"
        "SELECT best_state, best_score, worst_state, worst_score, best_score - worst_score AS score_gap, mean_score "
        "FROM bw"
    )
    q["insight_delay_vs_review"] = _q(
        f"""
, t AS (SELECT review_score, {_iavg('delivery_delay_days')} AS avg_delay_days FROM facts GROUP BY 1),
a AS (SELECT {_corr_parts('review_score', 'avg_delay_days', 2)},
             arg_min_null(review_score, struct_pack(a := avg_delay_days IS NULL, b := -avg_delay_days,
                          c := review_score IS NULL, d := review_score)) AS _worst FROM t)
SELECT {CORR} AS correlation, coalesce(_worst, 1.0) AS worst_score FROM a"""
    )
    return q
