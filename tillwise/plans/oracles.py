"""The same results as plain SQL over the parquet tables, for checking."""

from __future__ import annotations

VIEWS = """
v_customers AS (
  SELECT c_custkey AS customer_id, c_custkey AS customer_unique_id, n_name AS customer_state,
         r_name AS customer_city, c_mktsegment AS customer_segment
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
v_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id,
         CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' ELSE 'processing' END AS order_status,
         o_orderdate AS order_purchase_timestamp, CAST(o_orderdate AS DATE) AS order_day,
         CAST(date_trunc('month', o_orderdate) AS DATE) AS order_month,
         CASE WHEN o_orderstatus = 'F' THEN last_ship END AS order_delivered_customer_date
  FROM orders LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS last_ship FROM lineitem GROUP BY 1)
    ON o_orderkey = l_orderkey),
v_items AS (
  SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
         l_suppkey AS seller_id, CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
         CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(12,2)) AS freight_value
  FROM lineitem),
v_pay0 AS (
  SELECT o_orderkey AS order_id, o_orderpriority AS payment_type, 1 + o_orderkey % 10 AS payment_installments,
         CAST(o_totalprice AS DECIMAL(12,2)) AS total,
         CAST(CAST(o_totalprice AS DECIMAL(12,2)) * CAST(0.6 AS DECIMAL(2,1)) AS DECIMAL(12,2)) AS part
  FROM orders),
v_payments AS (
  SELECT order_id, payment_type, payment_installments, 1 AS payment_sequential,
         CASE WHEN order_id % 10 = 0 THEN part ELSE total END AS payment_value FROM v_pay0
  UNION ALL
  SELECT order_id, payment_type, payment_installments, 2, CAST(total - part AS DECIMAL(12,2))
  FROM v_pay0 WHERE order_id % 10 = 0),
v_products AS (
  SELECT p_partkey AS product_id, p_type AS product_category_name, p_brand AS product_brand, p_name AS product_name FROM part),
v_sellers AS (
  SELECT s_suppkey AS seller_id, n_name AS seller_city, r_name AS seller_state,
         (100 + CAST(floor(s_acctbal + 1000.0) AS BIGINT) % 401) / 100.0::DOUBLE AS seller_rating
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
v_reviews AS (
  SELECT o_orderkey AS review_id, o_orderkey AS order_id, CAST(1 + (o_orderkey // 5) % 5 AS INTEGER) AS review_score,
         CAST(CAST(o_orderdate AS DATE) + 10 AS DATE) AS review_creation_date
  FROM orders WHERE o_orderkey % 5 <> 0),
v_texts AS (
  SELECT doc_id AS review_id,
         CASE WHEN toxic = 1 THEN 1 WHEN quality = 1 THEN 5 WHEN quality = 0 THEN 2 END AS review_score,
         text AS review_comment_message, DATE '2024-01-01' + CAST(doc_id % 366 AS INTEGER) AS review_creation_date
  FROM documents LEFT JOIN labels USING (doc_id)),
v_events AS (
  SELECT event_id, ts, user_id AS customer_id, event_type AS category,
         CAST(value AS DECIMAL(12,2)) AS revenue, props FROM events),
v_paid AS (
  SELECT order_id, count(*) AS n_payments, sum(payment_value) AS paid FROM v_payments GROUP BY 1),
v_value AS (
  SELECT order_id, count(*) AS item_count, sum(price) AS revenue, sum(freight_value) AS freight,
         count(DISTINCT product_id) AS unique_products FROM v_items GROUP BY 1),
v_facts AS (
  SELECT o.*, CAST(coalesce(revenue, 0) + coalesce(freight, 0) AS DECIMAL(18,2)) AS total_order_value,
         n_payments, paid, coalesce(n_payments, 1) AS row_multiplicity, r.review_score
  FROM v_orders o LEFT JOIN v_value USING (order_id) LEFT JOIN v_paid USING (order_id)
  LEFT JOIN v_reviews r USING (order_id)),
v_daily AS (
  SELECT order_day AS date, count(*) AS total_orders, sum(paid) AS paid, sum(n_payments) AS pay_rows,
         count(DISTINCT customer_id) AS unique_customers
  FROM v_orders JOIN v_paid USING (order_id) WHERE order_status = 'delivered' GROUP BY 1),
v_series AS (
  SELECT date, CAST(paid AS DOUBLE) AS total_revenue, total_orders,
         CAST(paid AS DOUBLE) / CAST(pay_rows AS DOUBLE) AS avg_order_value
  FROM v_daily)
"""


def with_views(sql: str) -> str:
    """Prefix a query (which may start with its own `WITH`) with the commerce views."""
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {VIEWS},\n{body[5:]}"
    return f"WITH {VIEWS}\n{body}"


def r(x: str, digits: int) -> str:
    """Half away from zero with plain double arithmetic."""
    return f"sign({x})*floor(abs({x})*1e{digits}+0.5e0)/1e{digits}"


def d(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def div(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE)/nullif(CAST({b} AS DOUBLE),0))"


def months(later: str, earlier: str) -> str:
    return (
        f"CAST((year({later})-year({earlier}))*12+(month({later})-month({earlier})) AS BIGINT)"
    )


REPORTS = {
    "daily_revenue": f"""
SELECT date, total_orders, {d('paid')} AS total_revenue, {div('paid', 'pay_rows')} AS avg_order_value,
       {div('paid', 'total_orders')} AS avg_per_order, unique_customers FROM v_daily""",
    "q1_daily_revenue_ma": f"""
WITH w AS (SELECT *, {div('paid', 'pay_rows')} AS aov,
    {div('sum(paid) OVER w7', 'count(paid) OVER w7')} AS m7, {div('sum(paid) OVER w30', 'count(paid) OVER w30')} AS m30,
    lag(paid) OVER o AS prev, lag(paid, 7) OVER o AS ago, sum(paid) OVER (ORDER BY date) AS running
  FROM v_daily WINDOW o AS (ORDER BY date), w7 AS (ORDER BY date ROWS 6 PRECEDING), w30 AS (ORDER BY date ROWS 29 PRECEDING)),
x AS (SELECT *, CASE WHEN prev > 0 THEN {div('(paid-prev)', 'prev')}*100e0 END AS pc,
             CASE WHEN ago > 0 THEN {div('(paid-ago)', 'ago')}*100e0 END AS wow FROM w)
SELECT date AS order_date, total_orders, {d('paid')} AS total_revenue, {r('aov', 2)} AS avg_order_value, unique_customers,
  {r('m7', 2)} AS ma_7d, {r('m30', 2)} AS ma_30d, {d('paid-prev')} AS daily_delta, {r('pc', 2)} AS pct_change,
  {d('running')} AS cumulative_revenue, {r('wow', 2)} AS wow_growth_pct FROM x""",
    "q2_rfm_sql": f"""
WITH co AS (SELECT customer_id, max(order_purchase_timestamp) AS last_purchase, count(*) AS frequency, sum(paid) AS monetary
  FROM v_orders JOIN v_paid USING (order_id) WHERE order_status = 'delivered' GROUP BY 1),
raw AS (SELECT customer_id, CAST(floor((epoch_us((SELECT max(o_orderdate) FROM orders)) - epoch_us(last_purchase)) / 86400e6) AS BIGINT) AS recency,
  frequency, monetary FROM co),
sc AS (SELECT *, ntile(5) OVER (ORDER BY recency DESC, customer_id) AS r, ntile(5) OVER (ORDER BY frequency, customer_id) AS f FROM raw),
sg AS (SELECT *, CASE WHEN r >= 4 AND f >= 4 THEN 'Champions' WHEN r >= 3 AND f >= 3 THEN 'Loyal Customers'
  WHEN r >= 4 AND f < 3 THEN 'Potential Loyalist' WHEN r <= 2 AND f >= 4 THEN 'At Risk'
  WHEN r = 1 AND f <= 2 THEN 'Lost' WHEN r >= 4 AND f = 1 THEN 'New Customers' ELSE 'Need Attention' END AS segment FROM sc),
g AS (SELECT segment, count(*) AS n, sum(recency) AS sr, sum(frequency) AS sf, sum(monetary) AS sm FROM sg GROUP BY 1),
h AS (SELECT *, {div('sr', 'n')} AS ar, {div('sf', 'n')} AS af, {div('sm', 'n')} AS am, {div('sm', 'sum(sm) OVER ()')}*100e0 AS share FROM g)
SELECT segment, n AS customer_count, {r('ar', 0)} AS avg_recency_days, {r('af', 1)} AS avg_frequency,
  {r('am', 2)} AS avg_monetary, {d('sm')} AS total_revenue, {r('share', 1)} AS revenue_share_pct FROM h""",
    "q3_cohort_retention": f"""
WITH a AS (SELECT DISTINCT customer_id, order_month FROM v_orders WHERE order_status = 'delivered'),
c AS (SELECT customer_id, min(order_month) AS cohort_month FROM a GROUP BY 1),
x AS (SELECT cohort_month, {months('order_month', 'cohort_month')} AS period, count(DISTINCT customer_id) AS customers
  FROM a JOIN c USING (customer_id) GROUP BY 1, 2),
s AS (SELECT cohort_month, customers AS cohort_size FROM x WHERE period = 0),
y AS (SELECT *, {div('customers', 'cohort_size')}*100e0 AS rate FROM x JOIN s USING (cohort_month) WHERE period <= 12)
SELECT cohort_month, cohort_size, period, customers, {r('rate', 1)} AS retention_rate_pct FROM y""",
    "q4_zscore": f"""
WITH dr AS (SELECT order_day AS dt, sum(paid) AS revenue, count(*) AS orders FROM v_orders JOIN v_paid USING (order_id)
  WHERE order_status IN ('delivered', 'shipped') GROUP BY 1),
st AS (SELECT {div('sum(revenue)', 'count(*)')} AS m, stddev_samp({d('revenue')}) AS s FROM dr),
z AS (SELECT dt, revenue, orders, ({d('revenue')} - m)/nullif(s, 0) AS z,
   {div('sum(revenue) OVER w', 'count(*) OVER w')} AS m7 FROM dr, st WINDOW w AS (ORDER BY dt ROWS 6 PRECEDING))
SELECT dt, {d('revenue')} AS revenue, orders, {r('z', 3)} AS z_score, {r('m7', 2)} AS roll_mean_7d,
  CASE WHEN abs(z) > 3 THEN 'CRITICAL' WHEN abs(z) > 2.5 THEN 'HIGH' WHEN abs(z) > 2 THEN 'MEDIUM' ELSE 'NORMAL' END AS severity,
  CASE WHEN z > 2 THEN 'SPIKE' WHEN z < -2 THEN 'DROP' ELSE 'NORMAL' END AS anomaly_type, abs(z) > 2 AS is_anomaly FROM z""",
    "q5_category_wow_drop": f"""
WITH p AS (SELECT product_category_name, CAST(date_trunc('week', order_day) AS DATE) AS week, sum(price) AS rev, count(DISTINCT order_id) AS orders
  FROM v_items JOIN v_products USING (product_id) JOIN v_orders USING (order_id)
  WHERE order_status IN ('delivered', 'shipped') GROUP BY 1, 2),
q AS (SELECT *, lag(rev) OVER w AS prev, lag(orders) OVER w AS prev_orders FROM p WINDOW w AS (PARTITION BY product_category_name ORDER BY week)),
x AS (SELECT *, rev - prev AS delta, {div('(rev - prev)', 'prev')}*100e0 AS pc FROM q WHERE prev IS NOT NULL
  ORDER BY rev - prev, product_category_name, week LIMIT 20)
SELECT product_category_name, week, {d('rev')} AS this_week_revenue, {d('prev')} AS last_week_revenue, {d('delta')} AS revenue_delta,
  CASE WHEN prev > 0 THEN {r('pc', 1)} END AS pct_change, orders AS this_week_orders, prev_orders AS last_week_orders FROM x""",
    "q6_cohort_ltv": f"""
WITH b AS (SELECT customer_id, min(order_month) OVER (PARTITION BY customer_id) AS cohort_month, order_month, paid
  FROM v_orders JOIN v_paid USING (order_id) WHERE order_status = 'delivered'),
m AS (SELECT cohort_month, {months('order_month', 'cohort_month')} AS k, count(DISTINCT customer_id) AS active, sum(paid) AS rev FROM b GROUP BY 1, 2),
s AS (SELECT cohort_month, active AS cohort_size FROM m WHERE k = 0),
x AS (SELECT *, {div('sum(rev) OVER (PARTITION BY cohort_month ORDER BY k)', 'cohort_size')} AS ltv FROM m JOIN s USING (cohort_month))
SELECT cohort_month, k AS months_since_first, cohort_size, active AS active_customers, {d('rev')} AS period_revenue, {r('ltv', 2)} AS cumulative_ltv FROM x""",
    "q7_seller_performance": f"""
WITH m AS (SELECT seller_id, seller_city, seller_state, seller_rating, count(DISTINCT order_id) AS total_orders,
   count(DISTINCT product_id) AS unique_products, {d('sum(price)')} AS total_revenue, {div('sum(price)', 'count(*)')} AS aip,
   {div('sum(review_score)', 'count(review_score)')} AS ars, count(DISTINCT order_month) AS active_months
  FROM v_items JOIN v_orders USING (order_id) JOIN v_sellers USING (seller_id) LEFT JOIN v_reviews USING (order_id)
  WHERE order_status = 'delivered' GROUP BY 1, 2, 3, 4),
k AS (SELECT *, rank() OVER (ORDER BY total_revenue DESC) AS revenue_rank, rank() OVER (ORDER BY ars DESC NULLS FIRST) AS review_rank,
   percent_rank() OVER (ORDER BY total_revenue)*100e0 AS pr FROM m)
SELECT seller_id, seller_city, seller_state, seller_rating, total_orders, unique_products, total_revenue, {r('aip', 2)} AS avg_item_price,
  {r('ars', 2)} AS avg_review_score, active_months, revenue_rank, review_rank, {r('pr', 1)} AS revenue_percentile
FROM k ORDER BY k.revenue_rank, seller_id LIMIT 50""",
    "q8_payment_running": f"""
WITH p AS (SELECT payment_type, order_month AS month, count(*) AS n, sum(payment_value) AS v, sum(payment_installments) AS i
  FROM v_payments JOIN v_orders USING (order_id) WHERE order_status = 'delivered' GROUP BY 1, 2),
x AS (SELECT *, {div('v', 'n')} AS av, {div('i', 'n')} AS ai, {div('v', 'sum(v) OVER (PARTITION BY month)')}*100e0 AS sh,
   sum(v) OVER (PARTITION BY payment_type ORDER BY month) AS run FROM p)
SELECT payment_type, month, n AS transaction_count, {d('v')} AS monthly_revenue, {r('av', 2)} AS avg_order_value, {r('ai', 1)} AS avg_installments,
  {d('run')} AS cumulative_revenue, {r('sh', 1)} AS monthly_share_pct FROM x""",
    "q9_geo_revenue": f"""
WITH g AS (SELECT customer_state, count(DISTINCT order_id) AS total_orders, count(DISTINCT customer_unique_id) AS unique_customers,
   sum(payment_value) AS paid, count(*) AS n, sum(review_score) AS sc, count(review_score) AS ns
  FROM v_orders JOIN v_customers USING (customer_id) JOIN v_payments USING (order_id) LEFT JOIN v_reviews USING (order_id)
  WHERE order_status = 'delivered' GROUP BY 1),
x AS (SELECT *, {div('paid', 'n')} AS aov, {div('sc', 'ns')} AS ars, {div('paid', 'sum(paid) OVER ()')}*100e0 AS sh,
   {div('total_orders', 'unique_customers')} AS opc FROM g)
SELECT customer_state, total_orders, unique_customers, {d('paid')} AS total_revenue, {r('aov', 2)} AS avg_order_value,
  {r('ars', 2)} AS avg_review_score, {r('sh', 2)} AS revenue_share_pct, {r('opc', 2)} AS orders_per_customer FROM x""",
    "q10_realtime_kpis": f"""
WITH t AS (SELECT max(order_purchase_timestamp) AS now FROM v_orders),
b AS (SELECT *, order_purchase_timestamp >= now - INTERVAL 1 HOUR AS h, order_day = CAST(now AS DATE) AS td,
   order_month = CAST(date_trunc('month', now) AS DATE) AS mt FROM v_orders JOIN v_paid USING (order_id), t),
g AS (SELECT count(*) FILTER (h) AS oh, sum(paid) FILTER (h) AS ph, sum(n_payments) FILTER (h) AS nh, count(*) FILTER (td) AS ot,
   sum(paid) FILTER (td) AS pt, count(*) FILTER (mt) AS om, sum(paid) FILTER (mt) AS pm,
   count(DISTINCT CASE WHEN mt THEN customer_id END) AS cm, any_value(now) AS snapshot_time FROM b),
x AS (SELECT *, {div('ph', 'nh')} AS aov FROM g)
SELECT oh AS orders_last_hour, {d('ph')} AS revenue_last_hour, {r('aov', 2)} AS aov_last_hour, ot AS orders_today,
  {d('pt')} AS revenue_today, om AS orders_mtd, {d('pm')} AS revenue_mtd, cm AS customers_mtd, snapshot_time FROM x""",
    "seller_performance": f"""
WITH m AS (SELECT seller_id, seller_city, seller_state, seller_rating, count(DISTINCT order_id) AS total_orders,
   count(DISTINCT product_id) AS unique_products, {d('sum(price)')} AS total_revenue, {div('sum(price)', 'count(*)')} AS aip,
   {div('sum(review_score)', 'count(review_score)')} AS ars, count(DISTINCT order_month) AS active_months
  FROM v_items JOIN v_orders USING (order_id) JOIN v_sellers USING (seller_id) LEFT JOIN v_reviews USING (order_id)
  WHERE order_status = 'delivered' GROUP BY 1, 2, 3, 4)
SELECT seller_id, seller_city, seller_state, seller_rating, total_orders, unique_products, total_revenue, {r('aip', 2)} AS avg_item_price,
  {r('ars', 2)} AS avg_review_score, active_months FROM m""",
    "daily_revenue_range": f"""
SELECT date, total_revenue, total_orders, avg_order_value FROM v_series WHERE date BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'""",
    "master_dataset": f"""
SELECT o.order_id, o.customer_id, c.customer_unique_id, c.customer_state, c.customer_city, c.customer_segment, o.order_status,
  o.order_purchase_timestamp, o.order_delivered_customer_date, v.item_count, {d('v.revenue')} AS revenue, {d('v.freight')} AS freight,
  v.unique_products, p.payment_type, p.payment_installments, {d('p.payment_value')} AS payment_value, w.review_score,
  year(order_day) AS year, month(order_day) AS month, isodow(order_day) - 1 AS day_of_week, hour(order_purchase_timestamp) AS hour,
  quarter(order_day) AS quarter, CAST(isodow(order_day) >= 6 AS BIGINT) AS is_weekend,
  {d('coalesce(v.revenue, 0) + coalesce(v.freight, 0)')} AS total_order_value,
  CAST(floor((epoch_us(order_delivered_customer_date) - epoch_us(order_purchase_timestamp)) / 86400e6) AS BIGINT) AS delivery_days
FROM v_orders o LEFT JOIN v_customers c USING (customer_id) LEFT JOIN v_value v USING (order_id)
LEFT JOIN v_payments p USING (order_id) LEFT JOIN v_reviews w USING (order_id)""",
    "master_dataset_order_grain": f"""
SELECT o.order_id, o.customer_id, {d('f.total_order_value')} AS total_order_value, f.n_payments, {d('f.paid')} AS paid,
  CASE WHEN f.review_score IS NULL THEN NULL ELSE 1 END AS n_reviews, f.review_score AS score_sum,
  CAST(floor((epoch_us(o.order_delivered_customer_date) - epoch_us(o.order_purchase_timestamp)) / 86400e6) AS BIGINT) AS delivery_days
FROM v_orders o JOIN v_facts f USING (order_id)""",
    "category_month_revenue": f"""
SELECT product_category_name, order_month AS month_year, {d('sum(price)')} AS revenue, count(DISTINCT order_id) AS orders
FROM v_items JOIN v_products USING (product_id) JOIN v_orders USING (order_id) GROUP BY 1, 2""",
    "category_revenue_top": f"""
SELECT product_category_name AS category, {d('sum(price)')} AS revenue, count(DISTINCT order_id) AS orders
FROM v_items JOIN v_products USING (product_id) GROUP BY 1 ORDER BY sum(price) DESC, 1 LIMIT 20""",
    "brand_revenue_top": f"""
SELECT product_brand AS category, {d('sum(price)')} AS revenue, count(DISTINCT order_id) AS orders
FROM v_items JOIN v_products USING (product_id) GROUP BY 1 ORDER BY sum(price) DESC, 1 LIMIT 15""",
    "top_products": f"""
SELECT product_id, {d('sum(price)')} AS revenue, count(*) AS orders FROM v_items GROUP BY 1 ORDER BY sum(price) DESC, product_id LIMIT 10""",
    "state_revenue": f"""
SELECT customer_state AS state, {d('sum(total_order_value)')} AS revenue, count(DISTINCT customer_id) AS customers,
  round(ln(1 + {d('sum(total_order_value)')}), 9) AS log_revenue FROM v_facts LEFT JOIN v_customers USING (customer_id) GROUP BY 1""",
    "payment_mix": f"""
WITH p AS (SELECT payment_type, count(*) AS n, sum(payment_value) AS v FROM v_payments GROUP BY 1)
SELECT payment_type, n AS count, {d('v')} AS total_value, {div('n', 'sum(n) OVER ()')}*100e0 AS count_share_pct FROM p""",
    "customer_orders": f"""
SELECT o.order_id, o.order_status, o.order_purchase_timestamp, p.payment_type, {d('p.payment_value')} AS payment_value, w.review_score,
  {d('coalesce(v.revenue, 0) + coalesce(v.freight, 0)')} AS total_order_value
FROM v_orders o LEFT JOIN v_value v USING (order_id) LEFT JOIN v_payments p USING (order_id) LEFT JOIN v_reviews w USING (order_id)
WHERE o.customer_id = 42""",
}

REPORTS["geo_revenue"] = REPORTS["q9_geo_revenue"]
REPORTS["master_dataset_bucketed"] = REPORTS["master_month_rerun"] = REPORTS["master_dataset"]
