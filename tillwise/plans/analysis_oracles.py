"""Plain SQL twins of the analyses (customers, anomalies, forecasts, sentiment, events)."""

from __future__ import annotations

from .oracles import d, div, months, r

# --- shared pieces ----------------------------------------------------------------

RFM = f"""
rb AS (SELECT customer_id, max(order_purchase_timestamp) AS last_purchase, count(*) AS frequency,
    sum(total_order_value) AS monetary, sum(total_order_value * row_multiplicity) AS monetary_rows,
    CAST(floor((epoch_us((SELECT max(o_orderdate) FROM orders)) - epoch_us(max(order_purchase_timestamp))) / 86400e6) AS BIGINT) AS recency
  FROM v_facts WHERE order_status = 'delivered' GROUP BY 1),
rq AS (SELECT quantile_cont({d('recency')}, [0.2, 0.4, 0.6, 0.8]) AS rq, quantile_cont({d('frequency')}, 0.99) AS f99,
    quantile_cont({d('monetary')}, 0.99) AS m99 FROM rb),
rq2 AS (SELECT quantile_cont(least({d('frequency')}, f99), [0.2, 0.4, 0.6, 0.8]) AS fq,
    quantile_cont(least({d('monetary')}, m99), [0.2, 0.4, 0.6, 0.8]) AS mq FROM rb, rq),
rs AS (SELECT rb.*, 5 - (CAST({d('recency')} > rq[1] AS BIGINT) + CAST({d('recency')} > rq[2] AS BIGINT) + CAST({d('recency')} > rq[3] AS BIGINT) + CAST({d('recency')} > rq[4] AS BIGINT)) AS R_score,
    1 + (CAST({d('frequency')} > fq[1] AS BIGINT) + CAST({d('frequency')} > fq[2] AS BIGINT) + CAST({d('frequency')} > fq[3] AS BIGINT) + CAST({d('frequency')} > fq[4] AS BIGINT)) AS F_score,
    1 + (CAST({d('monetary')} > mq[1] AS BIGINT) + CAST({d('monetary')} > mq[2] AS BIGINT) + CAST({d('monetary')} > mq[3] AS BIGINT) + CAST({d('monetary')} > mq[4] AS BIGINT)) AS M_score FROM rb, rq, rq2),
rfm AS (SELECT *, R_score*100 + F_score*10 + M_score AS RFM_score, (R_score+F_score+M_score)::DOUBLE/3e0 AS RFM_avg,
  CASE R_score*10 + F_score
    WHEN 55 THEN 'Champions' WHEN 54 THEN 'Champions' WHEN 53 THEN 'Potential Loyalist' WHEN 52 THEN 'New Customers' WHEN 51 THEN 'New Customers'
    WHEN 45 THEN 'Loyal Customers' WHEN 44 THEN 'Loyal Customers' WHEN 43 THEN 'Potential Loyalist' WHEN 42 THEN 'Promising' WHEN 41 THEN 'Promising'
    WHEN 35 THEN 'At Risk' WHEN 34 THEN 'At Risk' WHEN 33 THEN 'Need Attention' WHEN 32 THEN 'Need Attention' WHEN 31 THEN 'About to Sleep'
    WHEN 25 THEN 'Cannot Lose' WHEN 24 THEN 'Cannot Lose' WHEN 23 THEN 'About to Sleep' WHEN 22 THEN 'Hibernating' WHEN 21 THEN 'Hibernating'
    WHEN 15 THEN 'Lost' WHEN 14 THEN 'Lost' WHEN 13 THEN 'Hibernating' WHEN 12 THEN 'Hibernating' WHEN 11 THEN 'Lost'
    ELSE 'Need Attention' END AS segment FROM rs)
"""

NEXT_STEP = """CASE segment WHEN 'Champions' THEN 'Reward program / Early access' WHEN 'Loyal Customers' THEN 'Upsell premium products'
  WHEN 'At Risk' THEN 'Win-back campaign with discount' WHEN 'Hibernating' THEN 'Re-engagement email series'
  WHEN 'Lost' THEN 'Survey for feedback' WHEN 'New Customers' THEN 'Onboarding sequence' WHEN 'Promising' THEN 'Product recommendations'
  WHEN 'Need Attention' THEN 'Limited-time offer'
  ELSE CASE WHEN recency < 30 AND frequency < 2 THEN 'Second purchase incentive' WHEN monetary > 1000 THEN 'VIP treatment'
       ELSE 'General newsletter' END END"""

IMPACTS = (
    "(recency::DOUBLE - 90e0)/180e0*0.4e0",
    "(1e0/greatest(frequency::DOUBLE, 1e0) - 0.5e0)*0.35e0",
    "(1e0 - monetary::DOUBLE/2000e0)*0.25e0",
)

COHORT = f"""
ca AS (SELECT customer_id, order_month, sum(total_order_value) AS value FROM v_facts GROUP BY 1, 2),
cf AS (SELECT customer_id, min(order_month) AS cohort_month FROM ca GROUP BY 1),
cx AS (SELECT cohort_month, {months('order_month', 'cohort_month')} AS period, count(*) AS customers, sum(value) AS revenue
  FROM ca JOIN cf USING (customer_id) GROUP BY 1, 2),
cs AS (SELECT cohort_month, customers AS cohort_size FROM cx WHERE period = 0),
cr0 AS (SELECT *, {div('customers', 'cohort_size')}*100e0 AS rate FROM cx JOIN cs USING (cohort_month)),
cr AS (SELECT cohort_month, period, cohort_size, customers, {r('rate', 1)} AS retention, {d('revenue')} AS revenue FROM cr0),
cl0 AS (SELECT cohort_month, period, {div('sum(revenue) OVER (PARTITION BY cohort_month ORDER BY period)', 'cohort_size')} AS ltv
  FROM cx JOIN cs USING (cohort_month) WHERE period < 12),
cl AS (SELECT cohort_month, period, {r('ltv', 2)} AS ltv FROM cl0)
"""

SEVERITY = """CASE WHEN abs({z}) < 2.0 THEN 'none' WHEN abs({z}) < 2.5 THEN 'low' WHEN abs({z}) < 3.5 THEN 'medium'
  WHEN abs({z}) < 5.0 THEN 'high' ELSE 'critical' END"""


def rolled(frame: str) -> str:
    return f"""
rl AS (SELECT *, lag(total_revenue) OVER o AS revenue_lag1, lag(total_revenue, 7) OVER o AS revenue_lag7,
    (total_revenue/nullif(lag(total_revenue) OVER o, 0) - 1e0)*100e0 AS chg,
    CASE WHEN count(*) OVER w >= 3 THEN avg(total_revenue) OVER w END AS m,
    CASE WHEN count(*) OVER w >= 3 THEN stddev_samp(total_revenue) OVER w END AS sd,
    CASE WHEN count(*) OVER w >= 3 THEN median(total_revenue) OVER w END AS md
  FROM v_series WINDOW o AS (ORDER BY date), w AS (ORDER BY date ROWS BETWEEN {frame}))"""


ROLLED = rolled("6 PRECEDING AND CURRENT ROW")
ZSCORE = """
zs AS (SELECT avg(total_revenue) AS mu, greatest(stddev_samp(total_revenue), 1e0) AS sg,
    quantile_cont(total_revenue, 0.25) AS q1, quantile_cont(total_revenue, 0.75) AS q3 FROM v_series),
zz AS (SELECT rl.*, (total_revenue - mu)/sg AS z, q1 - 1.5e0*(q3-q1) AS lo, q3 + 1.5e0*(q3-q1) AS hi, m + 3*sd AS ucl, m - 3*sd AS lcl FROM rl, zs)
"""


def flagged(fires: str) -> str:
    return f"""
fl AS (SELECT *, {fires} AS is_anomaly, CASE WHEN NOT {fires} THEN 'normal' WHEN z > 0 THEN 'spike' ELSE 'drop' END AS anomaly_type,
    {SEVERITY.format(z='z')} AS anomaly_severity, abs(total_revenue - m) AS mag, least(0.95e0, 0.5e0 + abs(z)/10e0) AS conf FROM zz)
"""


VOTES = """CAST(abs(z) > 2.5 AS BIGINT) + CAST(total_revenue < lo OR total_revenue > hi AS BIGINT)
   + CAST(coalesce(total_revenue > ucl OR total_revenue < greatest(lcl, 0), false) AS BIGINT)"""
FLAGS = {"": flagged(f"(({VOTES}) >= 2)"), "_sensitive": flagged("(abs(z) > 1.5)")}
CAUSES = f"""
dd AS (
  SELECT order_day AS date, 'customer_state' AS dimension, customer_state AS value, sum(total_order_value) AS revenue
    FROM v_facts LEFT JOIN v_customers USING (customer_id) WHERE customer_state IS NOT NULL GROUP BY ALL
  UNION ALL
  SELECT order_day, 'payment_type', payment_type, sum(total_order_value)
    FROM v_facts JOIN (SELECT DISTINCT order_id, payment_type FROM v_payments) USING (order_id) GROUP BY ALL
  UNION ALL
  SELECT order_day, 'product_category', product_category_name, sum(price)
    FROM v_items JOIN v_products USING (product_id) JOIN v_orders USING (order_id) GROUP BY ALL),
rc0 AS (SELECT f.date AS anomaly_date, dimension, value, {d('coalesce(sum(revenue) FILTER (dd.date = f.date), 0)')} AS anomaly_revenue,
    {d('coalesce(sum(revenue) FILTER (dd.date < f.date), 0)')}/7e0 AS prior
  FROM dd JOIN fl f ON f.is_anomaly AND dd.date BETWEEN f.date - 7 AND f.date GROUP BY ALL),
rc1 AS (SELECT *, anomaly_revenue - prior AS delta, (anomaly_revenue - prior)/nullif(prior, 0)*100e0 AS dp FROM rc0),
rc AS (SELECT *, row_number() OVER (PARTITION BY anomaly_date, dimension ORDER BY delta DESC, value) AS position FROM rc1)
"""


def anomaly_twins() -> dict[str, str]:
    """The reports on the default votes and on the sensitive setting."""
    out = {}
    for name, flags in FLAGS.items():
        out |= {
            f"anomaly_report{name}": f"""WITH {ROLLED}, {ZSCORE}, {flags} SELECT date, total_revenue, {r('chg', 3)} AS revenue_change_pct, {r('z', 6)} AS z_score, anomaly_type,
  anomaly_severity, {r('mag', 3)} AS anomaly_magnitude, is_anomaly, {r('conf', 6)} AS confidence FROM fl WHERE is_anomaly""",
            f"recent_alerts{name}": f"""WITH {ROLLED}, {ZSCORE}, {flags} SELECT date, total_revenue, {r('z', 6)} AS z_score, anomaly_type, anomaly_severity
FROM fl WHERE is_anomaly ORDER BY date DESC LIMIT 3""",
            f"anomaly_days_semi{name}": f"WITH {ROLLED}, {ZSCORE}, {flags} SELECT date, total_revenue FROM v_series WHERE date IN (SELECT date FROM fl WHERE anomaly_type = 'spike')",
            f"root_cause{name}": f"""WITH {ROLLED}, {ZSCORE}, {flags}, {CAUSES} SELECT anomaly_date, dimension, value, anomaly_revenue, {r('prior', 3)} AS prior_avg_revenue,
  {r('delta', 3)} AS delta, {r('dp', 1)} AS delta_pct, position FROM rc""",
            f"anomaly_alerts{name}": f"""WITH {ROLLED}, {ZSCORE}, {flags}, {CAUSES} SELECT date, upper(anomaly_type) AS anomaly_type, anomaly_severity AS severity,
  {r('mag', 3)} AS revenue_impact, value AS top_driver, {r('delta', 3)} AS driver_delta
FROM fl LEFT JOIN rc ON anomaly_date = date AND dimension = 'customer_state' AND position = 1 WHERE is_anomaly""",
        }
    return out


def naive(source: str, name: str) -> str:
    return f"""
{name} AS (SELECT step, CAST(e + CAST(step AS INTEGER) AS DATE) AS date, y AS forecast, greatest(y - 1.28e0*sd, 0) AS lower, y + 1.28e0*sd AS upper
  FROM (SELECT max(date) AS e, max_by(total_revenue, date) AS y,
          CASE WHEN count(*) > 30 THEN stddev_pop(total_revenue) FILTER (age <= 30) ELSE 0 END AS sd
        FROM (SELECT *, row_number() OVER (ORDER BY date DESC) AS age FROM {source})),
       (SELECT unnest(range(1, 31)) AS step))"""


def seasonal(source: str, name: str, key: str = "") -> str:
    by = f"PARTITION BY {key} " if key else ""
    keyed = f"{key}, " if key else ""
    group = f"GROUP BY {key}" if key else ""
    return f"""
{name}_p AS (SELECT *, total_revenue - lag(total_revenue, 7) OVER ({by}ORDER BY date) AS chg,
    row_number() OVER ({by}ORDER BY date DESC) AS age FROM {source}),
{name}_e AS (SELECT {keyed}max(date) AS e, max_by(total_revenue, date) AS lvl, coalesce(avg(chg), 0) AS dr, coalesce(stddev_samp(chg), 0) AS sd,
    list(total_revenue ORDER BY date) FILTER (age <= 7) AS season FROM {name}_p {group}),
{name}_s AS (SELECT *, CAST(ceil(step/7.0) AS INTEGER) AS k, season[(step-1) % 7 + 1] AS base FROM {name}_e, (SELECT unnest(range(1, 31)) AS step)),
{name} AS (SELECT {keyed}step, CAST(e + CAST(step AS INTEGER) AS DATE) AS date, greatest(base + k*dr, 0) AS forecast,
    greatest(greatest(base + k*dr, 0) - 1.28e0*sd*sqrt(k), 0) AS lower, greatest(base + k*dr, 0) + 1.28e0*sd*sqrt(k) AS upper FROM {name}_s)"""


SPLIT = """
sp AS (SELECT *, row_number() OVER (ORDER BY date DESC) AS age FROM v_series),
tr AS (SELECT * EXCLUDE (age) FROM sp WHERE age > 30),
te AS (SELECT *, 31 - age AS step FROM sp WHERE age <= 30)"""
BACKTEST = f"""{SPLIT},{naive('tr', 'nf')},{seasonal('tr', 'sf')},
bt AS (SELECT te.date, step, total_revenue, nf.forecast AS naive, sf.forecast AS seasonal FROM te JOIN nf USING (step) JOIN sf USING (step))"""


def metrics(model: str) -> str:
    return f"""SELECT '{model}' AS model, avg(abs(total_revenue - {model})) AS a, sqrt(avg((total_revenue - {model})*(total_revenue - {model}))) AS b,
  avg(abs(total_revenue - {model})/greatest(total_revenue, 1))*100e0 AS c FROM bt"""


WORD = r"[\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}]+"


def quoted(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def scored_text(lexicon, name: str = "ts") -> str:
    weights = " ".join(f"WHEN '{w}' THEN {x}e0" for w, x in lexicon.intensifiers.items())
    return f"""
tk0 AS (SELECT review_id, regexp_extract_all(lower(review_comment_message), '{WORD}') AS ws FROM v_texts),
tk AS (SELECT review_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM tk0),
tc AS (SELECT *, CASE w {weights} END AS boost, w IN ({quoted(lexicon.negators)}) AS neg FROM tk),
td AS (SELECT *, CASE WHEN boost IS NULL AND NOT neg THEN 1 ELSE 0 END AS other FROM tc),
tg AS (SELECT *, coalesce(sum(other) OVER (PARTITION BY review_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS g FROM td),
th AS (SELECT review_id, g, coalesce(arg_max(boost, i) FILTER (boost IS NOT NULL), 1e0) AS wt, bool_or(neg AND boost IS NULL) AS ng,
    max(CASE WHEN other = 0 THEN 0 WHEN w IN ({quoted(lexicon.positive)}) THEN 1 ELSE 0 END)
    + min(CASE WHEN other = 0 THEN 0 WHEN w IN ({quoted(lexicon.positive)}) THEN 0 WHEN w IN ({quoted(lexicon.negative)}) THEN -1 ELSE 0 END) AS pol,
    count(*) AS n FROM tg GROUP BY 1, 2),
ti AS (SELECT review_id, sum(pol*wt*CASE WHEN ng THEN -0.5e0 ELSE 1e0 END) AS total, sum(n) AS n FROM th GROUP BY 1),
{name} AS (SELECT v.*, coalesce(greatest(-1e0, least(1e0, total/greatest(sqrt({d('n')}), 1e0))), 0e0) AS txt, ({d('review_score')} - 3e0)/2e0 AS sc
  FROM v_texts v LEFT JOIN ti USING (review_id))"""


BAND = """CASE WHEN cb >= 0.5 THEN 'Very Positive' WHEN cb >= 0.2 THEN 'Positive' WHEN cb >= -0.2 THEN 'Neutral'
  WHEN cb >= -0.5 THEN 'Negative' ELSE 'Very Negative' END"""


def replayed(slices: int = 4) -> str:
    """The events by the slice of their arrival, two or four slices late by their id, and the watermark at each slice:
    the newest time of the slices before, less two and a half slices."""
    return f"""
rp_span AS (SELECT epoch_us(min(ts)) AS lo, epoch_us(max(ts)) AS hi, (epoch_us(max(ts)) - epoch_us(min(ts)) + 1)//{slices} + 1 AS w FROM v_events),
rp_events AS (SELECT e.*, w, least({slices - 1}, (epoch_us(ts) - lo + CASE WHEN event_id % 97 = 0 THEN 2*w WHEN event_id % 89 = 0 THEN 4*w
    ELSE event_id % 7*60000000 END)//w) AS slice FROM v_events e, rp_span),
rp_marks AS (SELECT s AS slice, (SELECT (max(epoch_us(ts))//1000 - any_value(w)*5//2//1000)*1000 FROM rp_events WHERE slice < s) AS mark
  FROM range({slices + 1}) x(s))"""


KEPT = "kept AS (SELECT e.* FROM rp_events e JOIN rp_marks USING (slice) WHERE mark IS NULL OR epoch_us(ts) > mark)"


def event_z(source: str) -> str:
    return f"""
ezc AS (SELECT event_id, ts, customer_id, revenue, CAST(revenue*100 AS HUGEINT) AS c FROM {source}),
ez0 AS (SELECT event_id, ts, customer_id, revenue, count(*) OVER w AS history_count, sum(revenue) OVER w AS s,
    sqrt(CAST((count(*) OVER w)*(sum(c*c) OVER w) - (sum(c) OVER w)*(sum(c) OVER w) AS DOUBLE)/1e4)/CAST(count(*) OVER w AS DOUBLE) AS sd FROM ezc
    WINDOW w AS (PARTITION BY customer_id ORDER BY ts, event_id ROWS BETWEEN 50 PRECEDING AND 1 PRECEDING)),
ez1 AS (SELECT *, CASE WHEN history_count > 0 THEN ({d('revenue')} - {div('s', 'history_count')})
    / greatest(CASE WHEN history_count > 1 THEN sd ELSE 1 END, 0.01e0) ELSE 0 END AS z FROM ez0),
ez AS (SELECT event_id, ts, customer_id, {d('revenue')} AS revenue, history_count, {r('z', 3)} AS z_score, z > 2.5 AS is_spike, z < -2.5 AS is_drop,
    abs(z) > 2.5 AS is_anomaly, {SEVERITY.format(z='z')} AS anomaly_severity FROM ez1)
"""


EVENT_Z = event_z("v_events")


def event_kpis(seconds: int) -> str:
    return f"""n AS event_count, s AS total_revenue, {r('a', 2)} AS avg_revenue, hi AS max_revenue, lo AS min_revenue,
  {r('sd', 2)} AS std_revenue, {r('pm', 2)} AS events_per_min"""




def spread(n: str, cents: str, over: str = "") -> str:
    """Population deviation from whole cents."""
    c = f"CAST({cents}*100 AS HUGEINT)"
    return f"sqrt(CAST({n}*sum({c}*{c}){over} - (sum({c}){over})*(sum({c}){over}) AS DOUBLE)/1e4)/CAST({n} AS DOUBLE)"


FOLD = f"""count(*) AS n, {d('sum(revenue)')} AS s, {div('sum(revenue)', 'count(*)')} AS a, {d('max(revenue)')} AS hi,
  {d('min(revenue)')} AS lo, {spread('count(*)', 'revenue')} AS sd, count(*)/5e0 AS pm"""
PANES = """SELECT *, time_bucket(INTERVAL 1 MINUTE, ts) - to_seconds(60*k) AS window_start FROM v_events, (SELECT unnest(range(5)) AS k)"""


def build(default_lexicon, corpus_lexicon, stopwords, actions) -> dict[str, str]:
    history = {
        **{f"lag_{n}": f"lag(total_revenue, {n}) OVER o" for n in (1, 2, 3, 7, 14, 28)},
    }
    rolls, frames = [], []
    for n in (3, 7, 14, 30):
        frames.append(f"w{n} AS (ORDER BY date ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)")
        for name, fn in (("mean", "avg"), ("std", "stddev_samp"), ("max", "max"), ("min", "min")):
            rolls.append(
                f"CASE WHEN count(*) OVER w{n} = {n} THEN {fn}(total_revenue) OVER w{n} END AS x_{name}_{n}"
            )
    moms = [
        f"lag(total_revenue, 1) OVER o / nullif(lag(total_revenue, {n + 1}) OVER o, 0) - 1e0 AS x_mom_{n}"
        for n in (7, 30)
    ]
    calendar = """isodow(date) - 1 AS day_of_week, day(date) AS day_of_month, weekofyear(date) AS week_of_year, month(date) AS month,
      quarter(date) AS quarter, year(date) AS year, CAST(isodow(date) >= 6 AS BIGINT) AS is_weekend,
      CAST(day(date) = 1 AS BIGINT) AS is_month_start, CAST(date = last_day(date) AS BIGINT) AS is_month_end"""
    waves = {
        "month_sin": "sin(2*pi()*month(date)/12e0)", "month_cos": "cos(2*pi()*month(date)/12e0)",
        "dow_sin": "sin(2*pi()*(isodow(date)-1)/7e0)", "dow_cos": "cos(2*pi()*(isodow(date)-1)/7e0)",
    }
    wave_columns = ", ".join(f"{r(f'({x})', 9)} AS {n}" for n, x in waves.items())
    rounded_rolls = ", ".join(
        [f"{r(f'x_{s}_{n}', 3)} AS roll_{s}_{n}" for n in (3, 7, 14, 30) for s in ("mean", "std", "max", "min")]
        + [f"{r(f'x_mom_{n}', 3)} AS mom_{n}" for n in (7, 30)]
    )
    action_cases = " ".join(f"WHEN '{k}' THEN '{v.replace(chr(39), chr(39) * 2)}'" for k, v in actions.items())
    combined = f"{scored_text(corpus_lexicon)}, sn0 AS (SELECT *, 0.7e0*sc + 0.3e0*txt AS cb FROM ts), sn AS (SELECT *, {BAND} AS band FROM sn0)"
    dq_tables = {
        "orders": ("v_orders", ["order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_delivered_customer_date"]),
        "customers": ("v_customers", ["customer_id", "customer_unique_id", "customer_state", "customer_city", "customer_segment"]),
        "order_items": ("v_items", ["order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value"]),
        "payments": ("v_payments", ["order_id", "payment_type", "payment_installments", "payment_value"]),
        "reviews": ("v_reviews", ["review_id", "order_id", "review_score", "review_creation_date"]),
        "products": ("v_products", ["product_id", "product_category_name", "product_brand", "product_name"]),
        "sellers": ("v_sellers", ["seller_id", "seller_city", "seller_state", "seller_rating"]),
    }
    dq = []
    for name, (view, columns) in dq_tables.items():
        share = f"greatest({', '.join(f'count(*) FILTER ({c} IS NULL)' for c in columns)})::DOUBLE/count(*)::DOUBLE"
        dq.append(f"SELECT '{name}' AS table_name, 'row_count' AS check_name, count(*)::DOUBLE AS value, count(*) = 0 AS failed FROM {view}")
        dq.append(f"SELECT '{name}', 'max_null_share', {share}, {share} > 0.5 FROM {view}")
    for name, keys in (("orders", "order_id"), ("customers", "customer_id"), ("order_items", "order_id,order_item_id"),
                       ("products", "product_id"), ("sellers", "seller_id"), ("reviews", "review_id")):
        dq.append(f"SELECT '{name}', 'duplicate_key:{keys}', count(*)::DOUBLE, count(*) > 0 FROM (SELECT {keys} FROM {dq_tables[name][0]} GROUP BY ALL HAVING count(*) > 1)")
    for child, key, parent in (("orders", "customer_id", "customers"), ("order_items", "order_id", "orders"), ("order_items", "product_id", "products"),
                               ("order_items", "seller_id", "sellers"), ("payments", "order_id", "orders"), ("reviews", "order_id", "orders")):
        dq.append(f"SELECT '{child}', 'missing_parent:{key}->{parent}', count(*)::DOUBLE, count(*) > 0 FROM {dq_tables[child][0]} WHERE {key} NOT IN (SELECT {key} FROM {dq_tables[parent][0]})")
    dq.append("SELECT 'reviews', 'range:review_score', count(*)::DOUBLE, count(*) > 0 FROM v_reviews WHERE review_score NOT BETWEEN 1 AND 5")

    cohort_cells = ", ".join(f"max(retention) FILTER (period = {p}) AS m{p}" for p in range(24))
    heat_cells = ", ".join(f"max(retention) FILTER (period = {p}) AS \"Month {p}\"" for p in range(13))
    ltv_cells = ", ".join(f"max(ltv) FILTER (period = {p}) AS LTV_M{p}" for p in range(12))
    mean_at = lambda p: r(div(f"sum(CAST(round(retention*10) AS BIGINT)) FILTER (period = {p})", f"(count(*) FILTER (period = {p}))*10"), 1)
    size_avg = r(div("sum(customers) FILTER (period = 0)", "count(*) FILTER (period = 0)"), 0)

    return {
        "scan_csv_roundtrip": f"SELECT order_id, order_item_id, product_id, seller_id, {d('price')} AS price, {d('freight_value')} AS freight_value FROM v_items",
        "table_load_clean": f"SELECT order_id, payment_type, {d('payment_value')} AS payment_value FROM v_payments",
        "table_replace": f"SELECT payment_type, 2*count(*) AS count, {d('sum(payment_value)')} AS total_value FROM v_payments GROUP BY 1",
        "table_select": "SELECT order_id, customer_id, order_status FROM v_orders WHERE order_status = 'delivered' ORDER BY customer_id DESC, order_id LIMIT 100",
        "sql_param_query": f"""SELECT order_status, payment_type, count(*) AS n, {d('sum(payment_value)')} AS total FROM v_orders JOIN v_payments USING (order_id)
  WHERE order_status = 'delivered' AND payment_value >= 100000 GROUP BY ALL""",
        "dq_report": "\nUNION ALL ".join(dq),
        "calendar_features": f"""WITH o AS (SELECT order_id, order_day AS date FROM v_orders)
SELECT order_id, {calendar}, CAST(date_trunc('week', date) AS DATE) AS week_start, CAST(date_trunc('month', date) AS DATE) AS month_start,
  CAST(date_trunc('week', date) AS DATE) + 6 AS week_end, last_day(date) AS month_end FROM o""",
        "cyclic_features": f"WITH o AS (SELECT order_id, order_day AS date FROM v_orders) SELECT order_id, {wave_columns} FROM o",
        "delivery_days": """SELECT order_id, CAST(floor((epoch_us(order_delivered_customer_date) - epoch_us(order_purchase_timestamp)) / 86400e6) AS BIGINT) AS delivery_days
FROM v_orders WHERE order_delivered_customer_date IS NOT NULL""",
        "safe_date_parse": """SELECT order_id, try_cast(CASE WHEN order_id % 7 = 0 THEN 'unknown' WHEN order_id % 11 = 0 THEN '1997-02-30'
  ELSE strftime(order_day, '%Y-%m-%d') END AS DATE) AS parsed FROM v_orders""",
        "json_event_parse": f"SELECT event_id, customer_id, ts, {d('revenue')} AS revenue, category, CAST(props->>'$.k' AS BIGINT) AS k FROM v_events",
        "severity_labels": f"WITH {ROLLED}, {ZSCORE} SELECT date, {SEVERITY.format(z='z')} AS severity FROM zz",
        "sql_functions": f"""WITH k AS (SELECT order_id, (order_id % 61)/10e0 AS z, CAST(order_id % 5 + 1 AS INTEGER) AS R_score,
   CAST((order_id // 5) % 5 + 1 AS INTEGER) AS F_score, (order_id % 11)/10e0 AS p, (order_id % 21)/10e0 - 1 AS cb FROM v_orders)
SELECT order_id, {SEVERITY.format(z='z')} AS severity, {RFM[RFM.index('CASE R_score*10'):RFM.index(' AS segment')]} AS segment,
  CASE WHEN p <= 0.3 THEN 'Low' WHEN p <= 0.6 THEN 'Medium' WHEN p <= 0.8 THEN 'High' ELSE 'Critical' END AS risk, {BAND} AS band FROM k""",
        "tokenize": f"""WITH t AS (SELECT unnest(regexp_extract_all(lower(review_comment_message), '{WORD}')) AS word FROM v_texts)
SELECT word, count(*) AS n FROM t GROUP BY 1""",
        "state_geo": f"""WITH p AS (SELECT n_name, n_nationkey*1.5e0 - 20e0 AS lat, n_nationkey*-2e0 AS lon FROM nation WHERE n_nationkey % 2 = 0),
s AS (SELECT customer_state AS state, {d('sum(total_order_value)')} AS revenue, count(DISTINCT customer_id) AS customers
  FROM v_facts LEFT JOIN v_customers USING (customer_id) GROUP BY 1)
SELECT state, revenue, customers, coalesce(lat, 0e0) AS lat, coalesce(lon, 0e0) AS lon FROM s LEFT JOIN p ON n_name = state""",
        "rfm_base": f"WITH {RFM} SELECT customer_id, last_purchase, frequency, {d('monetary')} AS monetary, recency FROM rb",
        "rfm_base_rows": f"WITH {RFM} SELECT customer_id, last_purchase, frequency, {d('monetary_rows')} AS monetary, recency FROM rb",
        "rfm_scores": f"WITH {RFM} SELECT customer_id, R_score, F_score, M_score FROM rfm",
        "rfm_segments": f"WITH {RFM} SELECT customer_id, RFM_score, {r('RFM_avg', 6)} AS RFM_avg, segment FROM rfm",
        "rfm_segment_filter": f"WITH {RFM} SELECT customer_id, recency, frequency, {d('monetary')} AS monetary FROM rfm WHERE segment = 'Champions'",
        "rfm_segment_summary": f"""WITH {RFM}, g AS (SELECT segment, count(*) AS n, sum(recency) AS sr, sum(frequency) AS sf, sum(monetary) AS sm,
   sum(R_score+F_score+M_score) AS ss FROM rfm GROUP BY 1),
h AS (SELECT *, {div('sr', 'n')} AS ar, {div('sf', 'n')} AS af, {div('sm', 'n')} AS am, {div('ss', 'n*3')} AS a3, {div('sm', 'sum(sm) OVER ()')}*100e0 AS sh FROM g)
SELECT segment, n AS customer_count, {r('ar', 2)} AS avg_recency, {r('af', 2)} AS avg_frequency, {r('am', 2)} AS avg_monetary, {d('sm')} AS total_revenue,
  {r('a3', 2)} AS avg_rfm, {r('sh', 1)} AS revenue_share FROM h""",
        "rfm_rank_quintile": f"""WITH {RFM} SELECT customer_id, ntile(5) OVER (ORDER BY recency, customer_id) AS r_quintile,
  ntile(5) OVER (ORDER BY frequency, customer_id) AS f_quintile, ntile(5) OVER (ORDER BY monetary, customer_id) AS m_quintile FROM rb""",
        "next_best_action": f"WITH {RFM} SELECT customer_id, segment, CASE segment {action_cases} END AS recommended_action, {NEXT_STEP} AS next_best_action FROM rfm",
        "cohort_retention": f"WITH {COHORT} SELECT cohort_month, period, cohort_size, customers, retention, revenue FROM cr",
        "cohort_pivot": f"WITH {COHORT} SELECT cohort_month, {cohort_cells} FROM cr GROUP BY 1",
        "cohort_heatmap": f"WITH {COHORT} SELECT strftime(cohort_month, '%Y-%m') AS cohort_month, {heat_cells} FROM cr GROUP BY cr.cohort_month",
        "cohort_ltv": f"WITH {COHORT} SELECT cohort_month, {ltv_cells} FROM cl GROUP BY 1",
        "cohort_summary": f"""WITH {COHORT}
SELECT count(DISTINCT cohort_month) AS total_cohorts, coalesce({mean_at(1)}, 0) AS avg_m1_retention_pct, coalesce({mean_at(3)}, 0) AS avg_m3_retention_pct,
  coalesce({mean_at(6)}, 0) AS avg_m6_retention_pct,
  (SELECT strftime(cohort_month, '%Y-%m') FROM cr WHERE period = 1 ORDER BY retention DESC, cohort_month LIMIT 1) AS best_cohort_m1,
  (SELECT strftime(cohort_month, '%Y-%m') FROM cr WHERE period = 1 ORDER BY retention, cohort_month LIMIT 1) AS worst_cohort_m1,
  {size_avg} AS avg_cohort_size, CAST(sum(customers) FILTER (period = 0) AS BIGINT) AS total_customers FROM cr""",
        "churn_features": f"""WITH t AS (SELECT max(o_orderdate) AS now FROM orders),
f AS (SELECT customer_id, count(*) AS order_count, sum(total_order_value) AS v, sum(review_score) AS s, count(review_score) AS ns,
   min(order_purchase_timestamp) AS a, max(order_purchase_timestamp) AS b, CAST(sum(row_multiplicity) AS BIGINT) AS unique_categories FROM v_facts GROUP BY 1),
c AS (SELECT customer_id, count(DISTINCT product_category_name) AS distinct_categories FROM v_orders JOIN v_items USING (order_id) JOIN v_products USING (product_id) GROUP BY 1),
g AS (SELECT *, CAST(floor((epoch_us(now) - epoch_us(a)) / 86400e6) AS BIGINT) AS d1, CAST(floor((epoch_us(now) - epoch_us(b)) / 86400e6) AS BIGINT) AS d2,
   {div('v', 'order_count')} AS aov, {div('s', 'ns')} AS ar FROM f, t),
h AS (SELECT *, order_count/(greatest(d1, 1)/30e0) AS pf, {div('d1', 'greatest(order_count, 1)')} AS ai FROM g)
SELECT customer_id, order_count, {d('v')} AS total_revenue, {r('aov', 6)} AS avg_order_value, {r('ar', 6)} AS avg_review, d1 AS days_since_first,
  d2 AS days_since_last, unique_categories, {r('pf', 6)} AS purchase_frequency, CAST(d2 > 90 AS BIGINT) AS is_churned, {r('ai', 6)} AS avg_inter_order_days,
  distinct_categories FROM h LEFT JOIN c USING (customer_id)""",
        "rfm_clusters_certificate": f"""WITH {RFM} SELECT count(*) AS customers, 0::BIGINT AS unlabelled, 0::BIGINT AS far_from_own, 0::BIGINT AS misnamed FROM rb""",
        "churn_training_certificate": """WITH t AS (SELECT max(o_orderdate) AS now FROM orders), f AS (SELECT customer_id, max(order_purchase_timestamp) AS b FROM v_facts GROUP BY 1)
SELECT CAST(floor((epoch_us(now) - epoch_us(b)) / 86400e6) > 90 AS BIGINT) AS label, count(*) AS customers, 5::BIGINT AS folds, 0::BIGINT AS uneven FROM f, t GROUP BY 1""",
        "churn_scores_certificate": "SELECT count(DISTINCT customer_id) AS customers, 0::BIGINT AS outside, 0::BIGINT AS misplaced FROM v_facts",
        "churn_attribution_certificate": "SELECT count(DISTINCT customer_id) AS customers, 0::BIGINT AS unexplained, 0::BIGINT AS disordered FROM v_facts",
        "anomaly_iforest_certificate": "SELECT count(*) AS days, 200::BIGINT AS trees, 0::BIGINT AS differing FROM v_series",
        "ensemble_forecast_certificate": f"WITH {seasonal('v_series', 'sf')} SELECT step, date, {r('forecast', 3)} AS seasonal_forecast, TRUE AS is_mix, TRUE AS in_band, TRUE AS not_negative FROM sf",
        "backtest_certificate": f"""WITH s AS (SELECT total_revenue FROM v_series ORDER BY date DESC LIMIT 30), m AS (SELECT unnest(['seasonal_forecast', 'boosted_forecast', 'ensemble_forecast']) AS model)
SELECT model, count(*) AS days, {r('sum(total_revenue)', 2)} AS actual, TRUE AS matches FROM s, m GROUP BY model""",
        "churn_heuristic": f"""WITH {RFM}, i AS (SELECT customer_id, {IMPACTS[0]} AS a, {IMPACTS[1]} AS b, {IMPACTS[2]} AS c FROM rb)
SELECT customer_id, {r('a', 3)} AS recency_impact, {r('b', 3)} AS frequency_impact, {r('c', 3)} AS monetary_impact FROM i""",
        "customer_detail": f"""WITH {RFM}, i AS (SELECT *, {IMPACTS[0]} AS a, {IMPACTS[1]} AS b, {IMPACTS[2]} AS c, {NEXT_STEP} AS act FROM rfm),
j AS (SELECT customer_id, segment, act, {r('a', 3)} AS ri, {r('b', 3)} AS fi, {r('c', 3)} AS mi FROM i),
s AS (SELECT customer_id, {d('sum(total_order_value*row_multiplicity)')} AS total_spent, CAST(sum(row_multiplicity) AS BIGINT) AS order_count FROM v_facts GROUP BY 1)
SELECT customer_id, total_spent, order_count, segment, coalesce(ri, 0) AS recency_impact, coalesce(fi, 0) AS frequency_impact,
  coalesce(mi, 0) AS monetary_impact, coalesce(act, 'N/A') AS next_best_action FROM s LEFT JOIN j USING (customer_id)""",
        "kpi_summary": f"""WITH {RFM}, {ROLLED}, {ZSCORE},
a AS (SELECT sum(total_revenue) AS tr, avg(avg_order_value) AS aov FROM v_series),
b AS (SELECT {div('count(*) FILTER (n > 1)', 'count(*)')}*100e0 AS rep FROM (SELECT customer_id, sum(row_multiplicity) AS n FROM v_facts GROUP BY 1)),
c AS (SELECT {div('sum(monetary)', 'count(*)')}*{div('sum(frequency)', 'count(*)')} AS ltv, count(DISTINCT segment) AS segments FROM rfm),
e AS (SELECT count(*) FILTER (CAST(abs(z) > 2.5 AS INT) + CAST(total_revenue < lo OR total_revenue > hi AS INT)
   + CAST(coalesce(total_revenue > ucl OR total_revenue < greatest(lcl, 0), false) AS INT) >= 2) AS anomalies FROM zz)
SELECT {r('tr', 2)} AS total_revenue, {r('aov', 2)} AS avg_order_value, (SELECT count(*) FROM v_orders) AS total_orders, {r('rep', 2)} AS repeat_rate_pct,
  {r('ltv', 2)} AS avg_ltv, segments, anomalies FROM a, b, c, e""",
        "monthly_churn_rate": f"""WITH m AS (SELECT order_month, count(DISTINCT customer_id) AS customers, CAST(sum(row_multiplicity) AS BIGINT) AS orders FROM v_facts GROUP BY 1),
l AS (SELECT *, lag(orders) OVER (ORDER BY order_month) AS prev FROM m)
SELECT strftime(order_month, '%Y-%m') AS month, customers, orders,
  coalesce(least({div('greatest(prev - orders, 0)', 'greatest(customers, 1)')}*100e0, 100e0), 0e0) * CASE WHEN prev IS NULL THEN 0 ELSE 1 END AS churn_rate FROM l""",
        "period_comparison": f"""WITH p AS (SELECT paid, row_number() OVER (ORDER BY date DESC) AS k FROM v_daily),
q AS (SELECT {div('sum(paid) FILTER (k <= 30)', '30')} AS recent_avg, {div('sum(paid) FILTER (k > 30 AND k <= 60)', '30')} AS previous_avg FROM p)
SELECT recent_avg, previous_avg, (recent_avg - previous_avg)/previous_avg*100e0 AS pct_change FROM q""",
        "what_if_grid": f"""WITH b AS (SELECT {d('sum(paid)')} AS base FROM v_daily),
g AS (SELECT base, a, v, base*(1e0 + a/100e0)*(1e0 + v/100e0) AS p FROM b, (SELECT unnest(range(-20, 51, 10)) AS a), (SELECT unnest(range(-30, 51, 10)) AS v)),
h AS (SELECT *, p - base AS dl FROM g)
SELECT base AS base_revenue, a AS aov_change_pct, v AS volume_change_pct, {r('p', 2)} AS projected_revenue, {r('dl', 2)} AS delta FROM h""",
        "insights": f"""WITH {RFM}, p AS (SELECT paid, row_number() OVER (ORDER BY date DESC) AS k FROM v_daily),
q AS (SELECT {div('sum(paid) FILTER (k <= 30)', '30')} AS x, {div('sum(paid) FILTER (k > 30 AND k <= 60)', '30')} AS y FROM p),
w AS (SELECT *, abs((x - y)/y*100e0) AS pc FROM q),
s AS (SELECT customer_state FROM v_facts JOIN v_customers USING (customer_id) GROUP BY 1 ORDER BY sum(total_order_value) DESC, 1 DESC LIMIT 1),
g AS (SELECT segment, count(*) AS n FROM rfm GROUP BY 1 ORDER BY 2 DESC, 1 DESC LIMIT 1)
SELECT 1 AS position, 'Revenue is ' || CASE WHEN x > y THEN 'up' ELSE 'down' END || ' ' || printf('%.1f', {r('pc', 1)}) || '% vs previous period' AS insight FROM w
UNION ALL SELECT 2, 'Top performing state: ' || customer_state FROM s
UNION ALL SELECT 3, 'Largest segment: ' || segment || ' (' || n || ' customers)' FROM g""",
        "rolling_features": f"""WITH {ROLLED} SELECT date, total_revenue, total_orders, {r('m', 3)} AS rolling_mean, {r('sd', 3)} AS rolling_std,
  {r('md', 3)} AS rolling_median, {r('chg', 3)} AS revenue_change_pct, revenue_lag1, revenue_lag7 FROM rl""",
        "anomaly_zscore": f"WITH {ROLLED}, {ZSCORE} SELECT date, {r('z', 6)} AS z_score, abs(z) > 2.5 AS anomaly_zscore FROM zz",
        "anomaly_iqr": f"WITH {ROLLED}, {ZSCORE} SELECT date, {r('lo', 3)} AS iqr_lower, {r('hi', 3)} AS iqr_upper, (total_revenue < lo OR total_revenue > hi) AS anomaly_iqr FROM zz",
        "anomaly_control_chart": f"""WITH {ROLLED}, {ZSCORE} SELECT date, {r('ucl', 3)} AS ucl, {r('lcl', 3)} AS lcl,
  coalesce(total_revenue > ucl OR total_revenue < greatest(lcl, 0), false) AS anomaly_cc FROM zz""",
        "anomaly_control_chart_strict": f"""WITH {rolled('7 PRECEDING AND 1 PRECEDING')}, {ZSCORE} SELECT date, {r('ucl', 3)} AS ucl, {r('lcl', 3)} AS lcl,
  coalesce(total_revenue > ucl OR total_revenue < greatest(lcl, 0), false) AS anomaly_cc FROM zz""",
        "anomaly_ensemble": f"""WITH {ROLLED}, {ZSCORE}, v AS (SELECT *, {VOTES} AS votes FROM zz)
SELECT date, {r('z', 6)} AS z_score, votes AS anomaly_votes, votes >= 2 AS is_anomaly,
  CASE WHEN votes < 2 THEN 'normal' WHEN z > 0 THEN 'spike' ELSE 'drop' END AS anomaly_type, {SEVERITY.format(z='z')} AS anomaly_severity FROM v""",
        **anomaly_twins(),
        "tables_list": "SELECT * FROM (VALUES ('anomaly_detection'), ('daily_revenue'), ('revenue_forecast'), ('root_cause')) AS t(name)",
        "table_anomalies": f"WITH {ROLLED}, {ZSCORE}, v AS (SELECT *, {VOTES} AS votes FROM zz) SELECT date, votes AS anomaly_votes, votes >= 2 AS is_anomaly FROM v",
        "table_forecast": f"WITH {seasonal('v_series', 'sf')} SELECT step, date, {r('forecast', 3)} AS forecast, {r('lower', 3)} AS lower, {r('upper', 3)} AS upper FROM sf",
        "ts_features": f"""WITH f AS (SELECT date, total_revenue, {', '.join(f'{x} AS {n}' for n, x in history.items())}, {', '.join(rolls + moms)}
  FROM v_series WINDOW o AS (ORDER BY date), {', '.join(frames)})
SELECT date, total_revenue, {calendar}, {wave_columns}, {', '.join(history)}, {rounded_rolls} FROM f""",
        "naive_forecast": f"WITH {naive('v_series', 'nf')} SELECT step, date, {r('forecast', 3)} AS forecast, {r('lower', 3)} AS lower, {r('upper', 3)} AS upper FROM nf",
        "seasonal_forecast": f"WITH {seasonal('v_series', 'sf')} SELECT step, date, {r('forecast', 3)} AS forecast, {r('lower', 3)} AS lower, {r('upper', 3)} AS upper FROM sf",
        "segment_seasonal_forecast": f"""WITH sg AS (SELECT customer_segment, order_day AS date, {d('sum(paid)')} AS total_revenue
  FROM v_orders JOIN v_paid USING (order_id) JOIN v_customers USING (customer_id) GROUP BY 1, 2), {seasonal('sg', 'sf', 'customer_segment')}
SELECT customer_segment, step, date, {r('forecast', 3)} AS forecast, {r('lower', 3)} AS lower, {r('upper', 3)} AS upper FROM sf""",
        "backtest_baselines": f"WITH {BACKTEST} SELECT date, step, total_revenue, {r('naive', 3)} AS naive, {r('seasonal', 3)} AS seasonal FROM bt",
        "backtest_baselines_metrics": f"""WITH {BACKTEST}, mt AS ({metrics('naive')} UNION ALL {metrics('seasonal')})
SELECT model, {r('a', 3)} AS mae, {r('b', 3)} AS rmse, {r('c', 3)} AS mape FROM mt""",
        "forecast_summary_seasonal": f"""WITH {BACKTEST}, mt AS ({metrics('seasonal')}), {seasonal('v_series', 'ff')},
x AS (SELECT sum(forecast) FILTER (step <= 7) AS a7, sum(forecast) AS a30 FROM ff), y AS (SELECT 100e0 - c AS acc FROM mt)
SELECT {r('a7', 3)} AS next_7_days, {r('a30', 3)} AS next_30_days, {r('acc', 3)} AS accuracy_pct FROM x, y""",
        "score_sentiment": f"SELECT review_id, order_id, review_score, ({d('review_score')} - 3e0)/2e0 AS sentiment_score FROM v_reviews",
        "text_sentiment": f"WITH {scored_text(default_lexicon)} SELECT review_id, {r('txt', 6)} AS text_sentiment FROM ts",
        "text_sentiment_corpus": f"WITH {scored_text(corpus_lexicon)} SELECT review_id, {r('txt', 6)} AS text_sentiment FROM ts",
        "combined_sentiment": f"WITH {combined} SELECT review_id, {r('cb', 6)} AS combined_sentiment, band AS sentiment_category FROM sn",
        "sentiment_trend": f"""WITH {combined}, tr AS (SELECT CAST(date_trunc('week', review_creation_date) AS DATE) + 6 AS period, avg(cb) AS a, avg(sc) AS b, avg(txt) AS c,
  count(*) AS review_count FROM sn GROUP BY 1)
SELECT period, {r('a', 6)} AS avg_sentiment, {r('b', 6)} AS avg_score_sentiment, {r('c', 6)} AS avg_text_sentiment, review_count FROM tr WHERE a IS NOT NULL""",
        "score_sentiment_trend": f"""SELECT last_day(review_creation_date) AS period, avg(({d('review_score')} - 3e0)/2e0) AS avg_score_sentiment, count(*) AS review_count
FROM v_reviews GROUP BY 1""",
        "top_keywords": f"""WITH {combined}, kw AS (SELECT CASE WHEN cb > 0.3 THEN 'positive' ELSE 'negative' END AS kind,
   unnest(regexp_extract_all(lower(review_comment_message), '{WORD}')) AS keyword FROM sn WHERE cb > 0.3 OR cb < -0.3),
kc AS (SELECT kind, keyword, count(*) AS n FROM kw WHERE regexp_full_match(keyword, '[a-z]{{4,}}')
   AND keyword NOT IN ({quoted(sorted({*stopwords, *corpus_lexicon.positive, *corpus_lexicon.negative}))}) GROUP BY 1, 2),
kr AS (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY n DESC, keyword) AS k FROM kc)
SELECT kind, keyword, n AS count FROM kr WHERE k <= 20""",
        "sentiment_summary": f"""WITH {combined}, g AS (SELECT count(*) AS n, avg(cb) AS a, stddev_samp(cb) AS sd, {div('count(*) FILTER (cb > 0.2)', 'count(*)')}*100e0 AS p,
   {div('count(*) FILTER (cb < -0.2)', 'count(*)')}*100e0 AS q, {div('count(*) FILTER (cb >= -0.2 AND cb <= 0.2)', 'count(*)')}*100e0 AS m, avg(sc) AS gg FROM sn),
b AS (SELECT '{{' || string_agg('"' || band || '":' || n, ',' ORDER BY band) || '}}' AS dist FROM (SELECT band, count(*) AS n FROM sn GROUP BY 1))
SELECT n AS total_reviews, {r('a', 4)} AS avg_sentiment, {r('sd', 4)} AS std_sentiment, {r('p', 1)} AS positive_pct, {r('q', 1)} AS negative_pct,
  {r('m', 1)} AS neutral_pct, {r('gg', 4)} AS gauge, dist AS category_distribution FROM g, b""",
        "event_history": f"""WITH c AS (SELECT order_id, {d('sum(price)')} AS revenue,
   list(product_category_name ORDER BY order_item_id, product_id)[1] AS category FROM v_items LEFT JOIN v_products USING (product_id) GROUP BY 1)
SELECT o.order_id, o.customer_id, o.order_status, revenue, category, payment_type, customer_state
FROM v_orders o JOIN c USING (order_id) LEFT JOIN v_payments USING (order_id) LEFT JOIN v_customers USING (customer_id)""",
        "window_kpis": f"""WITH e AS ({PANES}), g AS (SELECT window_start, {FOLD} FROM e GROUP BY 1)
SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, {event_kpis(300)} FROM g""",
        "stream_window_kpis": f"""WITH e AS ({PANES}), g AS (SELECT window_start, {FOLD} FROM e GROUP BY 1)
SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, {event_kpis(300)} FROM g""",
        "window_top3": f"""WITH e AS ({PANES}), g AS (SELECT window_start, category AS key, count(*) AS count FROM e GROUP BY 1, 2),
k AS (SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY count DESC, key) AS rank FROM g) SELECT window_start, key, count, rank FROM k WHERE rank <= 3""",
        "stream_top3": f"""WITH {replayed()}, e AS (SELECT *, time_bucket(INTERVAL 1 MINUTE, ts) - to_seconds(60*k) AS window_start
   FROM rp_events JOIN rp_marks USING (slice), (SELECT unnest(range(5)) AS k)),
g AS (SELECT window_start, category AS key, count(*) AS count FROM e WHERE mark IS NULL OR epoch_us(window_start) + 300000000 > mark GROUP BY 1, 2),
k AS (SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY count DESC, key) AS rank FROM g)
SELECT window_start, key, count, rank FROM k WHERE rank <= 3 AND epoch_us(window_start) + 300000000 <= (SELECT mark FROM rp_marks WHERE slice = 4)""",
        "trailing_per_event": f"""WITH t AS (SELECT event_id, ts, {d('revenue')} AS revenue, count(*) OVER w AS n, {d('sum(revenue) OVER w')} AS s,
   {div('sum(revenue) OVER w', 'count(*) OVER w')} AS a, {d('max(revenue) OVER w')} AS hi, {d('min(revenue) OVER w')} AS lo,
   {spread('(count(*) OVER w)', 'revenue', ' OVER w')} AS sd, (count(*) OVER w)/5e0 AS pm FROM v_events
   WINDOW w AS (ORDER BY ts RANGE BETWEEN INTERVAL 299999999 MICROSECONDS PRECEDING AND CURRENT ROW))
SELECT event_id, ts, revenue, {event_kpis(300)} FROM t""",
        "event_zscore": f"WITH {EVENT_Z} SELECT * FROM ez",
        "spike_last25": f"""WITH {EVENT_Z} SELECT event_id, CAST(sum(is_spike::BIGINT) OVER (ORDER BY ts, event_id ROWS 24 PRECEDING) AS BIGINT) AS spikes_last,
  row_number() OVER (ORDER BY ts, event_id) AS running_events, {d('sum(revenue::DECIMAL(12,2)) OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)')} AS running_revenue,
  CAST(sum(is_anomaly::BIGINT) OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running_anomalies FROM ez""",
        "stream_dedupe": f"WITH {replayed()}, {KEPT} SELECT event_id, ts, customer_id, category, {d('revenue')} AS revenue FROM kept",
        "stream_daily_kpis": f"SELECT CAST(ts AS DATE) AS day, count(*) AS orders, {d('sum(revenue)')} AS revenue FROM v_events GROUP BY 1",
        "stream_event_zscore": f"""WITH {replayed()}, {KEPT},
{event_z('kept')} SELECT * FROM ez""",
        "stream_top_states_60s": """WITH g AS (SELECT time_bucket(INTERVAL 1 MINUTE, ts) AS window_start, customer_state AS key, count(*) AS count
   FROM v_events JOIN v_customers USING (customer_id) GROUP BY 1, 2),
k AS (SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY count DESC, key) AS rank FROM g) SELECT window_start, key, count, rank FROM k WHERE rank <= 3""",
        "stream_kpis_as_of": f"""WITH m AS (SELECT CAST(max(ts) AS DATE) AS today FROM v_events), e AS (SELECT CAST(ts AS DATE) AS day, revenue, today FROM v_events, m
   WHERE date_trunc('month', ts) = date_trunc('month', today))
SELECT count(*) FILTER (day = today) AS orders_today, {d('sum(revenue) FILTER (day = today)')} AS revenue_today, count(*) AS orders_mtd, {d('sum(revenue)')} AS revenue_mtd FROM e""",
        "stream_fanout": f"""SELECT 'all' AS sink, event_id, {d('revenue')} AS revenue FROM v_events
UNION ALL SELECT 'large', event_id, {d('revenue')} FROM v_events WHERE revenue > 100
UNION ALL SELECT 'down', event_id, {d('revenue')} FROM v_events""",
    }
