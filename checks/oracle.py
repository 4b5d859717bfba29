"""DuckDB SQL for every named query, written independently of the Spark plans.

Tables region, nation, customer, supplier, part, orders, lineitem, events ...
are registered as views.  Where the Spark view uses a rewrite (telescoped gaps,
array month counts, equi-join pair counting), the SQL follows the plain
definition instead (lead() gaps, densified series with row numbers, set
intersections), so agreement checks the rewrite too.
"""

from __future__ import annotations

# Fixed parameters, equal to tillroll.catalog.
RETENTION_AS_OF = "2001-05-01"
AS_OF = "2001-08-01"
YEAR_START = "1995-01-01"

ORDER_LINES = """
ol AS (
  SELECT '#' || CAST(o.o_orderkey AS VARCHAR) AS order_id,
         'cust' || CAST(o.o_custkey AS VARCHAR) || '@example.com' AS email,
         CASE WHEN o.o_orderpriority = '4-NOT SPECIFIED' THEN ''
              WHEN o.o_orderstatus = 'O' THEN 'unfulfilled'
              WHEN o.o_orderstatus = 'F' THEN 'fulfilled' ELSE 'partial' END AS status,
         CAST(o.o_orderdate AS DATE) AS d,
         CAST((o.o_orderkey * 37) % 24 AS INTEGER) AS h,
         strftime(CAST(o.o_orderdate AS DATE), '%Y-%m-%d') || ' '
           || lpad(CAST((o.o_orderkey * 37) % 24 AS VARCHAR), 2, '0') || ':00:00 -0500' AS created_at,
         CAST(l.l_quantity AS INTEGER) AS qty,
         p.p_name AS product,
         CAST(p.p_retailprice AS DECIMAL(12,2)) AS price,
         'sku' || CAST(p.p_partkey AS VARCHAR) AS sku
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
                  JOIN part p ON l.l_partkey = p.p_partkey)"""

CUSTOMERS = """
cx AS (
  SELECT c.c_mktsegment || ' ' || c.c_name AS name,
         n.n_name || ' ' || CAST(c.c_nationkey AS VARCHAR) || ' ' || r.r_name AS location,
         CAST(CAST(c.c_acctbal AS DECIMAL(12,2)) AS VARCHAR) AS attr12,
         'cust' || CAST(c.c_custkey AS VARCHAR) || '@example.com' AS email
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
                  JOIN region r ON n.n_regionkey = r.r_regionkey)"""

SEGMENTS = """
seg AS (
  SELECT 'cust' || CAST(c_custkey AS VARCHAR) || '@example.com' AS email, c_mktsegment AS segment
  FROM customer)"""

SCORES = """
sc AS (
  SELECT 'cust' || CAST(c_custkey AS VARCHAR) || '@example.com' AS email,
         CAST(c_nationkey AS VARCHAR) || '|' || c_mktsegment AS scores,
         CAST(c_nationkey AS VARCHAR) AS first_score
  FROM customer)"""

EVENTS = """
ev AS (
  SELECT '#' || CAST(event_id AS VARCHAR) AS order_id,
         'user' || CAST(user_id AS VARCHAR) AS email,
         CAST(ts AS DATE) AS d, CAST(hour(ts) AS INTEGER) AS h
  FROM events)"""

WEEK = "(d - CAST((isodow(d) + 3) % 7 AS INTEGER))"
MONTH = "CAST(date_trunc('month', d) AS DATE)"

DOW_NAMES = ["sunday", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday"]
SLOTS = list(range(0, 24, 2))


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


def _habit_counts(dow: str = "dow", slot: str = "slot") -> str:
    parts = [f"COUNT(*) FILTER (WHERE {dow} = {i}) AS {n}" for i, n in enumerate(DOW_NAMES)]
    parts += [f"COUNT(*) FILTER (WHERE {slot} = {s}) AS h{s:02d}" for s in SLOTS]
    return ", ".join(parts)


HABIT_COLS = ", ".join(DOW_NAMES + [f"h{s:02d}" for s in SLOTS])


def _pairs_sql(monthly: bool) -> str:
    key = ", " + MONTH + " AS month" if monthly else ""
    grp = ", month" if monthly else ""
    on = " AND a.month = b.month" if monthly else ""
    sel = "a.month, " if monthly else ""
    return _with(ORDER_LINES, f"""
ps AS (SELECT product{grp}, list(DISTINCT order_id) AS orders
       FROM (SELECT order_id, product{key} FROM ol) GROUP BY product{grp})""") + f"""
SELECT {sel}a.product AS product_1, b.product AS product_2,
       CAST(len(list_intersect(a.orders, b.orders)) AS BIGINT) AS n_orders
FROM ps a JOIN ps b ON a.product < b.product{on}
WHERE len(list_intersect(a.orders, b.orders)) > 0"""


def _gap_sql(src_cte: str, src: str) -> str:
    return _with(src_cte, f"""
pd AS (SELECT DISTINCT email, d FROM {src}),
g AS (SELECT email, d, lead(d) OVER (PARTITION BY email ORDER BY d) AS nd FROM pd)""") + """
SELECT email, COUNT(*) AS n_dates,
       CAST(SUM(COALESCE(date_diff('day', d, nd), 0)) AS DOUBLE) / COUNT(*) AS avg_gap
FROM g GROUP BY email"""


def _habits_sql(src_cte: str, src: str) -> str:
    return _with(src_cte, f"""
st AS (SELECT DISTINCT order_id, email, dayofweek(d) AS dow, (h // 2) * 2 AS slot FROM {src})""") + f"""
SELECT email, {_habit_counts()} FROM st GROUP BY email"""


RETENTION = _with(ORDER_LINES, f"""
act AS (SELECT DISTINCT email, {MONTH} AS m FROM ol WHERE d <= DATE '{RETENTION_AS_OF}'),
r30 AS (SELECT email FROM act WHERE m >= DATE '{RETENTION_AS_OF}' - 30 GROUP BY email HAVING COUNT(*) > 1),
r20 AS (SELECT DISTINCT email FROM act WHERE m >= DATE '{RETENTION_AS_OF}' - 20),
r365 AS (SELECT DISTINCT email FROM act WHERE m >= DATE '{RETENTION_AS_OF}' - 365),
c AS (SELECT (SELECT COUNT(*) FROM r30) AS n_repeat_30, (SELECT COUNT(*) FROM r20) AS n_active_20,
             (SELECT COUNT(*) FROM r365) AS n_active_365)""") + """
SELECT n_repeat_30, n_active_20, n_active_365,
       CASE WHEN n_active_365 = 0 THEN NULL ELSE CAST(n_repeat_30 AS DOUBLE) / n_active_365 END AS ratio_30,
       CASE WHEN n_active_365 = 0 THEN NULL ELSE CAST(n_active_20 AS DOUBLE) / n_active_365 END AS ratio_20
FROM c"""

HISTOGRAM = _with(ORDER_LINES, """
pd AS (SELECT DISTINCT email, d FROM ol),
g AS (SELECT email, d, lead(d) OVER (PARTITION BY email ORDER BY d) AS nd FROM pd),
a AS (SELECT CAST(SUM(COALESCE(date_diff('day', d, nd), 0)) AS DOUBLE) / COUNT(*) AS v
      FROM g GROUP BY email),
r(i, range_label, lo, hi, incl) AS (VALUES
  (0, '0 to 4', 0, 4, false), (1, '4 to 7', 4, 7, true), (2, '7 to 15', 7, 15, true),
  (3, '15 to 30', 15, 30, true), (4, '30 to 60', 30, 60, true), (5, '60 to 100', 60, 100, true),
  (6, '100+', 100, NULL, true))""") + """
SELECT r.range_label, COUNT(a.v) AS n_customers
FROM r LEFT JOIN a ON a.v <> 0 AND (CASE WHEN r.incl THEN a.v >= r.lo ELSE a.v > r.lo END)
                   AND (r.hi IS NULL OR a.v < r.hi)
GROUP BY r.i, r.range_label"""

RECENCY = _with(ORDER_LINES) + f"""
SELECT email,
       CAST(date_diff('day', MIN(d), DATE '{AS_OF}') AS INTEGER) AS days_since_first_order,
       CAST(date_diff('day', MAX(d), DATE '{AS_OF}') AS INTEGER) AS days_since_last_order
FROM ol GROUP BY email"""

VALUE_SEGMENT = _with(ORDER_LINES, CUSTOMERS, SEGMENTS, """
v AS (SELECT email, CAST(SUM(qty * price) AS DOUBLE) AS revenue, COUNT(DISTINCT order_id) AS n
      FROM ol GROUP BY email)""") + """
SELECT v.email, v.revenue, v.revenue / v.n AS basket_value, seg.segment, cx.name, cx.location, cx.attr12
FROM v JOIN cx ON v.email = cx.email LEFT JOIN seg ON v.email = seg.email"""

_KNOWN = "(SELECT COUNT(DISTINCT email) FROM ol WHERE email IN (SELECT email FROM cx))"

GLOBAL_AVERAGES = _with(ORDER_LINES, CUSTOMERS) + f"""
SELECT CAST(SUM(qty * price) AS DOUBLE) / {_KNOWN} AS avg_revenue,
       CAST(SUM(qty) AS DOUBLE) / {_KNOWN} AS avg_quantity
FROM ol"""

POPULATION_AVERAGES = _with(ORDER_LINES, """
dl AS (SELECT DISTINCT order_id, email, created_at, qty, price FROM ol)""") + """
SELECT CAST(SUM(qty) AS DOUBLE) / COUNT(DISTINCT email) AS avg_quantity,
       CAST(SUM(qty * price) AS DOUBLE) / COUNT(DISTINCT email) AS avg_revenue
FROM dl"""

SCORE_ATTACH = _with(ORDER_LINES, CUSTOMERS, SCORES) + """
SELECT k.email, sc.scores
FROM (SELECT DISTINCT email FROM ol WHERE email IN (SELECT email FROM cx)) k
JOIN sc ON k.email = sc.email"""

CALENDAR = _with(ORDER_LINES, """
o AS (SELECT DISTINCT order_id, d, h FROM ol)""") + f"""
SELECT order_id, d AS order_date, {MONTH} AS month, strftime(d, '%Y-%m') AS year_month,
       {WEEK} AS week, dayname(d) AS weekday, h AS hour, CAST((h // 2) * 2 AS INTEGER) AS slot,
       CAST(date_diff('day', d, DATE '{AS_OF}') AS INTEGER) AS days_to_as_of
FROM o"""

LABELS = _with(CUSTOMERS, SCORES) + """
SELECT cx.email, cx.name, cx.location, upper(cx.name) AS name_upper,
       CAST(len(string_split(sc.scores, '|')) AS INTEGER) AS n_scores, sc.first_score
FROM cx JOIN sc ON cx.email = sc.email"""

PROFILE = _with(ORDER_LINES, CUSTOMERS, SEGMENTS, SCORES, """
v AS (SELECT email, CAST(SUM(qty * price) AS DOUBLE) AS revenue, COUNT(DISTINCT order_id) AS n
      FROM ol GROUP BY email),
pd AS (SELECT DISTINCT email, d FROM ol),
g AS (SELECT email, d, lead(d) OVER (PARTITION BY email ORDER BY d) AS nd FROM pd),
gap AS (SELECT email, COUNT(*) AS n_dates,
               CAST(SUM(COALESCE(date_diff('day', d, nd), 0)) AS DOUBLE) / COUNT(*) AS avg_gap,
               MIN(d) AS first_d, MAX(d) AS last_d
        FROM g GROUP BY email),
st AS (SELECT DISTINCT order_id, email, dayofweek(d) AS dow, (h // 2) * 2 AS slot FROM ol),
hb AS (SELECT email, """ + _habit_counts() + """ FROM st GROUP BY email),
tot AS (SELECT CAST(SUM(qty * price) AS DOUBLE) AS rev, CAST(SUM(qty) AS DOUBLE) AS q FROM ol),
k AS (SELECT COUNT(DISTINCT v.email) AS n FROM v JOIN cx ON v.email = cx.email)""") + f"""
SELECT cx.name, v.revenue, v.revenue / v.n AS basket_value, seg.segment, cx.location, cx.attr12,
       gap.n_dates, gap.avg_gap, v.email,
       CAST(date_diff('day', gap.first_d, DATE '{AS_OF}') AS INTEGER) AS days_since_first_order,
       CAST(date_diff('day', gap.last_d, DATE '{AS_OF}') AS INTEGER) AS days_since_last_order,
       {", ".join("hb." + c for c in HABIT_COLS.split(", "))},
       tot.rev / k.n AS avg_revenue, tot.q / k.n AS avg_quantity, sc.scores
FROM v JOIN cx ON v.email = cx.email LEFT JOIN seg ON v.email = seg.email
     JOIN gap ON v.email = gap.email JOIN hb ON v.email = hb.email
     JOIN sc ON v.email = sc.email CROSS JOIN tot CROSS JOIN k"""

_WEEKLY_CTES = """
dl AS (SELECT DISTINCT order_id, email, created_at, qty, price, d, h FROM ol),
vis AS (SELECT email, created_at, d, h, SUM(qty * price) AS rev FROM dl GROUP BY email, created_at, d, h),
wk AS (SELECT email, """ + WEEK + """ AS week, COUNT(*) AS n_visits, SUM(rev) AS rev,
              """ + _habit_counts("dayofweek(d)", "((h // 2) * 2)") + """
       FROM vis GROUP BY email, """ + WEEK + ")"

WEEKLY_VISITS = _with(ORDER_LINES, _WEEKLY_CTES) + "SELECT email, week, n_visits FROM wk"

WEEKLY_BASKET = _with(ORDER_LINES, _WEEKLY_CTES) + """
SELECT email, week, CAST(rev AS DOUBLE) AS revenue, CAST(rev AS DOUBLE) / n_visits AS basket_value FROM wk"""

WEEK_PROFILE = _with(ORDER_LINES, CUSTOMERS, _WEEKLY_CTES, """
pop AS (SELECT CAST(SUM(qty) AS DOUBLE) / COUNT(DISTINCT email) AS avg_quantity,
               CAST(SUM(qty * price) AS DOUBLE) / COUNT(DISTINCT email) AS avg_revenue FROM dl)""") + f"""
SELECT cx.name, cx.location, cx.attr12, wk.email, wk.week, wk.n_visits,
       CAST(wk.rev AS DOUBLE) AS revenue, CAST(wk.rev AS DOUBLE) / wk.n_visits AS basket_value,
       {", ".join("wk." + c for c in HABIT_COLS.split(", "))},
       pop.avg_quantity, pop.avg_revenue
FROM cx JOIN wk ON cx.email = wk.email CROSS JOIN pop"""

_PRODUCT_CTES = """
pl AS (SELECT DISTINCT upper(product) AS product, upper(sku) AS sku, d, qty * price AS rev FROM ol),
mon AS (SELECT product, sku, """ + MONTH + """ AS month, SUM(rev) AS revenue FROM pl GROUP BY ALL),
months AS (SELECT month, row_number() OVER (ORDER BY month) AS i, COUNT(*) OVER () AS nm
           FROM (SELECT DISTINCT month FROM mon)),
prods AS (SELECT DISTINCT product, sku FROM mon),
dense AS (SELECT p.product, p.sku, m.month, m.i, m.nm,
                 CASE WHEN mon.revenue > 0 THEN mon.revenue ELSE 0 END AS revenue
          FROM prods p CROSS JOIN months m
          LEFT JOIN mon ON mon.product = p.product AND mon.sku = p.sku AND mon.month = m.month),
fp AS (SELECT product, sku, MIN(i) AS t FROM dense WHERE revenue > 0 GROUP BY product, sku),
growth AS (
  SELECT p.product, p.sku,
         round(CASE WHEN fp.t IS NULL THEN NULL
                    ELSE (pow(CAST(tot.total AS DOUBLE) / CAST(b.revenue AS DOUBLE),
                              CAST(1 AS DOUBLE) / (b.nm - fp.t + 1)) - 1) * 100 END, 6) AS cmgr,
         CAST(CASE WHEN fp.t IS NULL THEN 1 ELSE b.nm - fp.t + 1 END AS INTEGER) AS n_periods
  FROM prods p
  JOIN (SELECT product, sku, SUM(revenue) AS total FROM mon GROUP BY ALL) tot
    ON tot.product = p.product AND tot.sku = p.sku
  LEFT JOIN fp ON fp.product = p.product AND fp.sku = p.sku
  LEFT JOIN dense b ON b.product = p.product AND b.sku = p.sku AND b.i = fp.t)"""

PRODUCT_MONTH = _with(ORDER_LINES, _PRODUCT_CTES) + """
SELECT product, sku, month, CAST(revenue AS DOUBLE) AS revenue FROM mon"""

PRODUCT_DENSE = _with(ORDER_LINES, _PRODUCT_CTES) + """
SELECT product, sku, month, CAST(revenue AS DOUBLE) AS revenue FROM dense"""

PRODUCT_CMGR = _with(ORDER_LINES, _PRODUCT_CTES) + "SELECT product, sku, cmgr, n_periods FROM growth"

PRODUCT_SERIES = _with(ORDER_LINES, _PRODUCT_CTES) + """
SELECT product, sku, string_agg(CAST(revenue AS VARCHAR), ',' ORDER BY month) AS series
FROM dense GROUP BY product, sku"""

PRODUCT_WEEK = _with(ORDER_LINES, _PRODUCT_CTES, """
wk AS (SELECT product, sku, """ + WEEK + """ AS week, SUM(rev) AS revenue FROM pl GROUP BY ALL),
t AS (SELECT CAST(SUM(revenue) AS DOUBLE) AS total, COUNT(*) AS n FROM wk)""") + """
SELECT wk.product, wk.sku, wk.week, CAST(wk.revenue AS DOUBLE) AS revenue, growth.cmgr, growth.n_periods,
       CAST(wk.revenue AS DOUBLE) * 100 / t.total AS pct_total, t.total / t.n AS avg_revenue
FROM wk LEFT JOIN growth ON wk.product = growth.product AND wk.sku = growth.sku CROSS JOIN t"""

UNFULFILLED_DAY = _with(ORDER_LINES, f"""
s AS (SELECT DISTINCT order_id, status, d FROM ol WHERE status <> '' AND d > DATE '{AS_OF}' - 300)""") + """
SELECT d AS order_date,
       CAST(COUNT(*) FILTER (WHERE status = 'unfulfilled') AS DOUBLE) / COUNT(*) AS unfulfilled_ratio
FROM s GROUP BY d"""

UNFULFILLED_MONTH = _with(ORDER_LINES, f"""
s AS (SELECT DISTINCT order_id, status, d FROM ol
      WHERE status <> '' AND d BETWEEN DATE '{YEAR_START}' AND DATE '{AS_OF}')""") + """
SELECT strftime(d, '%Y-%m') AS month,
       CAST(COUNT(*) FILTER (WHERE status = 'unfulfilled') AS DOUBLE) / COUNT(*) AS unfulfilled_ratio
FROM s GROUP BY strftime(d, '%Y-%m')"""

SALES = """
sales AS (SELECT l_partkey, CAST(l_quantity AS INTEGER) AS qty, CAST(l_shipdate AS DATE) AS day,
                 CAST(l_extendedprice AS DECIMAL(12,2)) AS rev,
                 CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)) AS gp
          FROM lineitem)"""

REVENUE_BY_TYPE = _with(SALES, """
cells AS (SELECT p_type AS type, CAST(date_trunc('month', day) AS DATE) AS month,
                 SUM(rev) AS revenue, SUM(gp) AS gross_profit
          FROM sales JOIN part ON l_partkey = p_partkey GROUP BY ALL),
months AS (SELECT DISTINCT month FROM cells),
types AS (SELECT DISTINCT type FROM cells)""") + """
SELECT m.month, CAST(COALESCE(c.revenue, 0) AS DOUBLE) AS revenue,
       CAST(COALESCE(c.gross_profit, 0) AS DOUBLE) AS gross_profit, t.type
FROM types t CROSS JOIN months m LEFT JOIN cells c ON c.type = t.type AND c.month = m.month"""

DAILY_SUMMARY = _with(SALES) + """
SELECT day AS date, CAST(SUM(rev) AS DOUBLE) AS revenue, CAST(SUM(rev) - SUM(gp) AS DOUBLE) AS cost_of_goods,
       CAST(SUM(gp) AS DOUBLE) AS gross_profit,
       CAST(SUM(gp) AS DOUBLE) * 100 / CAST(SUM(rev) AS DOUBLE) AS margin
FROM sales GROUP BY day"""

GROWTH_REPORT = _with(SALES, """
cells AS (SELECT l_partkey AS partkey, CAST(date_trunc('month', day) AS DATE) AS month, SUM(rev) AS revenue
          FROM sales GROUP BY ALL),
months AS (SELECT month, row_number() OVER (ORDER BY month) AS i, COUNT(*) OVER () AS nm
           FROM (SELECT DISTINCT month FROM cells)),
fp AS (SELECT c.partkey, MIN(m.i) AS t FROM cells c JOIN months m ON c.month = m.month
       WHERE c.revenue <> 0 GROUP BY c.partkey),
base AS (SELECT fp.partkey, fp.t, m.nm, c.revenue AS b FROM fp JOIN months m ON m.i = fp.t
         JOIN cells c ON c.partkey = fp.partkey AND c.month = m.month),
tot AS (SELECT l_partkey AS partkey, SUM(rev) AS revenue, SUM(gp) AS gp FROM sales GROUP BY ALL),
g AS (SELECT CAST(SUM(revenue) AS DOUBLE) AS tr, CAST(SUM(gp) AS DOUBLE) AS tg, COUNT(*) AS n FROM tot),
rows AS (
  SELECT p.p_name AS label_0, 'sku' || CAST(tot.partkey AS VARCHAR) AS label_3, p.p_brand AS label_5,
         CAST(tot.revenue AS DOUBLE) AS revenue, CAST(tot.gp AS DOUBLE) AS gross_profit,
         round((pow(CAST(tot.revenue AS DOUBLE) / CAST(base.b AS DOUBLE),
                    CAST(1 AS DOUBLE) / (base.nm - base.t + 1)) - 1) * 100, 6) AS cmgr,
         CAST(base.nm - base.t + 1 AS INTEGER) AS n_periods
  FROM tot JOIN base ON tot.partkey = base.partkey JOIN part p ON p.p_partkey = tot.partkey)""") + """
SELECT label_0, label_3, label_5, revenue, gross_profit, cmgr, n_periods,
       revenue * 100 / g.tr AS pct_revenue, g.tr / g.n AS avg_revenue, g.tg / g.n AS avg_gross_profit,
       (revenue - g.tr / g.n) * 100 / (g.tr / g.n) AS pct_dev_from_avg,
       gross_profit * 100 / g.tg AS pct_gross_profit
FROM rows CROSS JOIN g"""

CSV_ORDER_LINES = _with(ORDER_LINES) + """
SELECT order_id, email, status, created_at, CAST(qty AS DOUBLE) AS qty, product, CAST(price AS DOUBLE) AS price, sku FROM ol"""

EXPORT_FILES = _with(ORDER_LINES) + """
SELECT order_id, email, status, created_at, CAST(qty AS DOUBLE) AS qty, 'Café ' || product AS product,
       CAST(price AS DOUBLE) AS price, sku FROM ol"""



def _gap_rows_sql(src_cte: str, src: str) -> str:
    return _with(src_cte, f"""
pd AS (SELECT DISTINCT email, d FROM {src}),
g AS (SELECT email, d, lead(d) OVER (PARTITION BY email ORDER BY d) AS nd FROM pd)""") + """
SELECT email, d AS order_date, nd AS next_date, CAST(COALESCE(date_diff('day', d, nd), 0) AS INTEGER) AS days FROM g"""


SHARED_ORDERS = _with(ORDER_LINES, """
ps AS (SELECT product, list(DISTINCT order_id) AS orders FROM ol GROUP BY product)""") + """
SELECT a.product AS product_1, b.product AS product_2, CAST(len(list_intersect(a.orders, b.orders)) AS BIGINT) AS n_orders
FROM ps a JOIN ps b ON a.product < b.product AND split_part(a.product, ' ', -1) = split_part(b.product, ' ', -1)"""

EXPORT_REJECTS = _with(ORDER_LINES) + """
SELECT CASE CAST(substr(order_id, 2) AS BIGINT) % 20 WHEN 1 THEN 'qty' WHEN 2 THEN 'price' WHEN 3 THEN 'created_at' ELSE 'kept' END AS reason,
       COUNT(*) AS n_lines, COUNT(DISTINCT order_id) AS n_orders
FROM ol GROUP BY 1"""

STORED_VIEWS = f"""
WITH gaps AS ({_gap_sql(ORDER_LINES, "ol")}),
rec AS ({RECENCY}),
habits AS ({_habits_sql(ORDER_LINES, "ol")})
SELECT email, n_dates, avg_gap, days_since_first_order, days_since_last_order, sunday, h00
FROM gaps JOIN rec USING (email) JOIN habits USING (email)"""

CUSTOMER_FILES = _with(CUSTOMERS, SEGMENTS, SCORES) + """
SELECT email, name, '12 "Old", ' || location AS location, attr12, segment, scores FROM cx LEFT JOIN seg USING (email) LEFT JOIN sc USING (email)"""

ORACLE_SQL: dict[str, str] = {
    "bought_together": _pairs_sql(False),
    "bought_together_monthly": _pairs_sql(True),
    "customer_retention": RETENTION,
    "order_gap": _gap_sql(ORDER_LINES, "ol"),
    "order_gap_events": _gap_sql(EVENTS, "ev"),
    "order_frequency_histogram": HISTOGRAM,
    "recency": RECENCY,
    "day_hour_profile": _habits_sql(ORDER_LINES, "ol"),
    "day_hour_profile_events": _habits_sql(EVENTS, "ev"),
    "customer_value_segment": VALUE_SEGMENT,
    "global_averages": GLOBAL_AVERAGES,
    "population_averages": POPULATION_AVERAGES,
    "customer_score_attach": SCORE_ATTACH,
    "calendar_columns": CALENDAR,
    "label_columns": LABELS,
    "customer_profile": PROFILE,
    "weekly_visits": WEEKLY_VISITS,
    "weekly_basket": WEEKLY_BASKET,
    "customer_week_profile": WEEK_PROFILE,
    "product_week_revenue": PRODUCT_WEEK,
    "product_month_revenue": PRODUCT_MONTH,
    "product_month_dense": PRODUCT_DENSE,
    "product_cmgr": PRODUCT_CMGR,
    "product_series": PRODUCT_SERIES,
    "unfulfilled_by_day": UNFULFILLED_DAY,
    "unfulfilled_by_month": UNFULFILLED_MONTH,
    "revenue_by_type_long": REVENUE_BY_TYPE,
    "daily_sales_summary": DAILY_SUMMARY,
    "product_growth_report": GROWTH_REPORT,
    "csv_order_lines": CSV_ORDER_LINES,
    "order_export_files": EXPORT_FILES,
    "daily_summary_file": DAILY_SUMMARY,
    "order_gap_rows": _gap_rows_sql(ORDER_LINES, "ol"),
    "order_gap_rows_events": _gap_rows_sql(EVENTS, "ev"),
    "bought_together_basket_arrays": _pairs_sql(False),
    "shared_orders": SHARED_ORDERS,
    "bought_together_published": _pairs_sql(False),
    "weekly_visits_published": WEEKLY_VISITS,
    "export_rejects": EXPORT_REJECTS,
    "customer_export_files": CUSTOMER_FILES,
    "stored_lines_views": STORED_VIEWS,
}
