"""Oracle SQL (DuckDB dialect) for every registered query.

Written directly from the reference's SQL / pandas semantics against the
driver tables (``customer nation region orders lineitem part`` views), with
the same documented choices as the Spark side: ties in NTILE broken by
customer_id ascending, as-of date 2001-08-02, exact DECIMAL revenue, every
rounded figure rounded half-up through DECIMAL(28,8) and returned as DOUBLE.
"""

from __future__ import annotations

AS_OF_SQL = "DATE '2001-08-02'"


def rnd(expr: str, n: int) -> str:
    return f"CAST(ROUND(CAST(({expr}) AS DECIMAL(28,8)), {n}) AS DOUBLE)"


def mean(expr: str) -> str:
    return f"(CAST(SUM({expr}) AS DOUBLE) / NULLIF(COUNT({expr}), 0))"


def pct(part: str, whole: str, n: int = 2) -> str:
    return rnd(f"CAST({part} AS DOUBLE) * 100.0::DOUBLE / NULLIF(CAST({whole} AS DOUBLE), 0.0::DOUBLE)", n)


def month_start(d: str) -> str:
    return f"CAST(date_trunc('month', {d}) AS DATE)"


CTE = {}

CTE["customers"] = """customers AS (
  SELECT c.c_custkey AS customer_id, n.n_name AS country, CAST(NULL AS DATE) AS signup_date,
         c.c_mktsegment AS acquisition_channel, r.r_name AS region
  FROM customer c
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey)"""

CTE["transactions"] = """transactions AS (
  SELECT l.l_orderkey AS transaction_id, o.o_custkey AS customer_id, l.l_partkey AS product_id,
         CAST(o.o_orderdate AS DATE) AS transaction_date,
         CAST(l.l_quantity AS INTEGER) AS quantity,
         CAST(p.p_retailprice AS DECIMAL(10,2)) AS unit_price,
         CAST(ROUND(l.l_discount * 100) AS DECIMAL(5,2)) AS discount_pct,
         p.p_type AS category
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey)"""

CTE["tlean"] = """tlean AS (
  SELECT l.l_orderkey AS transaction_id, o.o_custkey AS customer_id, l.l_partkey AS product_id,
         CAST(o.o_orderdate AS DATE) AS transaction_date, CAST(l.l_quantity AS INTEGER) AS quantity
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

CTE["lines"] = """lines AS (
  SELECT *, CAST(quantity * unit_price * (100 - COALESCE(discount_pct, 0)) * 0.01 AS DECIMAL(18,6)) AS revenue
  FROM transactions)"""

CTE["metrics"] = f"""metrics AS (
  SELECT c.customer_id, c.country, c.signup_date, c.acquisition_channel,
         COUNT(DISTINCT t.transaction_id) AS frequency,
         MAX(t.transaction_date) AS last_purchase_date,
         CAST({AS_OF_SQL} - MAX(t.transaction_date) AS INTEGER) AS recency_days,
         SUM(t.revenue) AS monetary_value,
         MIN(t.transaction_date) AS first_purchase_date,
         CAST(COUNT(DISTINCT date_trunc('month', t.transaction_date)) AS INTEGER) AS active_months
  FROM customers c JOIN lines t USING (customer_id)
  GROUP BY c.customer_id, c.country, c.signup_date, c.acquisition_channel)"""

CTE["scored"] = """scored AS (
  SELECT *,
         CAST(NTILE(5) OVER (ORDER BY recency_days DESC, customer_id ASC) AS INTEGER) AS r_score,
         CAST(NTILE(5) OVER (ORDER BY frequency ASC, customer_id ASC) AS INTEGER) AS f_score,
         CAST(NTILE(5) OVER (ORDER BY monetary_value ASC, customer_id ASC) AS INTEGER) AS m_score
  FROM metrics)"""

# The segment names and score boxes, in rule order.
SEGMENT_CASE = """CASE
    WHEN r_score = 5 AND f_score >= 4 AND m_score >= 4 THEN 'Champion'
    WHEN f_score >= 4 AND m_score >= 3 THEN 'Loyal Customer'
    WHEN r_score >= 4 AND f_score BETWEEN 2 AND 4 THEN 'Potential Loyalist'
    WHEN r_score >= 4 AND f_score <= 2 THEN 'New Customer'
    WHEN r_score = 3 AND f_score <= 2 THEN 'Promising'
    WHEN r_score = 3 AND f_score = 3 AND m_score = 3 THEN 'Need Attention'
    WHEN r_score <= 2 AND (f_score >= 3 OR m_score >= 3) THEN 'At-Risk'
    WHEN r_score = 1 AND f_score >= 4 THEN 'Cannot Lose Them'
    WHEN r_score <= 2 AND f_score <= 2 AND m_score >= 2 THEN 'Hibernating'
    ELSE 'Lost' END"""

CTE["seg"] = f"""seg AS (
  SELECT *, CAST(r_score + f_score + m_score AS INTEGER) AS rfm_total,
         CAST(r_score AS VARCHAR) || CAST(f_score AS VARCHAR) || CAST(m_score AS VARCHAR) AS rfm_cell,
         {SEGMENT_CASE} AS segment
  FROM scored)"""

CTE["base"] = f"""base AS (
  SELECT customer_id, MAX(transaction_date) AS last_purchase, COUNT(*) AS frequency,
         SUM(revenue) AS monetary_value,
         CAST({AS_OF_SQL} - MAX(transaction_date) AS INTEGER) AS recency_days
  FROM lines GROUP BY customer_id)"""

CTE["edges"] = """edges AS (
  SELECT quantile_cont(CAST(recency_days AS DOUBLE), [0.2, 0.4, 0.6, 0.8]) AS qr,
         quantile_cont(CAST(frequency AS DOUBLE), [0.2, 0.4, 0.6, 0.8]) AS qf,
         quantile_cont(CAST(monetary_value AS DOUBLE), [0.2, 0.4, 0.6, 0.8]) AS qm
  FROM base)"""

CTE["pscored"] = """pscored AS (
  SELECT b.*,
         CAST(5 - len(list_filter(e.qr, lambda x: x < CAST(b.recency_days AS DOUBLE))) AS INTEGER) AS r_score,
         CAST(1 + len(list_filter(e.qf, lambda x: x < CAST(b.frequency AS DOUBLE))) AS INTEGER) AS f_score,
         CAST(1 + len(list_filter(e.qm, lambda x: x < CAST(b.monetary_value AS DOUBLE))) AS INTEGER) AS m_score
  FROM base b CROSS JOIN edges e)"""

CTE["first"] = """first AS (
  SELECT customer_id, MIN(transaction_date) AS first_purchase FROM lines GROUP BY customer_id)"""

CTE["prfm"] = f"""prfm AS (
  SELECT p.customer_id, p.last_purchase, p.frequency, p.monetary_value, p.recency_days,
         p.r_score, p.f_score, p.m_score,
         CAST(p.r_score + p.f_score + p.m_score AS INTEGER) AS rfm_total,
         {SEGMENT_CASE} AS segment,
         c.country, c.acquisition_channel,
         strftime(f.first_purchase, '%Y-%m') AS cohort_month,
         {month_start('f.first_purchase')} AS cohort_month_ts,
         CAST(quarter(f.first_purchase) AS INTEGER) AS acq_quarter
  FROM pscored p JOIN customers c USING (customer_id) LEFT JOIN first f USING (customer_id))"""

CTE["activity"] = f"""activity AS (
  SELECT customer_id, {month_start('transaction_date')} AS activity_month
  FROM lines GROUP BY customer_id, {month_start('transaction_date')})"""

CTE["cohort_of"] = f"""cohort_of AS (
  SELECT customer_id, {month_start('MIN(transaction_date)')} AS cohort_month,
         CAST(quarter(MIN(transaction_date)) AS INTEGER) AS cohort_quarter,
         CAST(year(MIN(transaction_date)) AS INTEGER) AS cohort_year
  FROM lines GROUP BY customer_id)"""

CTE["cohort_data"] = """cohort_data AS (
  SELECT c.customer_id, c.cohort_month, c.cohort_quarter, c.cohort_year, a.activity_month,
         CAST((year(a.activity_month) - year(c.cohort_month)) * 12
              + (month(a.activity_month) - month(c.cohort_month)) AS INTEGER) AS month_number
  FROM cohort_of c JOIN activity a USING (customer_id))"""

CTE["sizes"] = """sizes AS (
  SELECT cohort_month, COUNT(DISTINCT customer_id) AS cohort_size
  FROM cohort_data WHERE month_number = 0 GROUP BY cohort_month)"""

CTE["rcounts"] = """rcounts AS (
  SELECT cohort_month, month_number, COUNT(DISTINCT customer_id) AS retained_customers
  FROM cohort_data GROUP BY cohort_month, month_number)"""

_ratio4 = lambda k: rnd(rnd(f'CAST(m."{k}" AS DOUBLE) / CAST(m."0" AS DOUBLE)', 4) + " * 100.0::DOUBLE", 2)

CTE["matrix"] = ("""mcounts AS (
  SELECT cohort_month, """ + ", ".join(
    f'COUNT(DISTINCT CASE WHEN month_number = {k} THEN customer_id END) AS "{k}"' for k in range(13)) + """
  FROM cohort_data WHERE month_number <= 12 GROUP BY cohort_month),
matrix AS (
  SELECT strftime(m.cohort_month, '%Y-%m') AS cohort_month, """ + ", ".join(
    f'CASE WHEN m."{k}" = 0 THEN NULL ELSE {_ratio4(k)} END AS "{k}"' for k in range(13)) + """
  FROM mcounts m)""")

CTE["long"] = f"""long AS (
  SELECT cohort_month, CAST(month_number AS INTEGER) AS month_number, retention_rate_pct,
         {rnd('100.0::DOUBLE - retention_rate_pct', 2)} AS churn_rate_pct,
         CAST(strptime(cohort_month, '%Y-%m') AS DATE) AS cohort_month_dt,
         CAST(year(CAST(strptime(cohort_month, '%Y-%m') AS DATE)) AS INTEGER) AS cohort_year,
         CAST(quarter(CAST(strptime(cohort_month, '%Y-%m') AS DATE)) AS INTEGER) AS cohort_quarter
  FROM (UNPIVOT matrix ON {", ".join(f'"{k}"' for k in range(13))}
        INTO NAME month_number VALUE retention_rate_pct)
  WHERE retention_rate_pct IS NOT NULL)"""

CTE["acq"] = f"""acq AS (
  SELECT customer_id, MIN(transaction_date) AS first_purchase,
         CAST(quarter(MIN(transaction_date)) AS INTEGER) AS acq_quarter,
         CAST(year(MIN(transaction_date)) AS INTEGER) AS acq_year,
         SUM(revenue) AS ltv
  FROM lines GROUP BY customer_id)"""

CTE["qltv"] = f"""qltv AS (
  SELECT acq_quarter, {rnd(mean('ltv'), 2)} AS avg_ltv FROM acq GROUP BY acq_quarter)"""

CTE["window_activity"] = """window_activity AS (
  SELECT f.customer_id, f.first_purchase,
         EXISTS (SELECT 1 FROM lines t WHERE t.customer_id = f.customer_id
                 AND t.transaction_date BETWEEN f.first_purchase + INTERVAL 60 DAY
                                            AND f.first_purchase + INTERVAL 90 DAY) AS active
  FROM first f)"""

CTE["extract"] = f"""extract AS (
  SELECT customer_id, country, acquisition_channel, recency_days, frequency,
         {rnd('monetary_value', 2)} AS monetary_value,
         r_score, f_score, m_score, rfm_total, segment, acq_quarter,
         CAST(CASE segment WHEN 'Champion' THEN 1 WHEN 'Loyal Customer' THEN 2
              WHEN 'Potential Loyalist' THEN 3 WHEN 'New Customer' THEN 4 WHEN 'Promising' THEN 5
              WHEN 'Need Attention' THEN 6 WHEN 'At-Risk' THEN 7 WHEN 'Hibernating' THEN 8
              WHEN 'Cannot Lose Them' THEN 9 WHEN 'Lost' THEN 10 ELSE 10 END AS INTEGER) AS segment_rank,
         CAST(segment = 'Champion' AS INTEGER) AS is_champion,
         CAST(segment = 'At-Risk' AS INTEGER) AS is_at_risk
  FROM prfm)"""

CTE["geo"] = f"""geo0 AS (
  SELECT country, COUNT(*) AS customers,
         {rnd('SUM(monetary_value)', 2)} AS total_revenue,
         {rnd(mean('monetary_value'), 2)} AS avg_ltv,
         {rnd(mean('recency_days'), 2)} AS avg_recency,
         {rnd(mean('frequency'), 2)} AS avg_frequency,
         CAST(SUM(CASE WHEN segment = 'Champion' THEN 1 ELSE 0 END) AS BIGINT) AS champion_count
  FROM prfm WHERE country IS NOT NULL GROUP BY country),
georeg AS (SELECT DISTINCT country, region FROM customers),
geo AS (
  SELECT g.country, g.customers, g.total_revenue, g.avg_ltv, g.avg_recency, g.avg_frequency,
         g.champion_count, g.country AS country_name, COALESCE(r.region, 'Other') AS region,
         {pct('g.total_revenue', 'SUM(g.total_revenue) OVER ()')} AS pct_revenue,
         {pct('g.customers', 'SUM(g.customers) OVER ()')} AS pct_customers
  FROM geo0 g LEFT JOIN georeg r USING (country))"""

DEPS = {
    "customers": [], "transactions": [], "tlean": [], "lines": ["transactions"],
    "metrics": ["customers", "lines"], "scored": ["metrics"], "seg": ["scored"],
    "base": ["lines"], "edges": ["base"], "pscored": ["base", "edges"], "first": ["lines"],
    "prfm": ["pscored", "customers", "first"], "activity": ["lines"], "cohort_of": ["lines"],
    "cohort_data": ["cohort_of", "activity"], "sizes": ["cohort_data"], "rcounts": ["cohort_data"],
    "matrix": ["cohort_data"], "long": ["matrix"], "acq": ["lines"], "qltv": ["acq"],
    "window_activity": ["first", "lines"], "extract": ["prfm"], "geo": ["prfm", "customers"],
}


def with_ctes(needed: list[str], body: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        for d in DEPS[n]:
            visit(d)
        if n not in order:
            order.append(n)

    for n in needed:
        visit(n)
    return "WITH " + ",\n".join(CTE[n] for n in order) + "\n" + body


SCALAR_DATES = "DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders"


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}

    q["scan_customers"] = with_ctes(["customers"], """
SELECT customer_id, country, signup_date, acquisition_channel FROM customers""")

    q["scan_transactions"] = with_ctes(["lines", "customers"], """
SELECT t.transaction_id, t.customer_id, t.transaction_date, t.category,
       CAST(t.unit_price AS DOUBLE) AS unit_price, t.quantity,
       CAST(t.discount_pct AS DOUBLE) AS discount_pct, c.country, CAST(t.revenue AS DOUBLE) AS revenue
FROM lines t JOIN customers c USING (customer_id)""")

    q["default_discount"] = with_ctes(["transactions"], """
SELECT transaction_id, customer_id, product_id,
       CAST(COALESCE(discount_pct, 0) AS DOUBLE) AS discount_pct FROM transactions""")

    q["line_revenue"] = with_ctes(["lines"], """
SELECT transaction_id, customer_id, product_id, quantity, CAST(unit_price AS DOUBLE) AS unit_price,
       CAST(discount_pct AS DOUBLE) AS discount_pct, CAST(revenue AS DOUBLE) AS revenue FROM lines""")

    q["constraint_audit"] = """
WITH c AS (SELECT c_custkey AS customer_id, n_name AS country FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey),
t AS (
  SELECT l_orderkey AS transaction_id, o_custkey AS customer_id, l_partkey AS product_id, o_orderdate AS transaction_date,
         l_quantity AS quantity, p_retailprice AS unit_price
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey)
SELECT 'customers' AS table_name, 'unique:customer_id' AS rule, COUNT(customer_id) - COUNT(DISTINCT customer_id) AS violations FROM c
UNION ALL SELECT 'customers', 'unique:email', CAST(NULL AS BIGINT)
UNION ALL SELECT 'customers', 'not_null:customer_id', COUNT(*) FILTER (WHERE customer_id IS NULL) FROM c
UNION ALL SELECT 'customers', 'not_null:email', CAST(NULL AS BIGINT)
UNION ALL SELECT 'customers', 'not_null:country', COUNT(*) FILTER (WHERE country IS NULL) FROM c
UNION ALL SELECT 'customers', 'not_null:signup_date', COUNT(*) FROM c
UNION ALL SELECT 'products', 'unique:product_id', COUNT(p_partkey) - COUNT(DISTINCT p_partkey) FROM part
UNION ALL SELECT 'products', 'not_null:product_id', COUNT(*) FILTER (WHERE p_partkey IS NULL) FROM part
UNION ALL SELECT 'products', 'not_null:product_name', CAST(NULL AS BIGINT)
UNION ALL SELECT 'products', 'not_null:unit_price', COUNT(*) FILTER (WHERE p_retailprice IS NULL) FROM part
UNION ALL SELECT 'transactions', 'unique:transaction_id', COUNT(transaction_id) - COUNT(DISTINCT transaction_id) FROM t
UNION ALL SELECT 'transactions', 'not_null:transaction_id', COUNT(*) FILTER (WHERE transaction_id IS NULL) FROM t
UNION ALL SELECT 'transactions', 'not_null:customer_id', COUNT(*) FILTER (WHERE customer_id IS NULL) FROM t
UNION ALL SELECT 'transactions', 'not_null:product_id', COUNT(*) FILTER (WHERE product_id IS NULL) FROM t
UNION ALL SELECT 'transactions', 'not_null:transaction_date', COUNT(*) FILTER (WHERE transaction_date IS NULL) FROM t
UNION ALL SELECT 'transactions', 'not_null:quantity', COUNT(*) FILTER (WHERE quantity IS NULL) FROM t
UNION ALL SELECT 'transactions', 'not_null:unit_price', COUNT(*) FILTER (WHERE unit_price IS NULL) FROM t
UNION ALL SELECT 'transactions', 'check:quantity>0', COUNT(*) FILTER (WHERE NOT (quantity > 0)) FROM t
UNION ALL SELECT 'lines', 'foreign_key:order_id', COUNT(*) FROM lineitem
    WHERE l_orderkey IS NOT NULL AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey IS NOT NULL)
UNION ALL SELECT 'lines', 'foreign_key:product_id', COUNT(*) FROM lineitem
    WHERE l_partkey IS NOT NULL AND l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_partkey IS NOT NULL)
UNION ALL SELECT 'orders', 'foreign_key:customer_id', COUNT(*) FROM orders
    WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey IS NOT NULL)"""

    def null_rows(table, view, key, columns):
        return "".join(f"""
UNION ALL SELECT '{table}', 'not_null:{name}', CAST({key} AS VARCHAR), COUNT(*) FROM {view} WHERE {col} IS NULL GROUP BY 3""" for name, col in columns)

    def shared_rows(table, view, name, key):
        return f"""
UNION ALL SELECT '{table}', 'unique:{name}', CAST({key} AS VARCHAR), COUNT(*) - 1 FROM {view} WHERE {key} IS NOT NULL GROUP BY 3 HAVING COUNT(*) > 1"""

    def orphan_rows(table, name, view, key, parent, pkey):
        return f"""
UNION ALL SELECT '{table}', 'foreign_key:{name}', CAST({key} AS VARCHAR), COUNT(*) FROM {view}
    WHERE {key} IS NOT NULL AND {key} NOT IN (SELECT {pkey} FROM {parent} WHERE {pkey} IS NOT NULL) GROUP BY 3"""

    q["audit_witnesses"] = (
        q["constraint_audit"][:q["constraint_audit"].index("SELECT 'customers' AS table_name")]
        + "SELECT 'transactions' AS table_name, 'check:quantity>0' AS rule, CAST(transaction_id AS VARCHAR) AS witness, COUNT(*) AS rows FROM t WHERE NOT (quantity > 0) GROUP BY 3"
        + shared_rows("customers", "c", "customer_id", "customer_id") + shared_rows("products", "part", "product_id", "p_partkey")
        + shared_rows("transactions", "t", "transaction_id", "transaction_id")
        + null_rows("customers", "c", "customer_id", [("customer_id", "customer_id"), ("country", "country"), ("signup_date", "CAST(NULL AS DATE)")])
        + null_rows("products", "part", "p_partkey", [("product_id", "p_partkey"), ("unit_price", "p_retailprice")])
        + null_rows("transactions", "t", "transaction_id", [(x, x) for x in ("transaction_id", "customer_id", "product_id", "transaction_date", "quantity", "unit_price")])
        + orphan_rows("lines", "order_id", "lineitem", "l_orderkey", "orders", "o_orderkey") + orphan_rows("lines", "product_id", "lineitem", "l_partkey", "part", "p_partkey")
        + orphan_rows("orders", "customer_id", "orders", "o_custkey", "customer", "c_custkey"))

    q["load_report"] = with_ctes(["transactions", "customers"], """
SELECT COUNT(*) AS transactions, COUNT(DISTINCT t.customer_id) AS customers,
       COUNT(DISTINCT c.country) AS countries
FROM transactions t JOIN customers c USING (customer_id)""")

    q["customer_metrics"] = with_ctes(["metrics"], """
SELECT customer_id, country, signup_date, acquisition_channel, frequency, last_purchase_date,
       recency_days, CAST(monetary_value AS DOUBLE) AS monetary_value, first_purchase_date, active_months
FROM metrics""")

    q["active_months"] = with_ctes(["lines"], """
SELECT customer_id, CAST(COUNT(DISTINCT date_trunc('month', transaction_date)) AS INTEGER) AS active_months
FROM lines GROUP BY customer_id""")

    q["rfm_base"] = with_ctes(["base"], """
SELECT customer_id, last_purchase, frequency, CAST(monetary_value AS DOUBLE) AS monetary_value, recency_days
FROM base""")

    q["customer_ltv"] = with_ctes(["lines"], f"""
SELECT customer_id, {rnd('SUM(revenue)', 2)} AS ltv FROM lines GROUP BY customer_id""")

    q["ntile_recency"] = with_ctes(["scored"], "SELECT customer_id, recency_days, r_score FROM scored")
    q["ntile_frequency"] = with_ctes(["scored"], "SELECT customer_id, frequency, f_score FROM scored")
    q["ntile_monetary"] = with_ctes(["scored"], f"""
SELECT customer_id, CAST(monetary_value AS DOUBLE) AS monetary_value, m_score FROM scored""")

    q["qcut_recency"] = with_ctes(["pscored"], "SELECT customer_id, recency_days, r_score FROM pscored")
    q["qcut_frequency"] = with_ctes(["pscored"], "SELECT customer_id, frequency, f_score FROM pscored")
    q["qcut_monetary"] = with_ctes(["pscored"], """
SELECT customer_id, CAST(monetary_value AS DOUBLE) AS monetary_value, m_score FROM pscored""")

    q["rfm_cells"] = with_ctes(["seg"], """
SELECT customer_id, r_score, f_score, m_score, rfm_total, rfm_cell FROM seg""")

    q["rfm_segments"] = with_ctes(["seg"], f"""
SELECT customer_id, country, acquisition_channel, recency_days, frequency,
       {rnd('monetary_value', 2)} AS monetary_value, r_score, f_score, m_score, rfm_total, rfm_cell, segment
FROM seg ORDER BY rfm_total DESC, customer_id""")

    q["segment_cells"] = with_ctes(["seg"], """
SELECT rfm_cell, r_score, f_score, m_score, segment, COUNT(*) AS customers
FROM seg GROUP BY rfm_cell, r_score, f_score, m_score, segment""")

    q["rfm_pandas_scores"] = with_ctes(["prfm"], f"""
SELECT customer_id, last_purchase, frequency, {rnd('monetary_value', 2)} AS monetary_value, recency_days,
       r_score, f_score, m_score, rfm_total, segment, country, acquisition_channel, cohort_month,
       cohort_month_ts, acq_quarter
FROM prfm""")

    q["segment_summary"] = with_ctes(["seg"], f"""
SELECT segment, COUNT(*) AS customer_count,
       {pct('COUNT(*)', 'SUM(COUNT(*)) OVER ()')} AS pct_of_customers,
       {rnd('SUM(monetary_value)', 2)} AS total_revenue,
       {pct('SUM(monetary_value)', 'SUM(SUM(monetary_value)) OVER ()')} AS pct_of_revenue,
       {rnd(mean('monetary_value'), 2)} AS avg_ltv,
       {rnd(mean('recency_days'), 1)} AS avg_recency_days,
       {rnd(mean('frequency'), 1)} AS avg_frequency
FROM seg GROUP BY segment ORDER BY total_revenue DESC""")

    q["segment_summary_rounded"] = with_ctes(["prfm"], f"""
SELECT segment, customers, total_revenue, avg_ltv, avg_recency, avg_frequency,
       {pct('customers', 'SUM(customers) OVER ()')} AS pct_customers,
       {pct('total_revenue', 'SUM(total_revenue) OVER ()')} AS pct_revenue
FROM (SELECT segment, COUNT(*) AS customers,
             {rnd('SUM(monetary_value)', 2)} AS total_revenue,
             {rnd(mean('monetary_value'), 2)} AS avg_ltv,
             {rnd(mean('recency_days'), 2)} AS avg_recency,
             {rnd(mean('frequency'), 2)} AS avg_frequency
      FROM prfm GROUP BY segment) s""")

    q["at_risk_recovery"] = with_ctes(["seg"], f"""
SELECT customer_id, country, {rnd('monetary_value', 2)} AS historical_spend, recency_days, frequency,
       {rnd('CAST(monetary_value AS DOUBLE) / CAST(NULLIF(frequency, 0) AS DOUBLE) * 3.0::DOUBLE', 2)}
           AS estimated_recoverable_revenue
FROM seg WHERE segment = 'At-Risk'""")

    q["at_risk_headline"] = with_ctes(["prfm"], f"""
SELECT COUNT(*) AS at_risk_customers, {rnd('COALESCE(SUM(monetary_value), 0)', 2)} AS historical_spend
FROM prfm WHERE segment = 'At-Risk'""")

    q["at_risk_kpis"] = with_ctes(["seg"], f"""
SELECT COUNT(*) AS at_risk_customers, {rnd('COALESCE(SUM(monetary_value), 0)', 2)} AS historical_spend,
       {rnd('COALESCE(SUM(CAST(monetary_value AS DOUBLE) / CAST(NULLIF(frequency, 0) AS DOUBLE) * 3.0::DOUBLE), 0)', 2)}
           AS recoverable_revenue
FROM seg WHERE segment = 'At-Risk'""")

    q["cohorts"] = with_ctes(["cohort_of"], "SELECT customer_id, cohort_month, cohort_quarter, cohort_year FROM cohort_of")
    q["customer_activity"] = with_ctes(["activity"], "SELECT customer_id, activity_month FROM activity")
    q["cohort_activity"] = with_ctes(["cohort_data"], """
SELECT customer_id, cohort_month, cohort_quarter, cohort_year, activity_month, month_number FROM cohort_data""")
    q["cohort_sizes"] = with_ctes(["sizes"], "SELECT cohort_month, cohort_size FROM sizes")
    q["retention_counts"] = with_ctes(["rcounts"], "SELECT cohort_month, month_number, retained_customers FROM rcounts")
    q["cohort_retention"] = with_ctes(["rcounts", "sizes"], f"""
SELECT rc.cohort_month, cs.cohort_size, rc.month_number, rc.retained_customers,
       {pct('rc.retained_customers', 'cs.cohort_size')} AS retention_rate_pct,
       {rnd('(1.0::DOUBLE - CAST(rc.retained_customers AS DOUBLE) / CAST(cs.cohort_size AS DOUBLE)) * 100.0::DOUBLE', 2)} AS churn_rate_pct
FROM rcounts rc JOIN sizes cs USING (cohort_month)
ORDER BY rc.cohort_month, rc.month_number""")
    q["cohort_matrix"] = with_ctes(["matrix"], "SELECT * FROM matrix")
    q["cohort_long"] = with_ctes(["long"], "SELECT * FROM long")
    q["cohort_preview"] = with_ctes(["matrix"], """
SELECT cohort_month, "0", "1", "2", "3", "4", "5", "6" FROM matrix ORDER BY cohort_month LIMIT 6""")
    q["cohort_year_filter"] = with_ctes(["long"], "SELECT * FROM long WHERE cohort_year = 1998")
    q["avg_month3_retention"] = with_ctes(["matrix"], f"""
SELECT {rnd('SUM("3") / COUNT("3")', 2)} AS avg_month3_retention_pct,
       {rnd('100.0::DOUBLE - SUM("3") / COUNT("3")', 2)} AS avg_month3_churn_pct,
       COUNT("3") AS cohorts
FROM matrix""")
    q["txn_with_cohort"] = with_ctes(["lines", "cohort_of"], f"""
SELECT t.transaction_id, t.customer_id, t.transaction_date, c.cohort_month,
       {month_start('t.transaction_date')} AS activity_month,
       CAST((year(t.transaction_date) - year(c.cohort_month)) * 12
            + (month(t.transaction_date) - month(c.cohort_month)) AS INTEGER) AS month_number
FROM lines t JOIN cohort_of c USING (customer_id)""")
    q["retention_curve"] = with_ctes(["long"], f"""
SELECT month_number,
       {rnd('SUM(retention_rate_pct) / COUNT(retention_rate_pct)', 2)} AS avg_retention_pct,
       {rnd('SUM(churn_rate_pct) / COUNT(churn_rate_pct)', 2)} AS avg_churn_pct,
       COUNT(*) AS cohorts,
       CASE WHEN {rnd('SUM(retention_rate_pct) / COUNT(retention_rate_pct)', 2)} > 25 THEN 'High'
            WHEN {rnd('SUM(retention_rate_pct) / COUNT(retention_rate_pct)', 2)} > 15 THEN 'Mid'
            ELSE 'Low' END AS retention_label,
       CASE WHEN month_number = 3 THEN 'Critical Window' ELSE '' END AS month_flag
FROM long GROUP BY month_number ORDER BY month_number""")

    q["quarter_ltv"] = with_ctes(["acq"], f"""
SELECT acq_quarter, acq_year, COUNT(DISTINCT customer_id) AS cohort_size,
       {rnd(mean('ltv'), 2)} AS avg_ltv,
       {rnd('MEDIAN(ltv)', 2)} AS median_ltv,
       {rnd('SUM(ltv)', 2)} AS total_revenue,
       {rnd(mean('ltv') + ' / AVG(' + mean('ltv') + ') OVER ()', 2)} AS ltv_index
FROM acq GROUP BY acq_quarter, acq_year ORDER BY acq_year, acq_quarter""")
    q["ltv_by_quarter"] = with_ctes(["qltv"], "SELECT acq_quarter, avg_ltv FROM qltv ORDER BY acq_quarter")
    q["q4_q1_ratio"] = with_ctes(["qltv"], f"""
SELECT MAX(CASE WHEN acq_quarter = 1 THEN avg_ltv END) AS q1_avg_ltv,
       MAX(CASE WHEN acq_quarter = 4 THEN avg_ltv END) AS q4_avg_ltv,
       {rnd('MAX(CASE WHEN acq_quarter = 4 THEN avg_ltv END) / NULLIF(MAX(CASE WHEN acq_quarter = 1 THEN avg_ltv END), 0.0::DOUBLE)', 2)} AS q4_q1_ratio
FROM qltv""")

    q["month3_active"] = with_ctes(["first", "lines"], """
SELECT DISTINCT t.customer_id FROM lines t JOIN first c USING (customer_id)
WHERE t.transaction_date BETWEEN c.first_purchase + INTERVAL 60 DAY AND c.first_purchase + INTERVAL 90 DAY""")
    q["month3_churn"] = with_ctes(["window_activity", "customers"], f"""
SELECT cu.country, COUNT(DISTINCT w.customer_id) AS cohort_size,
       CAST(SUM(CASE WHEN w.active THEN 1 ELSE 0 END) AS BIGINT) AS active_month3,
       {pct('SUM(CASE WHEN w.active THEN 1 ELSE 0 END)', 'COUNT(DISTINCT w.customer_id)')} AS month3_retention_pct,
       {rnd('100.0::DOUBLE - CAST(SUM(CASE WHEN w.active THEN 1 ELSE 0 END) AS DOUBLE) * 100.0::DOUBLE / CAST(NULLIF(COUNT(DISTINCT w.customer_id), 0) AS DOUBLE)', 2)} AS month3_churn_pct
FROM window_activity w JOIN customers cu USING (customer_id)
GROUP BY cu.country HAVING COUNT(DISTINCT w.customer_id) >= 50
ORDER BY month3_churn_pct DESC""")

    q["rfm_customers_extract"] = with_ctes(["extract"], "SELECT * FROM extract")
    q["segment_rank"] = with_ctes(["extract"], """
SELECT segment, segment_rank, COUNT(*) AS customers FROM extract GROUP BY segment, segment_rank""")
    q["monthly_revenue"] = with_ctes(["lines"], f"""
SELECT strftime(transaction_date, '%Y-%m') AS month, CAST(year(transaction_date) AS INTEGER) AS year,
       CAST(quarter(transaction_date) AS INTEGER) AS quarter, category,
       COUNT(*) AS transactions, COUNT(DISTINCT customer_id) AS customers,
       {rnd('SUM(revenue)', 2)} AS revenue, {rnd(mean('revenue'), 2)} AS avg_order
FROM lines WHERE category IS NOT NULL
GROUP BY 1, 2, 3, 4""")
    q["period_customers"] = with_ctes(["lines"], "".join(f"""{start}
SELECT category, '{grain}' AS grain, {period} AS period, COUNT(DISTINCT customer_id) AS customers
FROM lines WHERE category IS NOT NULL GROUP BY 1, 2, 3""" for start, grain, period in [
        ("", "month", "CAST(date_trunc('month', transaction_date) AS DATE)"), (" UNION ALL", "quarter", "CAST(date_trunc('quarter', transaction_date) AS DATE)"),
        (" UNION ALL", "year", "CAST(date_trunc('year', transaction_date) AS DATE)"), (" UNION ALL", "all", "CAST(NULL AS DATE)")]))
    q["geo_labels"] = with_ctes(["customers"], """
SELECT DISTINCT country, country AS country_name, region FROM customers""")
    q["geo_summary"] = with_ctes(["geo"], "SELECT * FROM geo ORDER BY total_revenue DESC")
    q["top_countries"] = with_ctes(["geo"], """
SELECT country, country_name, region, total_revenue FROM geo ORDER BY total_revenue DESC, country LIMIT 15""")
    q["geo_scatter"] = with_ctes(["geo"], """
SELECT country, region, total_revenue, avg_ltv, customers,
       CASE WHEN ROW_NUMBER() OVER (ORDER BY total_revenue DESC, country) <= 10 THEN country END AS label
FROM geo""")
    q["region_revenue"] = with_ctes(["geo"], f"""
SELECT region, {rnd('SUM(total_revenue)', 2)} AS total_revenue, CAST(SUM(customers) AS BIGINT) AS customers,
       {pct('SUM(total_revenue)', 'SUM(SUM(total_revenue)) OVER ()')} AS pct_revenue
FROM geo GROUP BY region""")

    q["segment_bars"] = with_ctes(["prfm"], f"""
SELECT segment, {rnd('SUM(monetary_value)', 2)} AS total_revenue, COUNT(DISTINCT customer_id) AS customers,
       {rnd('AVG(CAST(SUM(monetary_value) AS DOUBLE)) OVER ()', 2)} AS avg_segment_revenue
FROM prfm GROUP BY segment""")
    q["rfm_scatter"] = with_ctes(["prfm"], f"""
SELECT segment, {rnd(mean('recency_days'), 2)} AS avg_recency_days, {rnd(mean('frequency'), 2)} AS avg_frequency,
       {rnd('SUM(monetary_value)', 2)} AS total_revenue, COUNT(*) AS customers,
       {rnd(mean('monetary_value'), 2)} AS avg_ltv
FROM prfm GROUP BY segment""")
    q["champion_kpi"] = with_ctes(["prfm"], f"""
SELECT {rnd("COALESCE(SUM(CASE WHEN segment = 'Champion' THEN monetary_value END), 0)", 2)} AS champion_revenue,
       {rnd('SUM(monetary_value)', 2)} AS total_revenue,
       {pct("COALESCE(SUM(CASE WHEN segment = 'Champion' THEN monetary_value END), 0)", 'SUM(monetary_value)')} AS champion_revenue_pct,
       CAST(SUM(CASE WHEN segment = 'Champion' THEN 1 ELSE 0 END) AS BIGINT) AS champion_customers
FROM prfm""")
    q["ltv_tiers"] = with_ctes(["prfm"], f"""
SELECT CASE WHEN monetary_value > 1000000 THEN 'High' WHEN monetary_value > 500000 THEN 'Mid' ELSE 'Low' END AS ltv_tier,
       COUNT(*) AS customers, {rnd('SUM(monetary_value)', 2)} AS total_revenue
FROM prfm GROUP BY 1""")
    q["segment_comparison"] = with_ctes(["prfm"], f"""
SELECT segment, recency_days, COUNT(*) AS customers, {rnd('SUM(monetary_value)', 2)} AS total_revenue
FROM prfm WHERE segment IN ('At-Risk', 'Champion', 'Loyal Customer')
GROUP BY segment, recency_days""")
    q["recovery_scenarios"] = with_ctes(["prfm"], f"""
SELECT r.rate, CAST(CAST(r.rate * 100 AS INTEGER) AS VARCHAR) || '%' AS scenario,
       {rnd('s.spend', 2)} AS at_risk_spend,
       {rnd('CAST(s.spend AS DOUBLE) * r.rate', 2)} AS recoverable_revenue
FROM (SELECT COALESCE(SUM(monetary_value), 0) AS spend FROM prfm WHERE segment = 'At-Risk') s
CROSS JOIN (SELECT CAST(x AS DOUBLE) AS rate FROM (VALUES (0.05), (0.08), (0.12)) v(x)) r""")
    q["spend_bins"] = with_ctes(["prfm"], f"""
SELECT CAST(FLOOR(monetary_value / 200000) * 200000 AS DOUBLE) AS spend_bin, COUNT(*) AS customers,
       {rnd(mean('recency_days'), 2)} AS avg_recency_days
FROM prfm WHERE segment = 'At-Risk' GROUP BY 1""")

    q["scalar_date_parts"] = f"""
SELECT d, CAST(date_trunc('month', d) AS DATE) AS month_start, CAST(quarter(d) AS INTEGER) AS quarter,
       CAST(year(d) AS INTEGER) AS year,
       CAST((year(d) - 1995) * 12 + (month(d) - 1) AS INTEGER) AS month_number,
       CAST({AS_OF_SQL} - d AS INTEGER) AS days_to_as_of,
       CAST(d + INTERVAL 60 DAY AS DATE) AS plus_60_days,
       strftime(d, '%Y-%m') AS month_label,
       CAST(strptime(strftime(d, '%Y-%m'), '%Y-%m') AS DATE) AS parsed_month
FROM (SELECT {SCALAR_DATES}) x"""
    # the same answers, written to files and read back
    q["scores_file"] = q["rfm_pandas_scores"]
    q["matrix_file"] = q["cohort_long"]
    q["materialized_metrics"] = q["merged_metrics"] = q["customer_metrics"]
    q["load_rejects"] = with_ctes(["customers"], """
SELECT customer_id, 'country' AS column, 'NULL' AS reason, CAST(NULL AS VARCHAR) AS value FROM customers WHERE customer_id % 97 = 0
UNION ALL
SELECT customer_id, 'signup_date', 'no date', 'soon' FROM customers WHERE customer_id % 89 = 0""")
    q["refreshed_metrics"] = q["customer_metrics"] + " WHERE acquisition_channel <> 'BUILDING'"
    q["extract_file"] = q["geo_summary"]
    q["bulk_load"] = with_ctes(["customers"], """
SELECT customer_id, CAST(NULL AS VARCHAR) AS email, country, signup_date, acquisition_channel FROM customers""")
    q["region_filter"] = with_ctes(["geo"], "SELECT * FROM geo WHERE region = 'EUROPE'")

    # NULL discounts and categories by a fixed rule on the keys
    nulls = with_ctes(["transactions"], """, holed AS (
  SELECT transaction_id, customer_id, product_id, transaction_date, quantity, unit_price,
         CASE WHEN customer_id % 7 <> 0 THEN discount_pct END AS discount_pct,
         CASE WHEN product_id % 11 <> 0 THEN category END AS category
  FROM transactions), priced AS (
  SELECT *, CAST(quantity * unit_price * (100 - COALESCE(discount_pct, 0)) * 0.01 AS DECIMAL(18,6)) AS revenue FROM holed)
""")
    q["null_discount_default"] = nulls + """
SELECT transaction_id, customer_id, product_id, CAST(COALESCE(discount_pct, 0) AS DOUBLE) AS discount_pct FROM holed"""
    q["null_line_revenue"] = nulls + "SELECT customer_id, CAST(SUM(revenue) AS DOUBLE) AS revenue FROM priced GROUP BY customer_id"
    q["null_monthly_revenue"] = nulls + q["monthly_revenue"][q["monthly_revenue"].rindex("SELECT strftime"):].replace("FROM lines", "FROM priced")
    return q
