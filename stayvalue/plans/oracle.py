"""The registered queries as SQL for DuckDB, written independently of the Spark plans."""

from __future__ import annotations

_REVIEWS = """
reviews AS (
  SELECT l_orderkey || '-' || l_linenumber AS id,
         CAST(l_partkey AS VARCHAR) AS listing_id,
         l_orderkey AS reviewer_id,
         CASE (l_orderkey + l_linenumber) % 40
           WHEN 0 THEN NULL
           WHEN 1 THEN 'invalid'
           WHEN 2 THEN '2000/01/15'
           WHEN 3 THEN '2000-13-45'
           ELSE strftime(l_shipdate, '%Y-%m-%d') END AS date
  FROM lineitem)"""

_LISTINGS = """
listings AS (
  SELECT CAST(p_partkey AS VARCHAR) AS id,
         CASE p_partkey % 20
           WHEN 0 THEN NULL
           WHEN 1 THEN ''
           WHEN 2 THEN 'free'
           WHEN 3 THEN '$5.00'
           WHEN 4 THEN '$20,000.00'
           WHEN 5 THEN '1.2.3'
           ELSE '$' || printf('%.2f', p_retailprice) END AS price,
         CASE p_partkey % 31
           WHEN 0 THEN NULL
           WHEN 1 THEN ''
           WHEN 2 THEN 'Unknown'
           ELSE p_brand END AS neighbourhood_cleansed
  FROM part)"""

_DATED = """
dated AS (
  SELECT id, listing_id, reviewer_id,
         TRY_CAST(CASE WHEN regexp_matches(date, '^\\d{4}[-/]\\d{1,2}[-/]\\d{1,2}')
                       THEN replace(date, '/', '-') END AS DATE) AS date,
         date AS raw_date
  FROM reviews)"""

_UNIQUE = """
unique_reviews AS (
  SELECT DISTINCT listing_id, reviewer_id, raw_date, date FROM dated)"""

_PRICED = """
priced AS (
  SELECT id, price, neighbourhood_cleansed,
         regexp_replace(price, '[^0-9.]', '', 'g') AS price_numeric_str,
         TRY_CAST(regexp_replace(price, '[^0-9.]', '', 'g') AS DOUBLE) AS price_cleaned
  FROM listings)"""

_CLEAN_LISTINGS = """
clean_listings AS (
  SELECT id AS listing_id, price_cleaned, neighbourhood_cleansed AS neighbourhood
  FROM priced
  WHERE neighbourhood_cleansed IS NOT NULL
    AND neighbourhood_cleansed NOT IN ('', 'Unknown')
    AND price_cleaned BETWEEN 10 AND 10000)"""

_STAYS = """
stays AS (
  SELECT l.listing_id, u.reviewer_id, u.date, l.price_cleaned, l.neighbourhood
  FROM unique_reviews u JOIN clean_listings l ON u.listing_id = l.listing_id
  WHERE u.date IS NOT NULL)"""

_RFM = """
area_counts AS (
  SELECT reviewer_id, neighbourhood, count(*) AS n FROM stays GROUP BY ALL),
favourites AS (
  SELECT reviewer_id, neighbourhood, n FROM area_counts
  QUALIFY row_number() OVER (PARTITION BY reviewer_id ORDER BY n DESC, neighbourhood) = 1),
measures AS (
  SELECT reviewer_id,
         CAST(greatest(0, date_diff('day', max(date), DATE '2001-01-01')) AS INTEGER) AS recency,
         count(*) AS frequency,
         CAST(round(sum(CAST(price_cleaned AS DECIMAL(16,6)) * 3), 2) AS DOUBLE) AS monetary
  FROM stays GROUP BY reviewer_id),
rfm AS (
  SELECT m.*, f.neighbourhood AS favourite_neighbourhood
  FROM measures m JOIN favourites f ON m.reviewer_id IS NOT DISTINCT FROM f.reviewer_id)"""

_CUSTOMERS = """
customers AS (
  SELECT *, CASE
    WHEN recency <= 90 AND frequency >= 5 AND monetary >= 500 THEN 'Champions'
    WHEN recency <= 180 AND frequency >= 3 AND monetary >= 300 THEN 'Loyal'
    WHEN recency <= 365 AND frequency >= 1 AND monetary >= 50 THEN 'Potential'
    WHEN recency <= 730 AND frequency >= 2 AND monetary >= 100 THEN 'At Risk'
    WHEN recency <= 1000 AND frequency >= 1 AND monetary >= 10 THEN 'Hibernating'
    ELSE 'Lost' END AS segment
  FROM rfm)"""

_SIZES = """
sizes AS (SELECT segment, count(*) AS customers FROM customers GROUP BY segment)"""

_ACTIONS = """
actions(segment, channel, conv, basket, disc, cost, priority, expected_roi, offer, message) AS (
  VALUES
  ('Champions', 'Email VIP + Push Notification', 0.20, 1.20, 0.10, 0.002, 1, 'HIGH (4–6x)',
   '10% off and a late check-out on every stay',
   'Your room is yours until the afternoon of the last day.'),
  ('Loyal', 'Email personnalisé + SMS', 0.15, 1.10, 0.12, 0.052, 1, 'HIGH (3–5x)',
   '12% off for regular guests',
   'Regular guests pay less on the next booking.'),
  ('Potential', 'Email + Retargeting Display', 0.10, 1.00, 0.15, 0.022, 2, 'MEDIUM (2–4x)',
   '15% off the next booking',
   'Another stay costs less when booked this season.'),
  ('At Risk', 'Email Win-Back + SMS Urgent', 0.10, 0.95, 0.20, 0.052, 1, 'MEDIUM (2–3x)',
   '20% off with flexible dates',
   'Dates can be changed free of charge on your next trip.'),
  ('Hibernating', 'Email Automation + Display Remarketing', 0.07, 0.90, 0.25, 0.022, 2,
   'LOW–MEDIUM (1.5–2.5x)', '25% off any stay this year',
   'Any home, any week of the year, at a quarter less.'),
  ('Lost', 'Email low-cost (bulk)', 0.03, 0.80, 0.10, 0.002, 3, 'LOW (<=1.5x)',
   '10% off seasonal picks',
   'This season''s picks, chosen from every area.'))"""

# What the lines of a run history are made of: order years.
_RUNS = """
yearly AS (
  SELECT CAST(year(o_orderdate) AS VARCHAR) AS run_id,
         count(*) AS reviews, count(d.date) AS dated, count(d.raw_date) AS filled,
         count(*) FILTER (o_orderstatus = 'F') AS f,
         count(*) FILTER (o_orderstatus = 'O') AS o,
         count(*) FILTER (o_orderstatus = 'P') AS p
  FROM dated d JOIN orders ON o_orderkey = d.reviewer_id GROUP BY 1),
runs AS (
  SELECT run_id,
         run_id || '-12-31T00:00:00' AS timestamp,
         CASE WHEN run_id IN ('1997', '2001') THEN 'FAILED'
              WHEN dated % 3 <> 0 THEN 'SUCCESS' ELSE 'PARTIAL' END AS status,
         reviews / 16.0 AS total_duration_seconds,
         reviews / 20.0 AS load_seconds,
         reviews / 80.0 AS clean_seconds,
         reviews AS input_reviews,
         reviews + filled AS input_total,
         CASE WHEN run_id IN ('1997', '2001') THEN 0 ELSE dated END AS output_rows,
         3 * (reviews - dated) AS rows_filtered,
         dated % 3 <> 0 AS data_quality_passed,
         CAST(1 AS BIGINT) AS data_quality_warnings,
         dated % 5 AS data_quality_errors,
         f, o, p,
         CASE WHEN run_id IN ('1997', '2001') THEN 'load_data: no input; no input' ELSE '' END
           AS errors
  FROM yearly)"""

_TO_REVIEWS = [_REVIEWS]
_TO_DATED = [*_TO_REVIEWS, _DATED]
_TO_UNIQUE = [*_TO_DATED, _UNIQUE]
_TO_PRICED = [_LISTINGS, _PRICED]
_TO_CLEAN_LISTINGS = [*_TO_PRICED, _CLEAN_LISTINGS]
_TO_STAYS = [*_TO_UNIQUE, *_TO_CLEAN_LISTINGS, _STAYS]
_TO_RFM = [*_TO_STAYS, _RFM]
_TO_CUSTOMERS = [*_TO_RFM, _CUSTOMERS]
_TO_RUNS = [*_TO_DATED, _RUNS]


def _sql(tables: list[str], select: str) -> str:
    return "WITH" + ",".join(tables) + "\n" + select.strip()


def _of_customers(select: str) -> str:
    return _sql(_TO_CUSTOMERS, select)


def _of_segments(select: str) -> str:
    return _sql([*_TO_CUSTOMERS, _SIZES, _ACTIONS], select)


def _rules(tables: list[str], *rows: str) -> str:
    select = "\nUNION ALL\n".join(rows)
    return _sql(tables, select) if tables else select


def _completeness(table: str, column: str, minimum: float, severity: str) -> str:
    return f"""SELECT 'completeness_check_{column}' AS rule_name,
       count({column}) / count(*) >= {minimum} AS passed, '{severity}' AS severity,
       '{column} filled in at least {minimum:.1%} of rows' AS message,
       CAST(count({column}) / count(*) AS DOUBLE) AS metric_value,
       'completeness_{column}' AS metric_name FROM {table}"""


def _uniqueness(table: str, column: str, maximum: float) -> str:
    distinct = f"(count(DISTINCT {column}) + max(CASE WHEN {column} IS NULL THEN 1 ELSE 0 END))"
    return f"""SELECT 'uniqueness_{column}' AS rule_name,
       (count(*) - {distinct}) / count(*) <= {maximum} AS passed, 'WARNING' AS severity,
       '{column} repeated in at most {maximum:.1%} of rows' AS message,
       CAST((count(*) - {distinct}) / count(*) AS DOUBLE) AS metric_value,
       'duplicates_{column}_pct' AS metric_name FROM {table}"""


def _range(table: str, column: str, bounds: str, inside: str, maximum: float) -> str:
    outside = f"(count(*) - count(*) FILTER ({inside}))"
    return f"""SELECT 'range_{column}' AS rule_name,
       {outside} / count(*) <= {maximum} AS passed, 'WARNING' AS severity,
       '{column} outside {bounds} in at most {maximum:.1%} of rows' AS message,
       CAST({outside} / count(*) AS DOUBLE) AS metric_value,
       'outliers_{column}_pct' AS metric_name FROM {table}"""


def _fixed(
    name: str,
    passed: bool,
    severity: str,
    message: str,
    metric: str = "CAST(NULL AS DOUBLE)",
    metric_name: str = "CAST(NULL AS VARCHAR)",
) -> str:
    return f"""SELECT '{name}' AS rule_name, {str(passed).upper()} AS passed,
       '{severity}' AS severity, '{message}' AS message, {metric} AS metric_value,
       {metric_name} AS metric_name"""


def _schema(passed: bool, columns: int) -> str:
    return _fixed("schema_validation", passed, "ERROR", f"{columns} required columns")


def _freshness(name: str, column: str, days: int, table: str = "lineitem") -> str:
    age = f"date_diff('day', max(CAST({column} AS DATE)), DATE '2001-12-01')"
    return f"""SELECT 'freshness_{name}' AS rule_name, {age} <= {days} AS passed,
       'WARNING' AS severity, '{name} at most {days} days old' AS message,
       CAST({age} AS DOUBLE) AS metric_value, 'freshness_{name}_days' AS metric_name
       FROM {table}"""


_REVIEW_RULES = (
    _schema(True, 3),
    _completeness("reviews", "listing_id", 1.0, "ERROR"),
    _completeness("reviews", "date", 0.95, "WARNING"),
    _uniqueness("reviews", "id", 0.001),
)
_INSIDE_PRICE = "price_cleaned >= 10 AND price_cleaned <= 10000"

# Keeps the Latin-1 characters that form UTF-8 sequences and reads their bytes as UTF-8.
_REPAIR = """
SELECT doc_id, coalesce(decode(unhex(array_to_string(list_transform(
         string_split(array_to_string(regexp_extract_all(
           regexp_replace(text, '[^\\x{00}-\\x{FF}]', '', 'g'),
           '[\\x{00}-\\x{7F}]+|[\\x{C2}-\\x{DF}][\\x{80}-\\x{BF}]'
           || '|\\x{E0}[\\x{A0}-\\x{BF}][\\x{80}-\\x{BF}]'
           || '|[\\x{E1}-\\x{EC}\\x{EE}\\x{EF}][\\x{80}-\\x{BF}]{2}'
           || '|\\x{ED}[\\x{80}-\\x{9F}][\\x{80}-\\x{BF}]'
           || '|\\x{F0}[\\x{90}-\\x{BF}][\\x{80}-\\x{BF}]{2}'
           || '|[\\x{F1}-\\x{F3}][\\x{80}-\\x{BF}]{3}'
           || '|\\x{F4}[\\x{80}-\\x{8F}][\\x{80}-\\x{BF}]{2}'), ''), ''),
         lambda c: printf('%02x', unicode(c))), ''))), '') AS text
FROM documents"""

ORACLE_SQL: dict[str, str] = {
    "reviews_csv": _sql(
        _TO_REVIEWS,
        "SELECT id, listing_id, CAST(reviewer_id AS VARCHAR) AS reviewer_id, date FROM reviews",
    ),
    "listings_csv": _sql(
        [_LISTINGS],
        "SELECT id, nullif(price, '') AS price, "
        "nullif(neighbourhood_cleansed, '') AS neighbourhood_cleansed FROM listings",
    ),
    "reviews_dedup": "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem",
    "reviews_unique": _sql(
        _TO_REVIEWS, "SELECT DISTINCT listing_id, reviewer_id, date FROM reviews"
    ),
    "reviews_dates": _sql(
        _TO_DATED,
        "SELECT id, listing_id, reviewer_id, strftime(date, '%Y-%m-%d') AS date "
        "FROM dated WHERE date IS NOT NULL",
    ),
    "reviews_clean": _sql(
        _TO_UNIQUE,
        "SELECT listing_id, reviewer_id, strftime(date, '%Y-%m-%d') AS date "
        "FROM unique_reviews WHERE date IS NOT NULL",
    ),
    "listings_known_area": _sql(
        [_LISTINGS],
        "SELECT * FROM listings WHERE neighbourhood_cleansed IS NOT NULL "
        "AND neighbourhood_cleansed NOT IN ('', 'Unknown')",
    ),
    "listings_price": _sql(
        _TO_PRICED, "SELECT * FROM priced WHERE price_cleaned BETWEEN 10 AND 10000"
    ),
    "listings_clean": _sql(_TO_CLEAN_LISTINGS, "SELECT * FROM clean_listings"),
    "cleaning_audit": _sql(
        [*_TO_UNIQUE, *_TO_CLEAN_LISTINGS],
        """
SELECT *, rows_before - rows_after AS rows_removed FROM (
  SELECT 'reviews' AS table_name, 1 AS step_no, 'duplicates' AS step,
         (SELECT count(*) FROM reviews)
           + (SELECT count(*) FROM lineitem WHERE l_returnflag = 'R') AS rows_before,
         (SELECT count(*) FROM unique_reviews) AS rows_after
  UNION ALL
  SELECT 'reviews', 2, 'dates', (SELECT count(*) FROM unique_reviews),
         (SELECT count(date) FROM unique_reviews)
  UNION ALL
  SELECT 'listings', 1, 'areas', (SELECT count(*) FROM listings),
         (SELECT count(*) FROM listings WHERE neighbourhood_cleansed NOT IN ('', 'Unknown'))
  UNION ALL
  SELECT 'listings', 2, 'prices',
         (SELECT count(*) FROM listings WHERE neighbourhood_cleansed NOT IN ('', 'Unknown')),
         (SELECT count(*) FROM clean_listings))""",
    ),
    "balanced_reviews": _sql(_TO_REVIEWS, "SELECT * FROM reviews"),
    "stays_join": _sql(
        _TO_STAYS,
        "SELECT listing_id, reviewer_id, strftime(date, '%Y-%m-%d') AS date, price_cleaned, "
        "neighbourhood FROM stays",
    ),
    "text_repair_always": _REPAIR.strip(),
    "text_repair_detect": "SELECT doc_id, text FROM documents",
    "rfm_metrics": _sql(_TO_RFM, "SELECT * FROM rfm"),
    "favourite_area": _sql(
        _TO_RFM,
        "SELECT reviewer_id, neighbourhood AS favourite_neighbourhood, n AS stays_there "
        "FROM favourites",
    ),
    "rfm_segments": _of_customers("SELECT * FROM customers"),
    "segment_counts": _of_customers(
        "SELECT segment, count(*) AS count FROM customers GROUP BY segment"
    ),
    "segments_present": _of_customers("""
SELECT segment, CAST(row_number() OVER (ORDER BY place, segment) AS INTEGER) AS position FROM (
  SELECT DISTINCT segment, CASE segment WHEN 'At Risk' THEN 1 WHEN 'Champions' THEN 2
    WHEN 'Potential' THEN 3 WHEN 'Loyal' THEN 4 WHEN 'Hibernating' THEN 5 ELSE 6 END AS place
  FROM customers)"""),
    "segment_members": _of_customers("SELECT * FROM customers WHERE segment = 'Champions'"),
    "segment_summary": _of_customers("""
SELECT segment, count(reviewer_id) AS customers,
       CAST(sum(CAST(monetary AS DECIMAL(18,2))) AS DOUBLE) / count(monetary) AS avg_ltv,
       CAST(sum(CAST(monetary AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue,
       avg(frequency) AS avg_frequency,
       round(count(reviewer_id) * 100.0 / sum(count(reviewer_id)) OVER (), 4) AS pct_of_total
FROM customers GROUP BY segment"""),
    "revenue_share": _of_customers("""
SELECT segment, CAST(revenue AS DOUBLE) AS revenue,
       round(CAST(revenue AS DOUBLE) * 100 / CAST(sum(revenue) OVER () AS DOUBLE), 4)
         AS revenue_pct
FROM (SELECT segment, sum(CAST(monetary AS DECIMAL(18,2))) AS revenue
      FROM customers GROUP BY segment)"""),
    "value_spread": _of_customers("""
SELECT segment, min(monetary) AS min_value,
       round(quantile_cont(monetary, 0.25), 4) AS q1,
       round(quantile_cont(monetary, 0.5), 4) AS median,
       round(quantile_cont(monetary, 0.75), 4) AS q3,
       max(monetary) AS max_value,
       CAST(sum(CAST(monetary AS DECIMAL(18,2))) AS DOUBLE) / count(monetary) AS mean_value
FROM customers GROUP BY segment"""),
    "segment_by_area": _of_customers("""
SELECT favourite_neighbourhood, segment, count(*) AS customers,
       CAST(sum(CAST(monetary AS DECIMAL(18,2))) AS DOUBLE) AS revenue
FROM customers GROUP BY ALL"""),
    "segment_by_region": _of_customers("""
SELECT r_name AS region, n_name AS nation, segment, count(*) AS customers,
       CAST(sum(CAST(monetary AS DECIMAL(18,2))) AS DOUBLE) AS revenue
FROM customers
LEFT JOIN orders ON o_orderkey = reviewer_id
LEFT JOIN customer ON c_custkey = o_custkey
LEFT JOIN nation ON n_nationkey = c_nationkey
LEFT JOIN region ON r_regionkey = n_regionkey
GROUP BY ALL"""),
    "area_metrics": _of_customers("""
SELECT favourite_neighbourhood,
       CAST(sum(CAST(monetary AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue,
       CAST(sum(CAST(monetary AS DECIMAL(18,2))) AS DOUBLE) / count(monetary)
         AS avg_customer_value,
       count(*) AS customer_count
FROM customers GROUP BY favourite_neighbourhood"""),
    "area_top20": _of_customers("""
SELECT favourite_neighbourhood,
       CAST(sum(CAST(monetary AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue,
       CAST(sum(CAST(monetary AS DECIMAL(18,2))) AS DOUBLE) / count(monetary)
         AS avg_customer_value,
       count(*) AS customer_count
FROM customers GROUP BY favourite_neighbourhood
ORDER BY total_revenue DESC, favourite_neighbourhood LIMIT 20"""),
    "area_top10": _of_customers("""
SELECT favourite_neighbourhood,
       CAST(sum(CAST(monetary AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue,
       count(*) AS customer_count
FROM customers GROUP BY favourite_neighbourhood
ORDER BY total_revenue DESC, favourite_neighbourhood LIMIT 10"""),
    "kpis": _of_customers("""
SELECT count(*) AS total_customers,
       CAST(sum(CAST(monetary AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue,
       CAST(sum(CAST(monetary AS DECIMAL(18,2))) AS DOUBLE) / count(monetary) AS avg_ltv,
       count(*) FILTER (segment = 'Champions') AS champions_count,
       round(count(*) FILTER (segment = 'Champions') * 100.0 / count(*), 4) AS champions_pct
FROM customers"""),
    "priority_customers": _of_customers("""
SELECT reviewer_id, segment, recency, frequency, monetary, favourite_neighbourhood
FROM customers WHERE segment IN ('Champions', 'At Risk', 'Loyal', 'Potential')
ORDER BY monetary DESC, reviewer_id LIMIT 50"""),
    "high_value_customers": _of_customers("""
SELECT reviewer_id, segment, recency, frequency, monetary, favourite_neighbourhood
FROM customers WHERE segment IN ('Champions', 'At Risk', 'Loyal', 'Potential')"""),
    "high_value_csv": _of_customers("""
SELECT CAST(reviewer_id AS VARCHAR) AS reviewer_id, segment, CAST(recency AS VARCHAR) AS recency,
       CAST(frequency AS VARCHAR) AS frequency, monetary, favourite_neighbourhood
FROM customers WHERE segment IN ('Champions', 'At Risk', 'Loyal', 'Potential')"""),
    "customer_sample": _of_customers("""
SELECT * FROM customers
ORDER BY md5(CAST(reviewer_id AS VARCHAR) || '|42'), reviewer_id LIMIT 5000"""),
    "rfm_quintiles": _of_customers("""
SELECT reviewer_id, r_score, f_score, m_score,
       CAST(r_score AS VARCHAR) || f_score || m_score AS rfm_score
FROM (
  SELECT reviewer_id,
         CAST(1 + len(list_filter(r, lambda q: recency < q)) AS INTEGER) AS r_score,
         CAST(1 + len(list_filter(f, lambda q: frequency > q)) AS INTEGER) AS f_score,
         CAST(1 + len(list_filter(m, lambda q: monetary > q)) AS INTEGER) AS m_score
  FROM customers, (
    SELECT quantile_cont(CAST(recency AS DOUBLE), [0.2, 0.4, 0.6, 0.8]) AS r,
           quantile_cont(CAST(frequency AS DOUBLE), [0.2, 0.4, 0.6, 0.8]) AS f,
           quantile_cont(monetary, [0.2, 0.4, 0.6, 0.8]) AS m
    FROM customers))"""),
    "segment_actions": _of_segments("""
SELECT s.segment, customers, channel, offer, message, priority, expected_roi,
       CAST(conv AS DOUBLE) AS conversion_rate, CAST(basket AS DOUBLE) AS basket_multiplier,
       CAST(disc AS DOUBLE) AS discount_rate, CAST(cost AS DOUBLE) AS channels_cost_per_user
FROM sizes s JOIN actions a ON a.segment = s.segment"""),
    "channel_cost": _of_segments("""
SELECT s.segment, channel, customers, CAST(cost AS DOUBLE) AS cost_per_user,
       CAST(round(CAST(customers AS DECIMAL(14,0)) * cost, 2) AS DOUBLE) AS total_cost
FROM sizes s JOIN actions a ON a.segment = s.segment"""),
    "campaign_impact": _of_segments("""
SELECT segment, CAST(round(revenue, 2) AS DOUBLE) AS revenue,
       CAST(round(margin, 2) AS DOUBLE) AS margin_before_discount,
       CAST(round(discount, 2) AS DOUBLE) AS discount_cost,
       CAST(round(media, 2) AS DOUBLE) AS media_cost,
       CAST(round(discount + media, 2) AS DOUBLE) AS total_marketing_cost,
       CAST(round(margin - discount - media, 2) AS DOUBLE) AS net_profit,
       round(CAST(margin - discount - media AS DOUBLE) / CAST(discount + media AS DOUBLE), 2)
         AS roi
FROM (
  SELECT segment, revenue, revenue * 0.60 AS margin, revenue * disc AS discount, n * cost AS media
  FROM (
    SELECT s.segment, CAST(customers AS DECIMAL(12,0)) AS n, disc, cost,
           CAST(customers AS DECIMAL(12,0)) * conv * basket * 300.0 AS revenue
    FROM sizes s JOIN actions a ON a.segment = s.segment))"""),
    "segment_plan": _of_segments("""
SELECT plan_rank, p.segment, priority, action, budget,
       CAST(coalesce(customers, 0) AS BIGINT) AS customers
FROM (VALUES
  (1, 'Champions', 'CRITICAL', 'Max retention', '25%'),
  (2, 'At Risk', 'URGENT', 'Immediate win-back', '20%'),
  (3, 'Loyal', 'HIGH', 'Upselling + Referral', '20%'),
  (4, 'Potential', 'MEDIUM', 'Conversion', '15%'),
  (5, 'Hibernating', 'MEDIUM', 'Reactivation', '10%'),
  (6, 'Lost', 'LOW', 'Maintenance', '10%')) p(plan_rank, segment, priority, action, budget)
LEFT JOIN sizes s ON s.segment = p.segment"""),
    "campaign_projection": _of_customers("""
SELECT 'Potential' AS segment, count(*) AS audience,
       CAST(floor(count(*) * 10 / 100) AS BIGINT) AS expected_conversions,
       CAST(floor(count(*) * 10 / 100) * 100 AS DOUBLE) AS projected_revenue
FROM customers WHERE segment = 'Potential'"""),
    "area_pricing": _sql(
        _TO_STAYS,
        """
SELECT neighbourhood, count(*) AS stays, count(DISTINCT reviewer_id) AS guests,
       round(quantile_cont(price_cleaned, 0.25), 4) AS price_q1,
       round(quantile_cont(price_cleaned, 0.5), 4) AS price_median,
       round(quantile_cont(price_cleaned, 0.75), 4) AS price_q3
FROM stays GROUP BY neighbourhood""",
    ),
    "dq_schema": _rules(
        _TO_REVIEWS,
        _schema(True, 2),
        _schema(False, 2),
        _fixed(
            "schema_validation", True, "ERROR", "2 required columns, extra columns counted",
            "CAST(2 AS DOUBLE)", "'extra_columns'",
        ),
        _completeness("reviews", "date", 0.9, "WARNING"),
    ),
    "dq_completeness": _rules(
        _TO_REVIEWS,
        *(
            _completeness("reviews", c, 0.98, "ERROR")
            for c in ("listing_id", "reviewer_id", "date")
        ),
    ),
    "dq_uniqueness": _rules(
        _TO_REVIEWS, _uniqueness("reviews", "id", 0.25), _uniqueness("reviews", "date", 0.25)
    ),
    "dq_range": _rules(
        [],
        _range("lineitem", "l_quantity", "[1, 45]", "l_quantity >= 1 AND l_quantity <= 45", 0.05),
        _range("lineitem", "l_discount", "[None, 0.1]", "l_discount <= 0.1", 0.05),
        _range("lineitem", "l_extendedprice", "[5000, None]", "l_extendedprice >= 5000", 0.01),
        _fixed(
            "range_l_tax", True, "WARNING", "l_tax outside [None, None] in at most 5.0% of rows",
            "CAST(0 AS DOUBLE)", "'outliers_l_tax_pct'",
        ),
        _range(
            "lineitem", "line_text", "[2, 20000]",
            "l_quantity >= 30 AND l_linenumber BETWEEN 2 AND 20000", 0.05,
        ),
    ),
    "dq_freshness": _rules(
        _TO_DATED,
        _freshness("stamp", "l_shipdate", 30),
        _freshness("day", "l_shipdate", 20),
        _freshness("text", "strftime(l_shipdate, '%Y-%m-%d')", 30),
        _freshness("date", "date", 30, "dated"),
    ),
    "dq_custom_rule": _rules(
        [],
        """SELECT 'few_returns' AS rule_name,
       count(*) FILTER (l_returnflag = 'R') / count(*) <= 0.25 AS passed, 'WARNING' AS severity,
       'at most a quarter of the lines returned' AS message,
       CAST(count(*) FILTER (l_returnflag = 'R') AS DOUBLE) AS metric_value,
       'returns' AS metric_name FROM lineitem""",
        _fixed(
            "completeness_check_nowhere", False, "ERROR", "failed", metric_name="'completeness_nowhere'"
        ),
    ),
    "dq_reviews_report": _rules(_TO_REVIEWS, *_REVIEW_RULES),
    "dq_listings_report": _rules(
        _TO_PRICED,
        _schema(True, 3),
        _completeness("priced", "id", 1.0, "ERROR"),
        _completeness("priced", "price", 0.8, "WARNING"),
        _range("priced", "price_cleaned", "[10, 10000]", _INSIDE_PRICE, 0.05),
    ),
    "dq_clean_tables": _sql(
        [
            *_TO_UNIQUE,
            *_TO_CLEAN_LISTINGS,
            "\nclean_reviews AS (SELECT * FROM unique_reviews WHERE date IS NOT NULL)",
        ],
        "SELECT *, 'reviews' AS table_name FROM ("
        + "\nUNION ALL\n".join(
            (
                _schema(True, 3),
                _completeness("clean_reviews", "listing_id", 1.0, "ERROR"),
                _completeness("clean_reviews", "date", 0.95, "WARNING"),
            )
        )
        + ")\nUNION ALL\nSELECT *, 'listings' AS table_name FROM ("
        + "\nUNION ALL\n".join(
            (
                _schema(True, 3),
                _completeness("clean_listings", "listing_id", 1.0, "ERROR"),
                _completeness("clean_listings", "price_cleaned", 0.8, "WARNING"),
                _range("clean_listings", "price_cleaned", "[10, 10000]", _INSIDE_PRICE, 0.05),
                _uniqueness("clean_listings", "listing_id", 0.0),
            )
        )
        + ")",
    ),
    "dq_totals": _sql(
        [*_TO_REVIEWS, *_TO_PRICED],
        """
SELECT count(*) AS checks,
       count(*) FILTER (NOT passed AND severity = 'ERROR') AS errors,
       count(*) FILTER (NOT passed AND severity = 'WARNING') AS warnings,
       count(*) FILTER (NOT passed AND severity = 'ERROR') = 0 AS passed
FROM ("""
        + "\nUNION ALL\n".join(
            (
                *_REVIEW_RULES,
                _schema(True, 3),
                _completeness("priced", "id", 1.0, "ERROR"),
                _completeness("priced", "price", 0.8, "WARNING"),
                _fixed("range_price_cleaned", False, "ERROR", "failed"),
            )
        )
        + ")",
    ),
    "run_metrics": _sql(
        _TO_RUNS,
        """
SELECT run_id, timestamp, status, CAST(total_duration_seconds AS DOUBLE)
         AS total_duration_seconds,
       CAST(load_seconds AS DOUBLE) AS load_seconds,
       CAST(clean_seconds AS DOUBLE) AS clean_seconds,
       input_reviews, input_total,
       round(rows_filtered * 100.0 / input_total, 4) AS filtered_pct,
       output_rows, rows_filtered, data_quality_passed, data_quality_warnings,
       data_quality_errors, f AS segment_f, errors
FROM runs""",
    ),
    "run_alerts": _sql(
        _TO_RUNS,
        """
SELECT run_id, 'SLOW' AS alert,
       'took ' || CAST(round(CAST(total_duration_seconds AS DOUBLE)) AS BIGINT)
         || ' s, limit 400 s' AS detail
FROM runs WHERE total_duration_seconds > 400
UNION ALL
SELECT run_id, 'HIGH FILTER RATE',
       printf('%.1f%% rows filtered', round(CAST(rows_filtered * 100.0 / input_total AS DOUBLE), 1))
FROM runs WHERE output_rows > 0 AND rows_filtered * 100.0 / input_total > 11.85
UNION ALL
SELECT run_id, 'DATA QUALITY', data_quality_errors || ' errors'
FROM runs WHERE NOT data_quality_passed
UNION ALL
SELECT run_id, 'PIPELINE FAILED', errors FROM runs WHERE status = 'FAILED'""",
    ),
    "run_shares": _sql(
        _TO_RUNS,
        """
SELECT run_id, 'stage' AS kind, 'load_data' AS name, CAST(load_seconds AS DOUBLE) AS amount,
       round(load_seconds / total_duration_seconds * 100, 4) AS pct FROM runs
UNION ALL
SELECT run_id, 'stage', 'clean_data', CAST(clean_seconds AS DOUBLE),
       round(clean_seconds / total_duration_seconds * 100, 4) FROM runs
"""
        + "".join(
            f"""UNION ALL
SELECT run_id, 'segment', '{s.upper()}', CAST({s} AS DOUBLE),
       CASE WHEN output_rows = 0 THEN 0.0
            ELSE round(CAST({s} AS DOUBLE) / output_rows * 100.0, 4) END FROM runs
"""
            for s in "fop"
        ),
    ),
    "reviews_new_only": _sql(
        [_REVIEWS.replace("FROM lineitem", ", l_returnflag AS flag FROM lineitem")],
        """
SELECT listing_id, reviewer_id, date FROM reviews WHERE flag IN ('N', 'R')
EXCEPT
SELECT listing_id, reviewer_id, date FROM reviews WHERE flag IN ('A', 'R')""",
    ),
    "value_by_levels": _of_customers("""
SELECT CAST(grouping_id(segment, favourite_neighbourhood, r_name) AS INTEGER) AS level,
       segment, favourite_neighbourhood AS area, r_name AS region, count(*) AS customers,
       CAST(sum(CAST(monetary AS DECIMAL(18,2))) AS DOUBLE) AS revenue
FROM customers
LEFT JOIN orders ON o_orderkey = reviewer_id
LEFT JOIN customer ON c_custkey = o_custkey
LEFT JOIN nation ON n_nationkey = c_nationkey
LEFT JOIN region ON r_regionkey = n_regionkey
GROUP BY CUBE (segment, favourite_neighbourhood, r_name)"""),
    "guests_by_year": _sql(
        _TO_DATED,
        """
SELECT CAST(year(date) AS INTEGER) AS year, count(*) AS reviews,
       count(DISTINCT reviewer_id) AS guests, true AS estimate_close
FROM dated WHERE date IS NOT NULL GROUP BY ALL""",
    ),
    "run_deviations": _sql(
        [
            *_TO_RUNS,
            """
measured AS (
  SELECT run_id, timestamp, status <> 'FAILED' AS fine,
         CAST(total_duration_seconds AS DOUBLE) AS seconds,
         CAST(rows_filtered AS DOUBLE) / input_total * 100.0 AS pct
  FROM runs),
usual AS (
  SELECT *,
         quantile_cont(CASE WHEN fine THEN seconds END, 0.5) OVER before AS usual_seconds,
         quantile_cont(CASE WHEN fine THEN pct END, 0.5) OVER before AS usual_pct
  FROM measured
  WINDOW before AS (ORDER BY timestamp, run_id ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING))""",
        ],
        """
SELECT run_id, round(seconds, 4) AS seconds, round(usual_seconds, 4) AS usual_seconds,
       round(pct, 4) AS filtered_pct, round(usual_pct, 4) AS usual_filtered_pct,
       coalesce(seconds / usual_seconds > 1.01 OR pct - usual_pct > 0.1, false) AS deviates
FROM usual""",
    ),
}
# Deliveries in any order and number leave what all reviews at once give.
ORACLE_SQL["rfm_after_delivery"] = ORACLE_SQL["rfm_segments"]
