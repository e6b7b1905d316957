"""Independent DuckDB SQL for every SQL-expressible registered query.

Each query is ``WITH <layers> <select>``; the layers restate the operator
semantics in plain SQL over the driver's tables (adapter of FIXTURES.md §2 ->
bronze -> clean -> marts). Rules that keep the engines comparable:

* explicit casts to Spark's result types (int vs bigint);
* DuckDB ``dayofweek`` is 0-based from Sunday, Spark's 1-based;
* NULL ordering is spelled out (DuckDB sorts NULLs last by default);
* double outputs are rounded to ``PLACES`` the way Spark's ``round`` does it
  (HALF_UP on the shortest decimal text of the double).
"""

from __future__ import annotations

INGESTED_AT = "2001-08-02 00:00:00"
AS_OF = "2001-08-01"
PLACES = 4
# Comparison rounding is applied to ``x + NUDGE``: the data's money values are
# exact decimals (multiples of 1e-8) computed in binary floating point, so
# their sums sit exactly on rounding midpoints where 1-ulp summation noise
# picks the side. The nudge (off the 1e-8 grid, far above the noise) moves
# every midpoint away from the data, so both engines round the same way.
NUDGE = 3.7e-9


def r(expr: str, places: int = 2) -> str:
    """DuckDB spelling of Spark's ``round`` on a double: HALF_UP applied to the
    shortest decimal text of the value (not to its exact binary expansion)."""
    return f"CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,17)), {places}) AS DOUBLE)"


RAW = """raw AS (
  SELECT
    CASE WHEN l_returnflag = 'R' AND l_orderkey % 8 = 0 THEN concat('C', CAST(o_orderkey AS VARCHAR)) ELSE CAST(o_orderkey AS VARCHAR) END AS InvoiceNo,
    concat(' p', CAST(l_partkey AS VARCHAR), ' ') AS StockCode,
    CASE WHEN l_partkey % 50 = 0 THEN NULL WHEN l_partkey % 40 = 1 AND l_linenumber = 7 THEN concat(p_name, ' v2') ELSE p_name END AS Description,
    CAST(CASE WHEN l_returnflag = 'R' AND l_orderkey % 4 = 0 THEN -l_quantity ELSE l_quantity END AS INT) AS Quantity,
    CASE WHEN o_orderkey % 500 = 1 THEN NULL
         ELSE o_orderdate + to_hours(CAST(o_orderkey % 24 AS INT)) + to_minutes(CAST((o_orderkey * 7) % 60 AS INT)) END AS InvoiceDate,
    CASE WHEN l_suppkey % 40 = 3 AND l_linenumber = 7 THEN NULL WHEN l_suppkey % 40 = 5 AND l_linenumber = 7 THEN -1.0
         ELSE l_extendedprice / l_quantity / (CASE l_partkey % 3 WHEN 0 THEN 20000 WHEN 1 THEN 8000 ELSE 1000 END) END AS UnitPrice,
    CASE WHEN o_custkey % 25 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS CustomerID,
    CASE WHEN o_custkey % 30 = 1 AND o_orderkey % 2 = 0 THEN 'NATION_0' WHEN o_orderkey % 200 = 7 THEN concat(n_name, ' ') ELSE n_name END AS Country
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey
)"""

BRONZE = f"""bronze AS (
  SELECT InvoiceNo, StockCode, Description, Quantity,
    coalesce(strftime(InvoiceDate, '%-m/%-d/%Y %-H:%M'), 'n/a') AS InvoiceDate,
    UnitPrice, CustomerID, Country,
    TIMESTAMP '{INGESTED_AT}' AS ingestion_timestamp,
    'lineitem.parquet' AS source_file,
    'v1.0' AS bronze_layer_version,
    sha256(concat_ws('|', InvoiceNo, StockCode, coalesce(strftime(InvoiceDate, '%-m/%-d/%Y %-H:%M'), 'n/a'))) AS record_hash,
    InvoiceDate AS _ts
  FROM raw
)"""

CLEAN = """parsed AS (
  SELECT InvoiceNo, trim(upper(StockCode)) AS StockCode, coalesce(trim(Description), 'UNKNOWN') AS Description,
    Quantity, InvoiceDate, UnitPrice,
    TRY_CAST(TRY_CAST(CustomerID AS DOUBLE) AS INTEGER) AS CustomerID,
    trim(Country) AS Country, ingestion_timestamp, source_file, bronze_layer_version, record_hash,
    _ts AS invoice_datetime
  FROM bronze
  WHERE _ts IS NOT NULL AND Quantity IS NOT NULL AND UnitPrice IS NOT NULL AND UnitPrice >= 0
),
enriched AS (
  SELECT *,
    CAST(Quantity AS DOUBLE) * UnitPrice AS total_price,
    coalesce(Quantity < 0, false) AS is_return,
    coalesce(starts_with(InvoiceNo, 'C'), false) AS is_cancellation,
    CAST(year(invoice_datetime) AS INTEGER) AS year,
    CAST(month(invoice_datetime) AS INTEGER) AS month,
    CAST(day(invoice_datetime) AS INTEGER) AS day,
    CAST(dayofweek(invoice_datetime) + 1 AS INTEGER) AS day_of_week,
    CAST(hour(invoice_datetime) AS INTEGER) AS hour,
    CAST(quarter(invoice_datetime) AS INTEGER) AS quarter,
    coalesce(dayofweek(invoice_datetime) IN (0, 6), false) AS is_weekend
  FROM parsed
),
clean AS (
  SELECT * EXCLUDE (_rn) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY record_hash
      ORDER BY ingestion_timestamp DESC NULLS LAST, Quantity ASC NULLS FIRST, UnitPrice ASC NULLS FIRST,
               Description ASC NULLS FIRST, CustomerID ASC NULLS FIRST, Country ASC NULLS FIRST) AS _rn
    FROM enriched) t
  WHERE _rn = 1
),
v AS (SELECT * FROM clean WHERE NOT is_return AND NOT is_cancellation),
vk AS (SELECT * FROM v WHERE CustomerID IS NOT NULL)"""

CUSTOMERS = f"""customers AS (
  SELECT CustomerID, Country,
    min(invoice_datetime) AS first_purchase_date,
    max(invoice_datetime) AS last_purchase_date,
    count(InvoiceNo) AS total_transactions,
    sum(total_price) AS total_spent,
    avg(total_price) AS avg_transaction_value,
    count(InvoiceNo) AS unique_products_purchased,
    CAST(date_diff('day', CAST(min(invoice_datetime) AS DATE), CAST(max(invoice_datetime) AS DATE)) AS INTEGER) AS customer_lifetime_days,
    CAST(date_diff('day', CAST(max(invoice_datetime) AS DATE), DATE '{AS_OF}') AS INTEGER) AS days_since_last_purchase,
    CAST(date_diff('day', CAST(min(invoice_datetime) AS DATE), CAST(max(invoice_datetime) AS DATE)) AS DOUBLE) / count(InvoiceNo) AS avg_days_between_purchases
  FROM vk GROUP BY CustomerID, Country
)"""

C360 = """percust AS (
  SELECT CustomerID,
    max(invoice_datetime) AS _last,
    count(InvoiceNo) AS frequency,
    sum(total_price) AS monetary,
    avg(total_price) AS avg_order_value,
    max(total_price) AS max_order_value,
    min(total_price) AS min_order_value,
    count(*) AS unique_invoices,
    sum(total_price) / count(*) AS avg_basket_value,
    avg(Quantity) AS avg_items_per_transaction,
    count(StockCode) AS unique_products,
    count(Description) AS unique_categories,
    avg(CASE WHEN is_weekend THEN 1 ELSE 0 END) AS weekend_purchase_ratio,
    avg(hour) AS avg_purchase_hour
  FROM vk GROUP BY CustomerID
),
rfm AS (
  SELECT *, CAST(date_diff('day', CAST(_last AS DATE), (SELECT CAST(max(invoice_datetime) AS DATE) FROM vk)) AS INTEGER) AS recency_days
  FROM percust
),
scored AS (
  SELECT *,
    CAST(6 - ntile(5) OVER (ORDER BY recency_days, CustomerID) AS INTEGER) AS r_score,
    CAST(ntile(5) OVER (ORDER BY frequency, CustomerID) AS INTEGER) AS f_score,
    CAST(ntile(5) OVER (ORDER BY monetary, CustomerID) AS INTEGER) AS m_score
  FROM rfm
),
seg AS (
  SELECT *,
    concat(r_score, f_score, m_score) AS rfm_score,
    CASE WHEN r_score >= 4 AND f_score >= 4 THEN 'Champions'
         WHEN r_score >= 3 AND f_score >= 3 THEN 'Loyal Customers'
         WHEN r_score >= 4 AND f_score <= 2 THEN 'Promising'
         WHEN r_score <= 2 AND f_score >= 4 THEN 'At Risk'
         WHEN r_score <= 2 AND f_score <= 2 THEN 'Hibernating'
         ELSE 'Potential Loyalists' END AS customer_segment
  FROM scored
),
c360 AS (
  SELECT c.*, s.recency_days, s.frequency, s.monetary, s.r_score, s.f_score, s.m_score, s.rfm_score,
    s.customer_segment, s.avg_order_value, s.max_order_value, s.min_order_value, s.unique_invoices,
    s.avg_basket_value, s.avg_items_per_transaction, s.unique_products, s.unique_categories,
    s.weekend_purchase_ratio, s.avg_purchase_hour
  FROM customers c LEFT JOIN seg s ON c.CustomerID = s.CustomerID
)"""

PRODUCTS = """plines AS (
  SELECT StockCode, Description,
    count(InvoiceNo) AS times_purchased,
    CAST(sum(Quantity) AS BIGINT) AS total_quantity_sold,
    avg(UnitPrice) AS avg_price,
    min(UnitPrice) AS min_price,
    max(UnitPrice) AS max_price,
    sum(total_price) AS total_revenue,
    count(*) AS unique_customers
  FROM v GROUP BY StockCode, Description
),
products AS (
  SELECT *,
    CAST(total_quantity_sold AS DOUBLE) / times_purchased AS avg_quantity_per_order,
    total_revenue / unique_customers AS revenue_per_customer
  FROM plines
)"""

PRODUCT_METRICS = """perf AS (
  SELECT StockCode,
    sum(total_price) AS total_revenue,
    CAST(sum(Quantity) AS BIGINT) AS total_quantity_sold,
    count(*) AS unique_buyers,
    avg(total_price) AS avg_transaction_value,
    count(InvoiceNo) AS purchase_frequency
  FROM v GROUP BY StockCode
),
pjoined AS (
  SELECT p.StockCode, p.Description, p.times_purchased, p.avg_price, p.min_price, p.max_price,
    p.unique_customers, p.avg_quantity_per_order, p.revenue_per_customer,
    f.total_revenue, f.total_quantity_sold, f.unique_buyers, f.avg_transaction_value, f.purchase_frequency
  FROM products p LEFT JOIN perf f ON p.StockCode = f.StockCode
),
pq AS (
  SELECT quantile_disc(total_revenue, 0.8) AS q80, quantile_disc(total_revenue, 0.5) AS q50,
         quantile_disc(total_revenue, 0.2) AS q20
  FROM pjoined
),
pm AS (
  SELECT pjoined.*,
    CASE WHEN total_revenue >= q80 THEN 'Star Products'
         WHEN total_revenue >= q50 THEN 'Good Performers'
         WHEN total_revenue >= q20 THEN 'Average'
         ELSE 'Underperformers' END AS performance_category
  FROM pjoined CROSS JOIN pq
)"""

DAILY = """dsales AS (
  SELECT CAST(invoice_datetime AS DATE) AS date, Country,
    count(InvoiceNo) AS total_transactions,
    count(*) AS unique_customers,
    sum(total_price) AS total_revenue,
    avg(total_price) AS avg_transaction_value,
    CAST(sum(Quantity) AS BIGINT) AS total_items_sold,
    count(StockCode) AS unique_products_sold
  FROM v GROUP BY 1, 2
),
daily AS (
  SELECT *,
    CAST(year(date) AS INTEGER) AS year,
    CAST(month(date) AS INTEGER) AS month,
    CAST(quarter(date) AS INTEGER) AS quarter,
    CAST(date_trunc('week', date) AS TIMESTAMP) AS day_of_week,
    avg(total_revenue) OVER (PARTITION BY Country ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS revenue_ma_7d,
    avg(total_revenue) OVER (PARTITION BY Country ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS revenue_ma_30d,
    avg(total_transactions) OVER (PARTITION BY Country ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS transactions_ma_7d
  FROM dsales
)"""

COUNTRY = f"""csales AS (
  SELECT Country,
    count(*) AS unique_customers,
    count(InvoiceNo) AS total_transactions,
    sum(total_price) AS total_revenue,
    avg(total_price) AS avg_order_value,
    CAST(sum(Quantity) AS BIGINT) AS total_items_sold,
    count(StockCode) AS unique_products
  FROM v GROUP BY Country
),
country AS (
  SELECT *,
    {r("(total_revenue / (SELECT sum(total_price) FROM v)) * 100")} AS revenue_share,
    {r("total_revenue / unique_customers")} AS revenue_per_customer
  FROM csales
)"""

CUSTOMER_FEATURES = f"""lf AS (
  SELECT CustomerID,
    count(InvoiceNo) AS purchase_frequency_fe,
    avg(total_price) AS avg_transaction_value_fe,
    stddev_samp(total_price) AS std_transaction_value,
    max(total_price) AS max_transaction_value_fe,
    min(total_price) AS min_transaction_value_fe,
    avg(Quantity) AS avg_items_per_order_fe,
    max(Quantity) AS max_items_per_order,
    count(StockCode) AS total_products_purchased,
    CAST(count(StockCode) AS INTEGER) AS unique_products_fe,
    avg(CASE WHEN is_weekend THEN 1 ELSE 0 END) AS weekend_purchase_ratio_fe,
    avg(hour) AS avg_purchase_hour_fe,
    stddev_samp(hour) AS std_purchase_hour,
    sum(total_price) AS total_lifetime_value_fe,
    sum(total_price) / count(InvoiceNo) AS avg_basket_value_fe,
    sum(CASE WHEN date_diff('day', CAST(invoice_datetime AS DATE), DATE '{AS_OF}') <= 30 THEN total_price ELSE 0 END) AS spending_last_30_days,
    sum(CASE WHEN date_diff('day', CAST(invoice_datetime AS DATE), DATE '{AS_OF}') <= 90 THEN total_price ELSE 0 END) AS spending_last_90_days,
    count(StockCode) AS product_variety,
    CAST(count(DISTINCT StockCode) AS INTEGER) AS unique_stock_codes,
    count(InvoiceNo) AS total_invoices_fe,
    CAST(date_diff('day', CAST(max(invoice_datetime) AS DATE), DATE '{AS_OF}') AS INTEGER) AS recency_days_fe,
    CAST(date_diff('day', CAST(min(invoice_datetime) AS DATE), CAST(max(invoice_datetime) AS DATE)) AS INTEGER) AS customer_age_days_fe
  FROM vk GROUP BY CustomerID
),
gapsrc AS (
  SELECT CustomerID,
    CAST(date_diff('day', CAST(lag(invoice_datetime) OVER (PARTITION BY CustomerID ORDER BY invoice_datetime) AS DATE),
                   CAST(invoice_datetime AS DATE)) AS INTEGER) AS gap
  FROM vk
),
gf AS (
  SELECT CustomerID, avg(gap) AS avg_days_between_purchases_fe, stddev_samp(gap) AS std_days_between_purchases,
    min(gap) AS min_days_between_purchases, max(gap) AS max_days_between_purchases
  FROM gapsrc GROUP BY CustomerID
),
cf0 AS (
  SELECT c.*,
    lf.purchase_frequency_fe, lf.avg_transaction_value_fe, lf.std_transaction_value, lf.max_transaction_value_fe,
    lf.min_transaction_value_fe, lf.avg_items_per_order_fe, lf.max_items_per_order, lf.total_products_purchased,
    lf.unique_products_fe, lf.weekend_purchase_ratio_fe, lf.avg_purchase_hour_fe, lf.std_purchase_hour,
    gf.avg_days_between_purchases_fe, gf.std_days_between_purchases, gf.min_days_between_purchases,
    gf.max_days_between_purchases,
    lf.total_lifetime_value_fe, lf.avg_basket_value_fe, lf.spending_last_30_days, lf.spending_last_90_days,
    CASE WHEN lf.spending_last_90_days > 0 THEN lf.spending_last_30_days / lf.spending_last_90_days ELSE 0 END AS spending_trend_30_vs_90,
    lf.product_variety, lf.unique_stock_codes,
    lf.total_invoices_fe, lf.recency_days_fe, lf.customer_age_days_fe,
    CASE WHEN lf.customer_age_days_fe > 0 THEN lf.total_invoices_fe / (lf.customer_age_days_fe / 30.0) ELSE 0 END AS engagement_score_fe
  FROM c360 c LEFT JOIN lf ON c.CustomerID = lf.CustomerID LEFT JOIN gf ON c.CustomerID = gf.CustomerID
),
cf AS (
  SELECT * REPLACE (
      coalesce(std_transaction_value, 0) AS std_transaction_value,
      coalesce(std_purchase_hour, 0) AS std_purchase_hour,
      coalesce(avg_days_between_purchases_fe, 0) AS avg_days_between_purchases_fe,
      coalesce(std_days_between_purchases, 0) AS std_days_between_purchases,
      coalesce(min_days_between_purchases, 0) AS min_days_between_purchases,
      coalesce(max_days_between_purchases, 0) AS max_days_between_purchases),
    CASE WHEN frequency > 0 THEN monetary / frequency ELSE 0 END AS clv_to_frequency_ratio,
    CASE WHEN customer_age_days_fe > 0 THEN recency_days / customer_age_days_fe ELSE 0 END AS recency_to_age_ratio,
    ln(monetary + 1) AS log_monetary,
    sqrt(frequency) AS sqrt_frequency,
    CASE WHEN std_days_between_purchases > 0 THEN avg_days_between_purchases_fe / std_days_between_purchases ELSE 0 END AS purchase_regularity,
    coalesce(CASE WHEN avg_transaction_value_fe > 0 THEN std_transaction_value / avg_transaction_value_fe ELSE 0 END, 0) AS spending_consistency
  FROM cf0
)"""

PRODUCT_FEATURES = """pop AS (
  SELECT StockCode,
    count(InvoiceNo) AS purchase_count_fe,
    count(*) AS unique_buyers_fe,
    CAST(sum(Quantity) AS BIGINT) AS total_quantity_sold_fe,
    avg(UnitPrice) AS avg_price_fe,
    stddev_samp(UnitPrice) AS price_volatility
  FROM v GROUP BY StockCode
),
pf AS (
  SELECT pm.*, pop.purchase_count_fe, pop.unique_buyers_fe, pop.total_quantity_sold_fe, pop.avg_price_fe,
    coalesce(pop.price_volatility, 0) AS price_volatility,
    CASE WHEN unique_buyers > 0 THEN ln(unique_buyers + 1) ELSE 0 END AS popularity_score,
    CASE WHEN avg_transaction_value >= 10 THEN 'Premium' WHEN avg_transaction_value >= 5 THEN 'Mid-Range' ELSE 'Budget' END AS price_tier,
    CASE WHEN purchase_frequency > 0 THEN total_revenue / purchase_frequency ELSE 0 END AS velocity_score,
    CASE WHEN purchase_frequency > 0 THEN unique_buyers / purchase_frequency ELSE 0 END AS customer_concentration
  FROM pm LEFT JOIN pop ON pm.StockCode = pop.StockCode
)"""

TRANSACTION_FEATURES = """cstats AS (
  SELECT CustomerID, avg(total_price) AS customer_avg_price, stddev_samp(total_price) AS customer_std_price,
    avg(Quantity) AS customer_avg_quantity, stddev_samp(Quantity) AS customer_std_quantity
  FROM clean WHERE CustomerID IS NOT NULL GROUP BY CustomerID
),
tf AS (
  SELECT c.CustomerID, c.* EXCLUDE (CustomerID),
    s.customer_avg_price, s.customer_std_price, s.customer_avg_quantity, s.customer_std_quantity,
    CASE WHEN s.customer_std_price > 0 THEN (c.total_price - s.customer_avg_price) / s.customer_std_price ELSE 0 END AS price_zscore,
    CASE WHEN s.customer_std_quantity > 0 THEN (c.Quantity - s.customer_avg_quantity) / s.customer_std_quantity ELSE 0 END AS quantity_zscore,
    CASE WHEN c.hour >= 9 AND c.hour <= 17 THEN 1 ELSE 0 END AS is_business_hours,
    CASE WHEN c.hour >= 22 OR c.hour <= 6 THEN 1 ELSE 0 END AS is_night_purchase
  FROM clean c LEFT JOIN cstats s ON c.CustomerID = s.CustomerID
)"""

# Five documented centres in scaled space for the assignment queries (feature:
# value at each centre).
CENTRES = {
    "recency_days": [-0.6, 0.9, -0.4, 1.8, 0.1],
    "frequency": [1.2, 0.8, -0.7, -0.9, 0.0],
    "monetary": [1.3, 0.6, -0.7, -0.8, 0.1],
}


def _distance(i: int) -> str:
    return " + ".join(f"({c}_scaled - ({v[i]})) * ({c}_scaled - ({v[i]}))" for c, v in CENTRES.items())


def scaled_columns(columns) -> str:
    return ", ".join(f"({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER () AS {c}_scaled" for c in columns)


CENTRE_SEGMENTS = f"""scaled AS (
  SELECT *, {scaled_columns(CENTRES)} FROM cf WHERE frequency > 0 AND monetary > 0
),
measured AS (SELECT *, [{", ".join(_distance(i) for i in range(5))}] AS _d FROM scaled),
clustered AS (SELECT *, CAST(list_position(_d, list_min(_d)) - 1 AS INTEGER) AS cluster_id FROM measured),
cnames AS (
  SELECT cluster_id, CASE
      WHEN avg(recency_days) < 60 AND avg(frequency) > 5 AND avg(monetary) > 500 THEN 'Champions'
      WHEN avg(recency_days) < 90 AND avg(frequency) > 3 THEN 'Loyal Customers'
      WHEN avg(recency_days) < 60 AND avg(frequency) <= 3 THEN 'Promising'
      WHEN avg(recency_days) >= 180 AND avg(frequency) > 3 THEN 'At Risk'
      WHEN avg(recency_days) >= 180 THEN 'Hibernating'
      ELSE 'Needs Attention' END AS segment_name
  FROM clustered GROUP BY cluster_id
),
csegs AS (
  SELECT c.CustomerID, c.cluster_id, n.segment_name, c.recency_days, c.frequency, c.monetary, c.customer_segment,
    c.avg_transaction_value, c.unique_products, c.engagement_score_fe
  FROM clustered c JOIN cnames n ON c.cluster_id = n.cluster_id
)"""

# The features used for clustering, in vector order.
KMEANS_FEATURES = [
    "recency_days", "frequency", "monetary", "avg_transaction_value", "unique_products", "customer_age_days_fe",
    "engagement_score_fe", "spending_last_30_days", "spending_last_90_days",
]

# K-Means in SQL: maximin seeds and Lloyd rounds as recursive tables over points in
# fixed point (whole millionths of a standard deviation).
UNITS = 1_000_000


def _squares(x: str, c: str, n: int) -> str:
    return " + ".join(f"({x}[{i}] - {c}[{i}]) * ({x}[{i}] - {c}[{i}])" for i in range(1, n + 1))


def kmeans_layers(features, ks, rounds: int, name: str) -> str:
    """``<name>``: (k, cs), the centres of every k after at most ``rounds`` rounds."""
    n, top = len(features), max(ks)
    whole = ", ".join(
        f"coalesce(CAST(floor(({c} - avg({c}) OVER ()) / nullif(stddev_samp({c}) OVER (), 0) * {UNITS} + 0.5) AS BIGINT), 0)::DOUBLE"
        for c in features)
    means = ", ".join(f"sum(x[{i}]::BIGINT)::DOUBLE / count(*)::DOUBLE" for i in range(1, n + 1))
    near = f"list_transform(cs, lambda c: {_squares('x', 'c', n)})"
    return f"""prep AS MATERIALIZED (SELECT * FROM cf WHERE frequency > 0 AND monetary > 0),
points AS MATERIALIZED (SELECT CustomerID, Country, [{whole}] AS x FROM prep),
seeds AS (
  SELECT 1 AS i, [first(x ORDER BY {_squares('x', str([0.0] * n), n)}, CustomerID, Country)] AS cs FROM points
  UNION ALL
  SELECT any_value(i) + 1, list_append(any_value(cs), first(x ORDER BY list_min({near}) DESC, CustomerID, Country))
  FROM seeds CROSS JOIN points WHERE i < {top} HAVING count(*) > 0
),
rounds AS (
  SELECT 0 AS i, k, cs[1:k] AS cs, false AS still FROM (SELECT cs FROM seeds WHERE i = {top}) CROSS JOIN (SELECT unnest({list(ks)}) AS k)
  UNION ALL
  SELECT i + 1, k, new, new = cs FROM (
    SELECT *, list_transform(range(1, k + 1), lambda j: coalesce(m[j], cs[j])) AS new FROM (
      SELECT any_value(i) AS i, k, any_value(cs) AS cs, map(list(j), list(c)) AS m
      FROM (SELECT any_value(i) AS i, k, any_value(cs) AS cs, j, [{means}] AS c
            FROM (SELECT r.*, x, list_position({near}, list_min({near})) AS j FROM rounds r CROSS JOIN points WHERE i < {rounds} AND NOT still)
            GROUP BY k, j)
      GROUP BY k))
),
{name} AS MATERIALIZED (SELECT k, arg_max(cs, i) AS cs FROM rounds GROUP BY k)"""


def k_sweep_layers(features, ks, rounds: int) -> str:
    n = len(features)
    near = f"list_sort(list_transform(cs, lambda c: {_squares('x', 'c', n)}))"
    return kmeans_layers(features, ks, rounds, "swept") + f""",
rated AS (SELECT k, {near} AS d FROM swept CROSS JOIN points),
curve AS (
  SELECT CAST(k AS INTEGER) AS k, sum(d[1]) / {UNITS}::DOUBLE / {UNITS}::DOUBLE AS cost,
    avg(coalesce((sqrt(d[2]) - sqrt(d[1])) / nullif(greatest(sqrt(d[1]), sqrt(d[2])), 0), 0)) AS silhouette FROM rated GROUP BY k
),
ends AS (SELECT min(k) AS k0, max(k) AS k1, min(cost) AS c0, max(cost) AS c1, arg_min(cost, k) AS c_first, arg_max(cost, k) AS c_last FROM curve),
gaps AS (
  SELECT k, cost, silhouette,
    coalesce((c_first + (c_last - c_first) * (k - k0) / (k1 - k0) - cost) / nullif(c1 - c0, 0), 0) AS chord_gap FROM curve CROSS JOIN ends
),
ksweep AS (
  SELECT *, k = first_value(k) OVER (ORDER BY round(chord_gap, 9) DESC, k) AS is_knee,
    k = first_value(k) OVER (ORDER BY round(silhouette, 9) DESC, k) AS is_widest FROM gaps
)"""


def segment_layers(features, k: int, rounds: int) -> str:
    """``ksegs``: customers with the segment of their cluster."""
    n = len(features)
    near = f"list_transform(cs, lambda c: {_squares('x', 'c', n)})"
    return kmeans_layers(features, [k], rounds, "fitted") + f""",
kclustered AS MATERIALIZED (
  SELECT p.*, CAST(list_position({near}, list_min({near})) - 1 AS INTEGER) AS cluster_id
  FROM prep p JOIN points q ON p.CustomerID = q.CustomerID AND p.Country = q.Country CROSS JOIN fitted
),
""" + SEGMENT_NAMES.format(names="knames", source="kclustered", out="ksegs")


SEGMENT_NAMES = CENTRE_SEGMENTS[CENTRE_SEGMENTS.index("cnames AS"):].replace(
    "cnames", "{names}").replace("clustered", "{source}").replace("csegs", "{out}")

# Layer dependencies (each layer lists what it needs before it).
_LAYERS = {
    "raw": (RAW, []),
    "bronze": (BRONZE, ["raw"]),
    "clean": (CLEAN, ["bronze"]),
    "customers": (CUSTOMERS, ["clean"]),
    "c360": (C360, ["customers"]),
    "products": (PRODUCTS, ["clean"]),
    "pm": (PRODUCT_METRICS, ["products"]),
    "daily": (DAILY, ["clean"]),
    "country": (COUNTRY, ["clean"]),
    "cf": (CUSTOMER_FEATURES, ["c360"]),
    "csegs": (CENTRE_SEGMENTS, ["cf"]),
    "ksweep": (k_sweep_layers(KMEANS_FEATURES, range(2, 11), 20), ["cf"]),
    "ksegs": (segment_layers(KMEANS_FEATURES, 5, 100), ["cf"]),
    "pf": (PRODUCT_FEATURES, ["pm"]),
    "tf": (TRANSACTION_FEATURES, ["clean"]),
}


def _resolve(layer: str, seen: list[str]) -> None:
    if layer in seen:
        return
    for dep in _LAYERS[layer][1]:
        _resolve(dep, seen)
    seen.append(layer)


def with_layers(layer: str, select: str) -> str:
    order: list[str] = []
    _resolve(layer, order)
    return "WITH RECURSIVE " + ",\n".join(_LAYERS[name][0] for name in order) + "\n" + select


def rounded(select_sql: str, doubles: list[str], places: int = PLACES) -> str:
    """Wrap a query so its double columns are rounded like the Spark side."""
    if not doubles:
        return select_sql
    repl = ", ".join(f"{r(f'({c}) + {NUDGE}', places)} AS {c}" for c in doubles)
    return f"SELECT * REPLACE ({repl}) FROM (\n{select_sql}\n) q"
