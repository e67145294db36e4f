"""Model tables of the comparison SQL as common table expressions."""


def rnd(expr: str, digits: int) -> str:
    scale = f"{10**digits}.0::DOUBLE"
    return f"(floor(({expr})::DOUBLE * {scale} + 0.5::DOUBLE) / {scale})"


def pct(num: str, den: str) -> str:
    return f"(100.0::DOUBLE * ({num})::DOUBLE / nullif(({den})::DOUBLE, 0.0::DOUBLE))"


def avg(total: str, count: str) -> str:
    return f"(({total})::DOUBLE / nullif(({count})::DOUBLE, 0.0::DOUBLE))"


def half(ts: str) -> str:
    return f"CASE WHEN month({ts}) <= 6 THEN 'S1' ELSE 'S2' END"


ENTITIES = f"""
customers AS (
  SELECT c_custkey AS customer_id, c_custkey AS customer_unique_id, c_nationkey AS customer_zip_code_prefix,
         c_mktsegment AS city, n_name AS state
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
sellers AS (
  SELECT s_suppkey AS seller_id, s_name AS city, n_name AS state
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
products AS (
  SELECT p_partkey AS product_id, nullif(p_type, 'PROMO') AS product_category_name, p_size::DOUBLE AS weight_g
  FROM part),
translation AS (
  SELECT DISTINCT p_type AS name, lower(p_type) AS english FROM part WHERE p_type < 'S'),
raw_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id,
         CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'P' THEN 'canceled' ELSE 'shipped' END AS order_status,
         o_orderdate AS purchase, d.delivered, o_orderdate + to_days((30 + o_orderkey % 60)::INT) AS estimated
  FROM orders LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS delivered FROM lineitem GROUP BY 1) d
    ON o_orderkey = d.l_orderkey),
raw_items AS (
  SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id, l_suppkey AS seller_id,
         l_extendedprice::DECIMAL(18,2) AS price,
         (l_extendedprice::DECIMAL(18,2) * l_tax::DECIMAL(4,2))::DECIMAL(22,4) AS freight_value
  FROM lineitem),
raw_payments AS (
  SELECT l_orderkey AS order_id, l_linenumber AS payment_sequential, l_returnflag AS payment_type,
         1 + l_quantity::INT % 12 AS payment_installments, l_extendedprice::DECIMAL(18,2) AS payment_value
  FROM lineitem),
raw_reviews AS (
  SELECT 'd-' || doc_id AS review_id, doc_id AS order_id, (1 + length(text) % 5)::INT AS review_score, text AS comment,
         TIMESTAMP '2000-01-01' AS created
  FROM documents
  UNION ALL
  SELECT 'c-' || conv_id || '-' || turn, conv_id, (1 + length(text) % 5)::INT, text,
         TIMESTAMP '2000-01-01' + to_days((turn + 1)::INT)
  FROM conversations WHERE role = 'user')
"""

MODEL = """
price_stats AS (
  SELECT sum(price)::DOUBLE / count(price)::DOUBLE + 1.5::DOUBLE * stddev_samp(price::DOUBLE) AS upper_limit
  FROM raw_items),
dim_product AS (
  SELECT product_id, coalesce(english, product_category_name, 'unknown') AS category_name,
         product_category_name IS NOT NULL AS has_category, weight_g
  FROM products LEFT JOIN translation ON product_category_name = name),
span AS (SELECT min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders),
dim_date AS (
  SELECT d::DATE AS date_id, year(d)::BIGINT AS year, month(d)::BIGINT AS month, day(d)::BIGINT AS day,
         dayname(d) AS day_of_week, isodow(d) IN (6, 7) AS is_weekend
  FROM (SELECT unnest(generate_series(date_trunc('year', lo), make_date(year(hi)::INT, 12, 31)::TIMESTAMP,
                                      INTERVAL 1 DAY)) AS d FROM span)),
latest_review AS (
  SELECT order_id, review_score, comment FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY created DESC, review_id) AS rn FROM raw_reviews)
  WHERE rn = 1),
fact_orders AS (
  SELECT o.order_id, customer_id, order_status, purchase::DATE AS purchase_date_id, purchase AS purchase_timestamp,
         delivered AS delivered_timestamp, estimated AS estimated_delivery_timestamp,
         date_diff('day', purchase, delivered)::BIGINT AS delivery_days,
         CASE WHEN delivered IS NULL THEN NULL ELSE delivered > estimated END AS is_late,
         review_score, comment AS review_comment_message
  FROM raw_orders o LEFT JOIN latest_review r ON o.order_id = r.order_id
  WHERE order_status <> 'canceled'),
fact_items AS (
  SELECT i.*, i.price::DOUBLE > (SELECT upper_limit FROM price_stats) AS is_price_outlier
  FROM raw_items i WHERE EXISTS (SELECT 1 FROM fact_orders p WHERE p.order_id = i.order_id)),
fact_payments AS (
  SELECT g.* FROM raw_payments g WHERE EXISTS (SELECT 1 FROM fact_orders p WHERE p.order_id = g.order_id)),
regions AS (
  SELECT n_name AS state, r_name AS region FROM nation JOIN region ON n_regionkey = r_regionkey),
focus AS (SELECT state FROM regions WHERE region = 'ASIA'),
fd AS (SELECT * FROM fact_orders WHERE order_status = 'delivered')
"""

BASE = f"WITH {ENTITIES.strip()},\n{MODEL.strip()}"


def with_model(sql: str, *more: str) -> str:
    """SQL over the model; ``more`` are further common table expressions."""
    extra = "".join(f",\n{m.strip()}" for m in more)
    return f"{BASE}{extra}\n{sql.strip()}"
