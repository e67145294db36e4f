"""Quality checks."""

from oracle.base import ENTITIES, avg, pct, rnd, with_model

# Fixed values, stated apart from the code that is compared; a test holds the two against each other.
TREATMENTS = {
    "price_outliers": "flagged, kept in the items fact so that revenue stays whole",
    "duplicate_reviews": "latest review of the order wins",
    "conflicting_scores": "latest review wins; score and comment come from the same row",
    "delivered_without_date": "kept; lateness is NULL, so out of every punctuality metric",
    "products_without_category": "shown as 'unknown'",
}

_RAW = f"WITH {ENTITIES.strip()}"


def raw(sql: str, *more: str) -> str:
    extra = "".join(f",\n{m.strip()}" for m in more)
    return f"{_RAW}{extra}\n{sql.strip()}"


def _reliability(total: str, failed: str) -> str:
    return (
        f"CASE WHEN {total} = 0 THEN 100.0::DOUBLE ELSE 100.0::DOUBLE * "
        f"(1.0::DOUBLE - ({failed})::DOUBLE / ({total})::DOUBLE) END"
    )


def _share(rule: str, condition: str, source: str) -> str:
    bad = f"count(*) FILTER ({condition})"
    return f"SELECT '{rule}' AS rule, count(*) AS total, {bad} AS failed, {pct(bad, 'count(*)')} AS failed_pct FROM {source}"


def _check(name: str, condition: str, source: str) -> str:
    bad = f"count(*) FILTER ({condition})"
    return (
        f"SELECT '{name}' AS check_name, count(*) AS total, {bad} AS failed, "
        f"{_reliability('count(*)', bad)} AS reliability_pct FROM {source}"
    )


_A_RULE = "payment_type = 'A' AND payment_installments <> 1"
_TAGGED = f"""
tagged AS (
  SELECT *, concat_ws(' | ', CASE WHEN payment_value < 20000 THEN 'payment_value>=20000' END,
                      CASE WHEN {_A_RULE} THEN 'A has one installment' END) AS quarantine_reason
  FROM raw_payments)"""

_REPEATS = """
repeats AS (
  SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id, l_suppkey AS seller_id,
         row_number() OVER (PARTITION BY l_orderkey, l_linenumber
           ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
                    l_shipdate) > 1 AS is_repeat
  FROM lineitem)"""

_GOOD_CUSTOMERS = "good AS (SELECT c_custkey AS customer_id FROM customer WHERE c_acctbal >= 0)"

_CASCADE = """
tagged_items AS (
  SELECT i.*, CASE
      WHEN i.order_id NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') THEN 'items_to_orders'
      WHEN i.product_id NOT IN (SELECT p_partkey FROM part WHERE p_type <> 'PROMO') THEN 'items_to_products'
      WHEN i.seller_id NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0) THEN 'items_to_sellers'
    END AS failed_reference
  FROM raw_items i)"""


def _cascade_step(name: str, earlier: list[str]) -> str:
    skipped = "', '".join(earlier)
    left = f"failed_reference IS NULL OR failed_reference NOT IN ('{skipped}')" if earlier else "true"
    bad = f"failed_reference = '{name}'"
    return _check(name, bad, f"(SELECT * FROM tagged_items WHERE {left})")


def _limit(source: str, column: str, fence: float, deviations: float) -> str:
    c = f"{column}::DOUBLE"
    log = f"exp(q3 + {fence}::DOUBLE * (q3 - q1))"
    return f"""
    SELECT n, {rnd("skew", 6)} AS skewness,
           CASE WHEN n < 8 THEN 'insufficient_sample' WHEN abs(skew) > 1 AND pos >= 8 THEN 'log_iqr'
                ELSE 'z_score' END AS method,
           {rnd(f"CASE WHEN n < 8 THEN NULL WHEN abs(skew) > 1 AND pos >= 8 THEN {log} ELSE mean + {deviations}::DOUBLE * std END", 6)}
             AS upper_limit
    FROM (SELECT count({column}) AS n, count(*) FILTER ({column} > 0) AS pos, skewness({c}) AS skew,
                 {avg(f"sum({column})", f"count({column})")} AS mean, stddev_samp({c}) AS std,
                 quantile_cont(CASE WHEN {column} > 0 THEN ln({c}) END, 0.25) AS q1,
                 quantile_cont(CASE WHEN {column} > 0 THEN ln({c}) END, 0.75) AS q3
          FROM {source})"""


_EVENT_VALUES = "ev AS (SELECT value::DECIMAL(18,2) AS value FROM events)"

# The whole run: rule sets, outlier flag, ordered references.
_RUN = """
t_orders AS (
  SELECT *, delivered < purchase AS late_fail,
         row_number() OVER (PARTITION BY order_id ORDER BY customer_id) > 1 AS repeat FROM raw_orders),
s_orders AS (
  SELECT * FROM t_orders WHERE NOT coalesce(late_fail, false) AND NOT repeat AND order_id IS NOT NULL
    AND customer_id IS NOT NULL AND order_status IS NOT NULL AND purchase IS NOT NULL),
c_orders AS (SELECT * FROM s_orders WHERE customer_id IN (SELECT customer_id FROM customers)),
t_payments AS (
  SELECT *, payment_type = 'A' AND payment_installments <> 1 OR payment_value < 0 OR payment_installments < 0 AS bad
  FROM raw_payments),
s_payments AS (SELECT * FROM t_payments WHERE NOT bad),
s_items AS (SELECT * FROM raw_items WHERE price >= 0 AND freight_value >= 0),
s_reviews AS (SELECT * FROM raw_reviews WHERE review_score BETWEEN 1 AND 5),
i_tagged AS (
  SELECT i.*, CASE WHEN order_id NOT IN (SELECT order_id FROM c_orders) THEN 1
                   WHEN product_id NOT IN (SELECT product_id FROM products) THEN 2
                   WHEN seller_id NOT IN (SELECT seller_id FROM sellers) THEN 3 ELSE 0 END AS step
  FROM s_items i),
c_reviews AS (SELECT * FROM s_reviews WHERE order_id IN (SELECT order_id FROM c_orders)),
price_limit AS (
  SELECT sum(price)::DOUBLE / count(price)::DOUBLE + 1.5::DOUBLE * stddev_samp(price::DOUBLE) AS upper_limit FROM s_items),
checks AS (
""" + " UNION ALL ".join(
    [
        _check("dim_customer (schema)", "customer_id IS NULL", "customers"),
        _check("dim_seller (schema)", "seller_id IS NULL", "sellers"),
        _check("dim_product (schema)", "product_id IS NULL", "products"),
        _check("fact_orders (schema and time order)", "coalesce(late_fail, false) OR repeat", "t_orders"),
        _check("fact_items (schema)", "price < 0 OR freight_value < 0", "raw_items"),
        _check("fact_payments (schema and installments)", "bad", "t_payments"),
        _check("reviews (schema and scale 1-5)", "review_score NOT BETWEEN 1 AND 5", "raw_reviews"),
        _check("orders_to_customers", "customer_id NOT IN (SELECT customer_id FROM customers)", "s_orders"),
        _check("items_to_orders", "step = 1", "i_tagged"),
        _check("items_to_products", "step = 2", "(SELECT * FROM i_tagged WHERE step <> 1)"),
        _check("items_to_sellers", "step = 3", "(SELECT * FROM i_tagged WHERE step NOT IN (1, 2))"),
        _check("payments_to_orders", "order_id NOT IN (SELECT order_id FROM c_orders)", "s_payments"),
        _check("reviews_to_orders", "order_id NOT IN (SELECT order_id FROM c_orders)", "s_reviews"),
    ]
) + ")"


def _audit_row(rule: str, query: str, method: str = "NULL", limit: str = "NULL") -> str:
    treatment = TREATMENTS[rule].replace("'", "''")
    return (
        f"SELECT '{rule}' AS rule, ({query})::BIGINT AS occurrences, '{treatment}' AS treatment, "
        f"{method}::VARCHAR AS method, {limit}::DOUBLE AS upper_limit"
    )


def _audit(orders: str, reviews: str, items: str, limit: str) -> str:
    return " UNION ALL ".join(
        [
            _audit_row(
                "price_outliers",
                f"SELECT count(*) FROM {items} WHERE price::DOUBLE > (SELECT upper_limit FROM {limit})",
                "'z_score'",
                rnd(f"SELECT upper_limit FROM {limit}", 6),
            ),
            _audit_row("duplicate_reviews", f"SELECT count(*) - count(DISTINCT order_id) FROM {reviews}"),
            _audit_row(
                "conflicting_scores",
                f"SELECT count(*) FROM (SELECT order_id FROM {reviews} GROUP BY 1 "
                "HAVING min(review_score) <> max(review_score))",
            ),
            _audit_row(
                "delivered_without_date",
                f"SELECT count(*) FROM {orders} WHERE order_status = 'delivered' AND delivered IS NULL",
            ),
            _audit_row("products_without_category", "SELECT count(*) FROM products WHERE product_category_name IS NULL"),
        ]
    )


QUALITY_SQL = {
    "dq_not_null": raw(
        _share("not_null(product_category_name)", "product_category_name IS NULL", "products")
        + " UNION ALL "
        + _share("not_null(order_delivered_customer_date)", "delivered IS NULL", "raw_orders")
    ),
    "dq_type": _share(
        "type(balance:decimal(18,2))",
        "TRY_CAST(t AS DECIMAL(18,2)) IS NULL",
        "(SELECT CASE WHEN c_acctbal < 0 THEN c_mktsegment ELSE c_acctbal::VARCHAR END AS t FROM customer)",
    ),
    "dq_range": raw(
        _share("balance>=0", "c_acctbal < 0", "customer")
        + " UNION ALL "
        + _share("review_score in 1..4", "review_score NOT BETWEEN 1 AND 4", "raw_reviews")
    ),
    "dq_unique": f"WITH {_REPEATS.strip()} SELECT * FROM repeats",
    "dq_unique_counts": """
    SELECT count(*) AS total,
           count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS failed
    FROM lineitem""",
    "dq_time_order": _share(
        "shipped not before purchase", "l_shipdate < o_orderdate", "lineitem JOIN orders ON l_orderkey = o_orderkey"
    ),
    "dq_implication": raw(_share("A has one installment", _A_RULE, "raw_payments")),
    "dq_reasons": raw(
        "SELECT quarantine_reason, count(*) AS rows FROM tagged WHERE quarantine_reason <> '' GROUP BY 1", _TAGGED
    ),
    "dq_violations_by_rule": raw(f"""
    SELECT 'payment_value>=20000' AS rule, count(*) AS failed FROM raw_payments WHERE payment_value < 20000
    UNION ALL SELECT 'A has one installment', count(*) FROM raw_payments WHERE {_A_RULE}"""),
    "dq_clean_rows": raw(
        "SELECT order_id, payment_sequential, payment_type, payment_installments, payment_value "
        "FROM tagged WHERE quarantine_reason = ''",
        _TAGGED,
    ),
    "dq_quarantined_rows": raw(
        "SELECT order_id, payment_sequential, payment_type, payment_installments, payment_value, quarantine_reason "
        "FROM tagged WHERE quarantine_reason <> ''",
        _TAGGED,
    ),
    "dq_reliability": raw(
        _check("payments", "quarantine_reason <> ''", "tagged")
        + " UNION ALL "
        + _check("orders", "delivered < purchase", "raw_orders"),
        _TAGGED,
    ),
    "dq_reference_counts": raw(
        _check("orders_to_customers", "customer_id NOT IN (SELECT customer_id FROM good)", "raw_orders"), _GOOD_CUSTOMERS
    ),
    "dq_reference_kept": raw(
        "SELECT order_id, customer_id, order_status FROM raw_orders WHERE customer_id IN (SELECT customer_id FROM good)",
        _GOOD_CUSTOMERS,
    ),
    "dq_reference_orphans": raw(
        "SELECT order_id, customer_id, 'orphan: key ''customer_id'' not in parent of ''orders_to_customers''' "
        "AS quarantine_reason FROM raw_orders WHERE customer_id NOT IN (SELECT customer_id FROM good)",
        _GOOD_CUSTOMERS,
    ),
    "dq_reference_cascade": raw(
        _cascade_step("items_to_orders", [])
        + " UNION ALL "
        + _cascade_step("items_to_products", ["items_to_orders"])
        + " UNION ALL "
        + _cascade_step("items_to_sellers", ["items_to_orders", "items_to_products"]),
        _CASCADE,
    ),
    "dq_outlier_zscore": raw(_limit("raw_items", "price", 3.0, 1.5)),
    "dq_outlier_log": f"WITH {_EVENT_VALUES} {_limit('ev', 'value', 1.0, 3.0)}",
    "dq_outlier_flags": raw(
        "SELECT order_id, order_item_id, price, price::DOUBLE > (SELECT sum(price)::DOUBLE / count(price)::DOUBLE "
        "+ 1.5::DOUBLE * stddev_samp(price::DOUBLE) FROM raw_items) AS is_price_outlier FROM raw_items"
    ),
    "dq_outlier_flags_log": f"""
    WITH {_EVENT_VALUES}, lim AS ({_limit('ev', 'value', 1.0, 3.0)})
    SELECT event_id, value::DECIMAL(18,2) > (SELECT upper_limit FROM lim) AS is_price_outlier FROM events""",
    "dq_fence_comparison": f"""
    WITH {_EVENT_VALUES}, q AS (
      SELECT quantile_cont(value::DOUBLE, 0.25) AS l1, quantile_cont(value::DOUBLE, 0.75) AS l3,
             quantile_cont(CASE WHEN value > 0 THEN ln(value::DOUBLE) END, 0.25) AS g1,
             quantile_cont(CASE WHEN value > 0 THEN ln(value::DOUBLE) END, 0.75) AS g3 FROM ev),
    lim AS (SELECT 'linear' AS fence, l3 + 3.0::DOUBLE * (l3 - l1) AS upper_limit FROM q
            UNION ALL SELECT 'log', exp(g3 + 3.0::DOUBLE * (g3 - g1)) FROM q)
    SELECT fence, {rnd("max(upper_limit)", 6)} AS upper_limit, count(*) FILTER (value::DOUBLE > upper_limit) AS flagged,
           {rnd(pct("coalesce(sum(value) FILTER (value::DOUBLE > upper_limit), 0)", "sum(value)"), 6)} AS pct_amount
    FROM ev, lim GROUP BY fence""",
    "dq_audit": with_model(_audit("raw_orders", "raw_reviews", "raw_items", "price_stats")),
    "dq_run_report": raw(
        """
    SELECT *, CASE WHEN reliability_pct >= 95 THEN 'PASS' ELSE 'FAIL' END AS verdict,
           CASE WHEN reliability_pct >= 99 THEN 'excellent' WHEN reliability_pct >= 95 THEN 'acceptable'
                ELSE 'critical' END AS badge
    FROM checks""",
        _RUN,
    ),
    "dq_run_verdict": raw("SELECT count(*) FILTER (reliability_pct >= 95) AS passed, count(*) AS checks FROM checks", _RUN),
    "dq_run_audit": raw(
        _audit("c_orders", "c_reviews", "(SELECT * FROM i_tagged WHERE step = 0)", "price_limit"), _RUN
    ),
}
