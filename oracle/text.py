"""Review texts, classification and root causes."""

from oracle.base import pct, rnd, with_model

# Fixed values, stated apart from the code that is compared; a test holds the two against each other.
FALLBACK_REASON = "Falha na chamada ao modelo; registro não classificado"
DEADLINE_WORDS = ["pour", "thing"]
PRODUCT_WORDS = ["with", "from"]
TAXONOMY = {
    "slow_parcel": ["pour", "nicht", "thing"],
    "wrong_item": ["with", "avec", "mente"],
    "broken_item": ["from", "dans", "heit"],
    "no_answer": ["this", "sich", "para"],
}


def _has(word: str) -> str:
    return f"contains(lower(review_comment_message), '{word}')"


def _any(words: list[str]) -> str:
    return "(" + " OR ".join(_has(w) for w in words) + ")"


_ELIGIBLE = """
eligible AS (
  SELECT order_id, review_score, review_comment_message FROM fact_orders
  WHERE review_score <= 2 AND review_comment_message IS NOT NULL AND trim(review_comment_message) <> '')"""

_SAMPLE = """
sampled AS (
  SELECT * FROM eligible ORDER BY md5('42-' || order_id), order_id LIMIT 20)"""


def _score(words: list[str]) -> str:
    return " + ".join(f"{_has(w)}::INT" for w in words)


def _words(words: list[str]) -> str:
    return "concat_ws(', ', " + ", ".join(f"CASE WHEN {_has(w)} THEN '{w}' END" for w in words) + ")"


def _classified(source: str) -> tuple[str, str]:
    names = list(TAXONOMY)
    scores = ", ".join(f"{_score(TAXONOMY[n])} AS s{i}, {_words(TAXONOMY[n])} AS w{i}" for i, n in enumerate(names))
    best = "greatest(" + ", ".join(f"s{i}" for i in range(len(names))) + ")"
    category = " ".join(f"WHEN s{i} = best THEN '{n}'" for i, n in enumerate(names))
    reason = " ".join(f"WHEN s{i} = best THEN w{i}" for i in range(len(names)))
    return (
        f"scores AS (SELECT *, {best} AS best FROM (SELECT order_id, {scores} FROM {source}))",
        f"""
classified AS (
  SELECT order_id, CASE WHEN best = 0 THEN 'nao_classificado' {category} END AS category,
         CASE WHEN best = 0 THEN '' {reason} END AS reason,
         CASE WHEN best >= 3 THEN 'alta' WHEN best = 2 THEN 'media' WHEN best = 1 THEN 'baixa'
              ELSE 'indeterminada' END AS severity,
         s0 > 0 AS about_deadline, s1 > 0 OR s2 > 0 AS about_product, s3 > 0 AS about_service,
         best = 0 AS is_fallback
  FROM scores)""",
    )


_ALL = (_ELIGIBLE, *_classified("eligible"))
_VALID = (*_ALL, "valid AS (SELECT * FROM classified WHERE NOT is_fallback)")
_SEVERITY = f"""
severity AS (
  SELECT category, count(*) AS total, count(*) FILTER (severity = 'alta') AS high,
         count(*) FILTER (severity = 'media') AS medium, count(*) FILTER (severity = 'baixa') AS low,
         {rnd(pct("count(*) FILTER (severity = 'alta')", "count(*)"), 1)} AS pct_high
  FROM valid GROUP BY 1)"""

_FIELDS = "order_id::VARCHAR AS order_id, category, reason, severity, about_deadline, about_product, about_service"

TOPICS, PASSES, SEED, MAX_PERCENT = 4, 8, 42, 25


def _topic_steps(passes: int) -> str:
    """Shares of the topics after each pass, as s0, s1, ...; wN holds the weights of the terms after the last."""
    z = range(TOPICS)
    occurrences = "unnest(regexp_split_to_array(lower(review_comment_message), '\\P{L}+')) AS term"
    first = ", ".join(f"(('0x' || substr(md5('{SEED} {i} ' || term), 1, 7))::BIGINT % 1000 + 1) * n AS r{i}" for i in z)
    out = [
        f"occurrences AS (SELECT order_id, {occurrences} FROM eligible)",
        "counts AS (SELECT order_id, term, count(*) AS n FROM occurrences WHERE length(term) >= 3 GROUP BY ALL)",
        f"""vocabulary AS (
  SELECT term FROM counts GROUP BY term HAVING count(*) * 100 <= (SELECT count(*) FROM eligible) * {MAX_PERCENT})""",
        f"s0 AS MATERIALIZED (SELECT order_id, term, n, {first} FROM counts SEMI JOIN vocabulary USING (term))",
    ]
    sums = ", ".join(f"sum(r{i})::BIGINT AS r{i}" for i in z)
    q = ", ".join(
        f"(d.r{i} + 100000)::DOUBLE * ((w.r{i} + 10000)::DOUBLE / (t.r{i} + 10000 * terms)::DOUBLE) AS q{i}" for i in z
    )
    whole = " + ".join(f"q{i}" for i in z)
    shares = ", ".join(f"floor((n * 1000000)::DOUBLE * (q{i} / ({whole})))::BIGINT AS r{i}" for i in z)
    for p in range(passes):
        last = f"s{p}"
        out.append(f"""s{p + 1} AS MATERIALIZED (
  SELECT order_id, term, n, {shares} FROM (
    SELECT s.order_id, s.term, s.n, {q}
    FROM {last} s JOIN (SELECT term, {sums} FROM {last} GROUP BY 1) w ON s.term = w.term
    JOIN (SELECT order_id, {sums} FROM {last} GROUP BY 1) d ON s.order_id = d.order_id,
    (SELECT {sums}, count(DISTINCT term) AS terms FROM {last}) t))""")
    out.append(f"weights AS MATERIALIZED (SELECT term, {sums} FROM s{passes} GROUP BY 1)")
    return ",\n".join(out)


_LEADING = """led AS (
  SELECT topic, row_number() OVER (PARTITION BY topic ORDER BY w DESC, term) - 1 AS place, term
  FROM (SELECT unnest(range({k})) AS topic, term, unnest([{r}]) AS w FROM weights)
  QUALIFY place < 8)""".format(k=TOPICS, r=", ".join(f"r{i}" for i in range(TOPICS)))

_WHOLE = " + ".join(f"r{i}" for i in range(TOPICS))
_FALLS = ", ".join(f"sum(floor((n * 1000000)::DOUBLE * (r{i}::DOUBLE / ({_WHOLE})::DOUBLE)))" for i in range(TOPICS))
_ASSIGNED = f"""falls AS (SELECT order_id, [{_FALLS}] AS sums FROM counts JOIN weights USING (term) GROUP BY 1),
assigned AS (
  SELECT 'topic_' || coalesce(list_position(sums, list_max(sums)) - 1, 0) AS category
  FROM eligible LEFT JOIN falls USING (order_id))"""

TEXT_SQL = {
    "text_eligible": with_model("SELECT * FROM eligible", _ELIGIBLE),
    "text_population": with_model("SELECT count(*) AS population FROM eligible", _ELIGIBLE),
    "text_sample": with_model("SELECT order_id, review_score FROM sampled", _ELIGIBLE, _SAMPLE),
    "text_sample_coverage": with_model(
        f"SELECT (SELECT count(*) FROM sampled) AS sampled, count(*) AS population, "
        f"{rnd(pct('(SELECT count(*) FROM sampled)', 'count(*)'), 1)} AS coverage_pct FROM eligible",
        _ELIGIBLE,
        _SAMPLE,
    ),
    "text_fallback_flags": with_model(
        f"""
    SELECT order_id, 'nao_classificado' AS category, '{FALLBACK_REASON}' AS reason, 'indeterminada' AS severity,
           {_any(DEADLINE_WORDS)} AS about_deadline, {_any(PRODUCT_WORDS)} AS about_product, false AS about_service
    FROM eligible""",
        _ELIGIBLE,
    ),
    "text_classify_keywords": with_model("SELECT * EXCLUDE (is_fallback) FROM classified", *_ALL),
    "text_classify_lots": with_model(
        f"""
    SELECT order_id::VARCHAR AS order_id,
           CASE WHEN lost THEN 'nao_classificado' ELSE category END AS category,
           CASE WHEN lost THEN '{FALLBACK_REASON}' ELSE reason END AS reason,
           CASE WHEN lost THEN 'indeterminada' ELSE severity END AS severity,
           CASE WHEN lost THEN {_any(DEADLINE_WORDS)} ELSE about_deadline END AS about_deadline,
           CASE WHEN lost THEN {_any(PRODUCT_WORDS)} ELSE about_product END AS about_product,
           about_service AND NOT lost AS about_service
    FROM (SELECT *, {_has("für")} OR category = 'broken_item' AS lost FROM classified JOIN eligible USING (order_id))""",
        *_ALL,
    ),
    "text_parse_replies": with_model(f"SELECT {_FIELDS} FROM classified WHERE order_id % 5 <> 0", *_ALL),
    "text_topic_terms": with_model(
        """
    SELECT term, count(*) AS documents
    FROM (SELECT DISTINCT order_id, unnest(regexp_split_to_array(lower(review_comment_message), '\\P{L}+')) AS term
          FROM eligible)
    WHERE length(term) >= 3 GROUP BY 1""",
        _ELIGIBLE,
    ),
    "text_topic_step": with_model(
        "SELECT term, " + ", ".join(f"r{i} AS share_{i}" for i in range(TOPICS)) + " FROM weights",
        _ELIGIBLE,
        _topic_steps(1),
    ),
    "text_topics": with_model(
        """
    SELECT 'topic_' || topic AS category_id, display_name, 'Texts about ' || words AS description, place::INT AS place,
           term AS keyword
    FROM led JOIN (
      SELECT topic, string_agg(term, ', ' ORDER BY place) FILTER (place < 3) AS display_name,
             string_agg(term, ', ' ORDER BY place) AS words
      FROM led GROUP BY topic) USING (topic)""",
        _ELIGIBLE,
        _topic_steps(PASSES),
        _LEADING,
    ),
    "text_topic_shares": with_model(
        f"SELECT category, count(*) AS complaints, {rnd(pct('count(*)', 'sum(count(*)) OVER ()'), 1)} AS pct "
        "FROM assigned GROUP BY 1",
        _ELIGIBLE,
        _topic_steps(PASSES),
        _ASSIGNED,
    ),
    "text_enriched": with_model("SELECT *, 'fixture' AS run_id FROM classified", *_ALL),
    "text_failure_share": with_model(
        f"SELECT count(*) AS total, count(*) FILTER (is_fallback) AS unclassified, "
        f"{rnd(pct('count(*) FILTER (is_fallback)', 'count(*)'), 1)} AS unclassified_pct FROM classified",
        *_ALL,
    ),
}

REVIEWS_SQL = {
    "reviews_run_summary": with_model(
        """
    SELECT count(*) AS total, count(*) FILTER (is_fallback) AS unclassified,
           count(DISTINCT CASE WHEN NOT is_fallback THEN category END) AS categories,
           count(*) FILTER (is_fallback)::DOUBLE / count(*)::DOUBLE <= 0.05 AS trusted
    FROM classified""",
        *_ALL,
    ),
    "reviews_coverage": with_model(
        f"""
    SELECT (SELECT count(*) FROM eligible) AS population, count(*) AS classified,
           {rnd(pct("count(*)", "(SELECT count(*) FROM eligible)"), 1)} AS coverage_pct,
           {rnd("1.96::DOUBLE * sqrt(0.25::DOUBLE / greatest(count(*)::DOUBLE, 1.0::DOUBLE)) * 100.0::DOUBLE", 1)} AS margin_pp
    FROM valid""",
        *_VALID,
    ),
    "reviews_score_distribution": with_model(
        "SELECT review_score::BIGINT AS review_score, count(*) AS reviews "
        "FROM valid JOIN fact_orders USING (order_id) GROUP BY 1",
        *_VALID,
    ),
    "reviews_category_distribution": with_model(
        f"SELECT category, count(*) AS complaints, {rnd(pct('count(*)', 'sum(count(*)) OVER ()'), 1)} AS pct "
        "FROM valid GROUP BY 1",
        *_VALID,
    ),
    "reviews_severity_by_category": with_model("SELECT * FROM severity", *_VALID, _SEVERITY),
    "reviews_worst_categories": with_model(
        """
    SELECT (SELECT category FROM severity ORDER BY total DESC, category LIMIT 1) AS top_by_volume,
           (SELECT category FROM severity ORDER BY pct_high DESC, category LIMIT 1) AS top_by_gravity""",
        *_VALID,
        _SEVERITY,
    ),
    "reviews_category_by_punctuality": with_model(
        """
    SELECT category, count(*) FILTER (is_late) AS on_late_orders, count(*) FILTER (NOT is_late) AS on_punctual_orders
    FROM valid JOIN fact_orders USING (order_id) WHERE is_late IS NOT NULL GROUP BY 1""",
        *_VALID,
    ),
    "reviews_revenue_by_category": with_model(
        f"""
    SELECT category, count(DISTINCT order_id) AS orders, {rnd("sum(price)", 2)} AS gmv,
           {rnd("sum(freight_value)", 2)} AS freight
    FROM valid JOIN fact_items USING (order_id) GROUP BY 1""",
        *_VALID,
    ),
    "reviews_sellers_with_complaints": with_model(
        f"""
    SELECT s.seller_id, s.state, count(DISTINCT v.order_id) AS complaints, {rnd("sum(i.price)", 2)} AS gmv
    FROM valid v JOIN fact_items i ON v.order_id = i.order_id JOIN sellers s ON i.seller_id = s.seller_id
    WHERE category LIKE '%wrong%' OR category LIKE '%broken%'
    GROUP BY 1, 2 ORDER BY complaints DESC, s.seller_id LIMIT 8""",
        *_VALID,
    ),
    "reviews_product_categories_with_complaints": with_model(
        f"""
    SELECT p.category_name AS product_category, count(DISTINCT v.order_id) AS complaints, {rnd("sum(i.price)", 2)} AS gmv
    FROM valid v JOIN fact_items i ON v.order_id = i.order_id JOIN dim_product p ON i.product_id = p.product_id
    GROUP BY 1 ORDER BY complaints DESC, product_category LIMIT 3""",
        *_VALID,
    ),
    "lever_complaint_distribution": with_model(
        f"""
    SELECT category, count(*) AS complaints, {rnd(pct("count(*)", "sum(count(*)) OVER ()"), 1)} AS pct,
           (SELECT count(*) FILTER (is_fallback)::DOUBLE / greatest(count(*), 1)::DOUBLE <= 0.05 FROM classified) AS trusted,
           {rnd(pct("sum(count(*)) OVER ()", "(SELECT count(*) FROM eligible)"), 1)} AS coverage_pct
    FROM valid GROUP BY 1""",
        *_VALID,
    ),
}
