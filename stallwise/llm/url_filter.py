"""URL filter: a blocked Bloom filter of listed canonical URLs lets possible hits through to an exact join.

A listed URL is a canonical prefix: a host and the beginning of a path. It stands for its host and every
subdomain, and for all paths that begin like its own. A URL can only meet a listed one of a certain shape
(labels of the host, length of the path), so each URL yields one canonical candidate per shape in the list.
Candidates are tested against the filter, one 64-bit word per block; what passes is joined exactly, which
removes the false positives; the longest listed URL wins.

Only the distinct (host, path) pairs are judged, so a host with a third of all pages is no hot key before the
last join, which Spark may split. Filter and list are joined without a hint: Spark broadcasts them where they
measure small and shuffles them where not.

Null URLs and those without ``://`` have an empty host and path, and no candidate fits them. Repeated pages
stay repeated. An empty list lets every page have the default verdict.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stallwise.llm.common import table

#: Bits of the filter per listed URL, and bits that one URL sets in its word.
BITS_PER_URL = 16
BITS_SET = 5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"

#: Fixed rules of the query: verdict and rule, whose host ends at the first slash.
RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, ASCII letters in lower case."""
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def _key(host: Column, path: Column) -> Column:
    return F.xxhash64(host, F.lit("/"), path)


def _mask(key: Column) -> Column:
    """BITS_SET bits of a 64-bit word, from six bits of the key each."""
    mask = F.lit(0).cast("long")
    for i in range(BITS_SET):
        bit = F.shiftrightunsigned(key, 6 * i + 4).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit))
    return mask


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).alias("block")


def bloom_filter(listed: DataFrame) -> tuple[DataFrame, int]:
    """(block, word) of the listed (host, path) rows, and the number of blocks. Empty words have no row."""
    blocks = max(1, -(-listed.count() * BITS_PER_URL // 64))
    key = _key(F.col("host"), F.col("path"))
    return listed.groupBy(_block(key, blocks)).agg(F.bit_or(_mask(key)).alias("word")), blocks


def filter_urls(pages: DataFrame, listed: DataFrame, default: str = "allow", url: str = "url") -> DataFrame:
    """pages' rows as (all columns of ``pages`` in ``row``, host, path, rule, verdict).

    listed: (host, path, rule, verdict), one row per host and path.
    """
    shapes = listed.select(
        F.size(F.split("host", r"\.")).alias("labels"), F.length("path").alias("length")
    ).distinct()
    # As many rows as there are pairs of label count and path length in the list: the list's own variety, not its size.
    shapes = sorted((s.labels, s.length) for s in shapes.collect())
    rows = pages.select(
        F.struct(*pages.columns).alias("row"), host_of(pages[url]).alias("host"), path_of(pages[url]).alias("path")
    )
    if not shapes:
        return rows.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    words, blocks = bloom_filter(listed)
    site = rows.select("host", "path").where("host <> ''").distinct()
    candidates = F.array(
        *[
            F.struct(
                F.substring_index("host", ".", -labels).alias("h"), F.substring("path", 1, length).alias("p")
            )
            for labels, length in shapes
        ]
    )
    tries = site.select("host", "path", F.explode(F.array_distinct(candidates)).alias("c"))
    key = _key(F.col("c.h"), F.col("c.p"))
    tries = tries.select("host", "path", F.col("c.h").alias("h"), F.col("c.p").alias("p"), key.alias("key"))
    passed = tries.withColumn("block", _block(F.col("key"), blocks)).join(words, "block")
    passed = passed.where(F.col("word").bitwiseAND(_mask(F.col("key"))) == _mask(F.col("key")))
    rules = listed.select(F.col("host").alias("h"), F.col("path").alias("p"), "rule", "verdict")
    best = F.max(F.struct(F.length("rule"), F.length("h"), "rule", "verdict")).alias("best")
    hits = passed.join(rules, ["h", "p"]).groupBy("host", "path").agg(best)
    return rows.join(hits, ["host", "path"], "left").select(
        "row", "host", "path", "best.rule", F.coalesce("best.verdict", F.lit(default)).alias("verdict")
    )


def listed_rules(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """(host, path, rule, verdict) of (verdict, rule) pairs, as a local table."""
    values = ", ".join(f"('{verdict}', '{rule}')" for verdict, rule in rules)
    given = spark.sql(f"SELECT * FROM VALUES {values} AS t(verdict, rule)")
    return given.select(
        F.substring_index("rule", "/", 1).alias("host"),
        F.expr("substring(rule, instr(rule, '/'))").alias("path"),
        "rule",
        "verdict",
    )


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged = filter_urls(pages, listed_rules(spark, RULES))
    return judged.select("row.page_id", "host", "path", "rule", "verdict")


OP2_SQL = r"""
WITH rules(verdict, rule) AS (VALUES
  ('allow', 'com/'), ('block', 'example.com/en/'), ('allow', 'www.example.com/en/'),
  ('block', 'net/es/'), ('block', 'net/fr/')),
parts AS (
  SELECT verdict, rule, split_part(rule, '/', 1) AS rh, substr(rule, instr(rule, '/')) AS rp FROM rules),
urls AS (
  SELECT DISTINCT url,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
fits AS (
  SELECT u.url, u.host, u.path, p.rule, p.verdict,
    row_number() OVER (PARTITION BY u.url ORDER BY length(p.rule) DESC) AS n
  FROM urls u LEFT JOIN parts p
    ON (u.host = p.rh OR ends_with(u.host, '.' || p.rh)) AND starts_with(u.path, p.rp))
SELECT g.page_id, f.host, f.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM pages g JOIN fits f ON g.url IS NOT DISTINCT FROM f.url AND f.n = 1
"""
