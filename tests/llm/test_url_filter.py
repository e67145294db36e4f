from pyspark.sql import functions as F

from stallwise.llm import url_filter

RULES = [("allow", "com/"), ("block", "example.com/en/"), ("block", "net/es/"), ("allow", "a.net/es/x")]


def by_hand(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        ends = [i for i, c in enumerate(rest) if c in "/?#"]
        end = min(ends, default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
        path = rest[end:].split("?")[0].split("#")[0]
    fits = []
    for verdict, rule in rules:
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fits.append((len(rule), rule, verdict))
    best = max(fits, default=(0, None, default))
    return host, path, best[1], best[2]


URLS = [
    None, "", "no scheme", "http://EXAMPLE.com/en/1", "https://x.example.com/en", "http://example.com",
    "http://a.net/es/xy?q=http://b.com/", "http://b.a.net/es/", "http://net/es/1#x", "http://.net/es/", "http://ÉA.com/",
    "://com/", "http://com?x", "http://notexample.com/en/1", "http://com/", "http://com/", "a://b://c.com/d\ne",
    "http://" + "a." * 3000 + "com/" + "x" * 5000,
]


def judged(spark, urls, rules):
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)], "id int, url string, host string")
    listed = url_filter.listed_rules(spark, rules) if rules else url_filter.listed_rules(spark, RULES).limit(0)
    out = url_filter.filter_urls(pages, listed).orderBy("row.id").collect()
    assert all(r.row.host == "clash" for r in out)
    return [(r.host, r.path, r.rule, r.verdict) for r in out]


def test_against_plain_loop(spark):
    assert judged(spark, URLS, RULES) == [by_hand(u, RULES) for u in URLS]


def test_many_listed_urls(spark):
    rules = [("block", f"h{i}.org/p{i % 7}") for i in range(500)]
    urls = [f"http://s.h{i}.org/p{j}/x" for i in range(0, 600, 3) for j in range(3)]
    assert judged(spark, urls, rules) == [by_hand(u, rules) for u in urls]


def test_empty_list_and_table(spark):
    assert {r[3] for r in judged(spark, URLS, [])} == {"allow"}
    assert judged(spark, [], RULES) == []


def test_filter_has_no_false_negatives(spark):
    listed = url_filter.listed_rules(spark, [("block", f"h{i}.org/") for i in range(300)])
    words, blocks = url_filter.bloom_filter(listed)
    key = url_filter._key(F.col("host"), F.col("path"))
    tried = listed.withColumn("block", url_filter._block(key, blocks)).join(words, "block")
    mask = url_filter._mask(key)
    assert tried.where(F.col("word").bitwiseAND(mask) == mask).count() == 300
    other = listed.withColumn("path", F.lit("/other")).withColumn("block", url_filter._block(key, blocks))
    passed = other.join(words, "block").where(F.col("word").bitwiseAND(mask) == mask).count()
    assert passed < 30


def test_native_plan(spark, sf):
    plan = url_filter.op2_url_filter(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "html" not in plan and "Cartesian" not in plan
