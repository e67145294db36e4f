"""Mixing sources to target weights: Sainte-Laguë apportionment of equal-word blocks, then seeded block selection.

Sizes are words. Sources in code point order (null last) weigh 3, 1, 2, 3, ... and share 150% of all words; a
target stops at twice its source's size, and the excess is shared by weight again until none is above.

The mix is cut into blocks of equal length, which go to sources by the highest quotients target / (2k + 1), then
within a source to its shards by the shards' words. A shard is a seeded share of the documents of a source, of
about a million words and at most a few thousand rows however large the source is; a source of very many shards
hands its blocks to groups of shards first. In a shard the documents stand in a seeded order, end to end; its
quota takes every block as often as it goes, and the rest once more, chosen by a seeded permutation of the
blocks. A document gets the words of its own that lie in taken blocks. No block is taken more than twice.

Highest quotients without dealing seat by seat: the divisor that fills M seats among g members lies between those
of M - g/2 and M + g/2 exact shares, so each member has all seats below the first bound, and only the few
quotients up to the second are ranked.

Nothing but (doc_id, size, shard) is shuffled. Null texts have size 0; documents of size 0 get 0 words; null ids
and repeated rows count like any other row. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stallwise.llm.common import fresh, saved, table, word_count

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
BLOCK_WORDS = 32
SHARD_WORDS = 1 << 20
SHARD_ROWS = 1 << 12
SHARDS_TOGETHER = 1 << 10
SEED = 17
#: A prime above the number of blocks of any shard: its multiples permute the blocks.
_PRIME = 2147483647
_PIECE = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"


def apportion(rows: DataFrame, group: list[str], member: str, share: str, seats: str) -> DataFrame:
    """rows with a column ``quota``: the Sainte-Laguë seats of each member of a group.

    share: weight of the member, 0 or more; seats: the group's seats, on each row; member: breaks ties and is
    unique in its group. A group is in one task, with about four quotients a member.
    """
    among = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    held = rows.where(F.col(share) > 0).select(*group, member, share, seats)
    held = held.withColumns({"_all": F.sum(share).over(among), "_n": F.count("*").over(among)})
    part = F.col(share).cast("double") / F.col("_all")
    held = held.withColumns(
        {
            "_low": F.greatest(F.lit(0), F.floor(part * (F.col(seats) - F.col("_n") / 2)) - 1),
            "_high": F.ceil(part * (F.col(seats) + F.col("_n") / 2)) + 1,
        }
    )
    left = (F.col(seats) - F.sum("_low").over(among)).alias("_left")
    tried = held.select("*", left).select("*", F.explode(F.sequence("_low", "_high")).alias("_k"))
    quotient = F.col(share).cast("double") / (2 * F.col("_k") + 1)
    ranked = Window.partitionBy(*group or [F.lit(0)]).orderBy(quotient.desc(), member)
    tried = tried.withColumn("_rank", F.row_number().over(ranked))
    won = tried.groupBy(*group, member).agg(
        (F.min("_low") + F.count_if(F.col("_rank") <= F.col("_left"))).alias("quota")
    )
    return rows.join(won, [*group, member], "left").withColumn("quota", F.coalesce("quota", F.lit(0)))


def _mark(doc_id: Column, text: Column) -> Column:
    """Seeded place of a row among others: 60 bits."""
    both = F.concat_ws("|", F.lit(str(SEED)), F.coalesce(doc_id.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(F.md5(both), 1, 15), 16, 10).cast("long")


def source_targets(sized: DataFrame) -> DataFrame:
    """(source, src, source_size, shards, target) of (source, size) rows; src numbers the sources."""
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_rows"))
    # One row per source from here on.
    nth = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.asc_nulls_last("source")))
    sources = sources.withColumn("src", nth)
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), ((F.col("src") - 1) % len(WEIGHTS) + 1).cast("int"))
    sources = sources.withColumn("weight", weight)
    filled = Window.partitionBy(F.lit(0)).orderBy((F.col("source_size") / F.col("weight")).asc(), "src")
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    onward = filled.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(0))
    spread = F.sum("source_size").over(everything) * F.lit(SHARE)
    # The level at which no source with a smaller ratio of size to weight is above its limit is the highest one.
    level = (spread - F.coalesce(F.sum("source_size").over(before), F.lit(0)) * MOST) / F.sum("weight").over(onward)
    sources = sources.withColumn("level", level).withColumn("level", F.max("level").over(everything))
    target = F.least((F.col("source_size") * MOST).cast("double"), F.col("weight") * F.col("level"))
    shards = F.ceil(F.greatest(F.col("source_size") / SHARD_WORDS, F.col("n_rows") / SHARD_ROWS))
    return sources.select("source", "src", "source_size", shards.alias("shards"), target.alias("target"))


def shard_quotas(sized: DataFrame, sources: DataFrame, block_words: int) -> DataFrame:
    """(src, shard, words, blocks, quota): the blocks that each shard has and gives. sized: (src, shard, size)."""
    total = F.sum("target").over(Window.partitionBy(F.lit(0)))
    seats = F.floor(total / block_words + 0.5).alias("seats")
    of_source = apportion(sources.select("src", "target", seats), [], "src", "target", "seats")
    of_source = of_source.select("src", F.col("quota").alias("src_seats"))
    shards = sized.groupBy("src", "shard").agg(F.sum("size").alias("words"))
    shards = shards.withColumn("pack", F.floor(F.col("shard") / SHARDS_TOGETHER))
    packs = shards.groupBy("src", "pack").agg(F.sum("words").alias("pack_words")).join(of_source, "src")
    packs = apportion(packs, ["src"], "pack", "pack_words", "src_seats")
    packs = packs.select("src", "pack", F.col("quota").alias("pack_seats"))
    quotas = apportion(shards.join(packs, ["src", "pack"]), ["src", "pack"], "shard", "words", "pack_seats")
    blocks = F.ceil(F.col("words") / block_words)
    return quotas.select(
        "src", "shard", "words", blocks.alias("blocks"), F.least("quota", blocks * MOST).alias("quota")
    )


def _times(block: Column) -> Column:
    """How often a block of a shard is taken."""
    place = (block * F.lit(_PRIME) + F.col("src") * 7919 + F.col("shard") * 104729 + SEED) % F.col("blocks")
    extra = F.when(place < F.col("quota") % F.col("blocks"), 1).otherwise(0)
    return F.floor(F.col("quota") / F.col("blocks")) + extra


def _placed(rows: DataFrame, sources: DataFrame, quotas: DataFrame) -> DataFrame:
    """rows (with src, shard, mark, size) and where they start in their shard, its blocks and its quota."""
    order = Window.partitionBy("src", "shard").orderBy("mark", "doc_id", "size")
    start = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    held = quotas.join(sources.select("src", "source_size", "target"), "src").drop("words")
    return rows.withColumn("start", start).join(held, ["src", "shard"])


def _taken(block_words: int) -> Column:
    end = F.col("start") + F.col("size")

    def more(sum_: Column, block: Column) -> Column:
        here = F.least(end, (block + 1) * block_words) - F.greatest(F.col("start"), block * block_words)
        return sum_ + here * _times(block)

    first, last = F.floor(F.col("start") / block_words), F.floor((end - 1) / block_words)
    taken = F.aggregate(F.sequence(first, last), F.lit(0).cast("long"), more)
    return F.when(F.col("size") > 0, taken).otherwise(F.lit(0).cast("long"))


def _numbered(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """rows with src and shard."""
    named = sources.select(F.col("source").alias("_source"), "src", "shards")
    out = rows.join(named, rows["source"].eqNullSafe(named["_source"]))
    return out.withColumn("shard", F.col("mark") % F.col("shards")).drop("_source", "shards")


def _sized(docs: DataFrame) -> DataFrame:
    return docs.select(
        docs["doc_id"], docs["source"], word_count(docs["text"]).alias("size"), _mark(docs["doc_id"], docs["text"]).alias("mark")
    )


def _plan(docs: DataFrame, block_words: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sized documents with their shard, targets of the sources, quotas of the shards."""
    sized = saved(_sized(docs), "sizes")
    sources = saved(source_targets(sized), "sources")
    sized = _numbered(sized, sources)
    return sized, sources, saved(shard_quotas(sized, sources, block_words), "quotas")


def mix(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) of every row of docs (doc_id, text, source)."""
    sized, sources, quotas = _plan(docs, block_words)
    return _placed(sized, sources, quotas).select(
        "doc_id", "source", "size", "source_size", "target", _taken(block_words).alias("taken")
    )


def mixed(docs: DataFrame, block_words: int) -> DataFrame:
    """The documents of the mix, in docs' columns: one row for the words taken once or more, one for those taken
    twice. Cut texts keep their white space between words; n_chars, if there, follows the text."""
    _, sources, quotas = _plan(docs, block_words)
    (whole,) = fresh(docs, "row")
    rows = docs.select(
        docs["doc_id"],
        docs["source"],
        word_count(docs["text"]).alias("size"),
        _mark(docs["doc_id"], docs["text"]).alias("mark"),
        F.struct(*[docs[c] for c in docs.columns]).alias(whole),
    )
    placed = _placed(_numbered(rows, sources), sources, quotas).where("size > 0")
    placed = placed.withColumn("pass", F.explode(F.array(*[F.lit(p) for p in range(1, MOST + 1)])))
    first, last = F.floor(F.col("start") / block_words), F.floor((F.col("start") + F.col("size") - 1) / block_words)
    kept = F.filter(F.sequence(first, last), lambda block: _times(block) >= F.col("pass"))
    placed = placed.withColumn("kept", kept).where("size(kept) > 0")
    pieces = F.regexp_extract_all(F.col(f"{whole}.text"), F.lit(_PIECE), F.lit(0))

    def taken(_: Column, at: Column) -> Column:
        return F.array_contains("kept", F.floor((F.col("start") + at) / block_words))

    text = F.when(F.size("kept") == last - first + 1, F.col(f"{whole}.text")).otherwise(
        F.ltrim(F.array_join(F.filter(pieces, taken), ""))
    )
    placed = placed.withColumn("text", text)
    new = {"text": F.col("text"), "n_chars": F.length("text").cast(dict(docs.dtypes).get("n_chars", "long"))}
    return placed.select(*[new.get(c, F.col(f"{whole}.{c}")).alias(c) for c in docs.columns])


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source")).drop("source")


OP10_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    ('0x' || substr(md5('17|' || coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, ''))), 1, 15))::BIGINT AS mark
  FROM documents),
s1 AS (SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n_rows FROM sized GROUP BY source),
s2 AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS src FROM s1),
s3 AS (SELECT *, CASE (src - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight FROM s2),
s4 AS (
  SELECT *, ((SELECT sum(source_size) FROM s1)::DOUBLE * 1.5
      - coalesce(sum(source_size) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE * 2)
    / sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS level
  FROM s3 WINDOW w AS (ORDER BY source_size / weight, src)),
sources AS (
  SELECT source, src, source_size, ceil(greatest(source_size / 1048576, n_rows / 4096))::BIGINT AS shards,
    least((source_size * 2)::DOUBLE, weight * (SELECT max(level) FROM s4)) AS target
  FROM s4),
docs AS (
  SELECT z.doc_id, z.size, z.mark, s.src, z.mark % s.shards AS shard
  FROM sized z JOIN sources s ON z.source IS NOT DISTINCT FROM s.source),
seats AS (SELECT floor(sum(target) / 32 + 0.5)::BIGINT AS n, (SELECT count(*) FROM sources WHERE target > 0) AS g FROM sources),
c1 AS (
  SELECT s.src, s.target, n, greatest(0, floor(s.target / t.t * (n - g / 2)) - 1)::BIGINT AS low,
    (ceil(s.target / t.t * (n + g / 2)) + 1)::BIGINT AS high
  FROM sources s, seats, (SELECT sum(target) AS t FROM sources) t WHERE s.target > 0),
c2 AS (SELECT *, n - sum(low) OVER () AS rest, unnest(range(low, high + 1)) AS k FROM c1),
c3 AS (SELECT *, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, src) AS r FROM c2),
by_source AS (SELECT src, (min(low) + count(*) FILTER (r <= rest))::BIGINT AS seats FROM c3 GROUP BY src),
shards AS (SELECT src, shard, sum(size)::BIGINT AS words FROM docs GROUP BY src, shard),
d1 AS (
  SELECT h.src, h.shard, h.words, b.seats,
    sum(h.words) OVER (PARTITION BY h.src)::DOUBLE AS t, count(*) OVER (PARTITION BY h.src) AS g
  FROM shards h JOIN by_source b USING (src) WHERE h.words > 0),
d2 AS (
  SELECT *, greatest(0, floor(words / t * (seats - g / 2)) - 1)::BIGINT AS low,
    (ceil(words / t * (seats + g / 2)) + 1)::BIGINT AS high FROM d1),
d3 AS (SELECT *, seats - sum(low) OVER (PARTITION BY src) AS rest FROM d2),
d4 AS (SELECT *, unnest(range(low, high + 1)) AS k FROM d3),
d5 AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY words / (2 * k + 1) DESC, shard) AS r FROM d4),
won AS (SELECT src, shard, min(low) + count(*) FILTER (r <= rest) AS quota FROM d5 GROUP BY src, shard),
quotas AS (
  SELECT h.src, h.shard, ceil(h.words / 32)::BIGINT AS blocks,
    least(coalesce(w.quota, 0), ceil(h.words / 32) * 2)::BIGINT AS quota
  FROM shards h LEFT JOIN won w ON h.src = w.src AND h.shard = w.shard),
placed AS (
  SELECT d.*, q.blocks, q.quota,
    (sum(d.size) OVER (PARTITION BY d.src, d.shard ORDER BY d.mark, d.doc_id, d.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size)::BIGINT AS start
  FROM docs d JOIN quotas q ON d.src = q.src AND d.shard = q.shard),
cut AS (
  SELECT *, unnest(range(start // 32, (start + size - 1) // 32 + 1)) AS block FROM placed WHERE size > 0),
takes AS (
  SELECT doc_id, sum((least(start + size, (block + 1) * 32) - greatest(start, block * 32))
    * (quota // blocks + CASE WHEN (block * 2147483647 + src * 7919 + shard * 104729 + 17) % blocks < quota % blocks
       THEN 1 ELSE 0 END))::BIGINT AS taken
  FROM cut GROUP BY doc_id)
SELECT d.doc_id, d.size, s.source_size, s.target, coalesce(t.taken, 0)::BIGINT AS taken
FROM docs d JOIN sources s ON d.src = s.src LEFT JOIN takes t ON d.doc_id = t.doc_id
"""
