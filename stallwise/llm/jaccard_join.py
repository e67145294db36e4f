"""N-gram Jaccard join, by set size: subsets of small sets, inverted lists of large ones, the boundary by cost.

A document's set holds its distinct runs of ``SHINGLE`` words (ASCII white space splits, A-Z is lowered; fewer words:
the whole sequence), as 64-bit hashes. Two documents link when 100 * intersection >= ``PERCENT`` * union. Documents with
the same set are one row of the join from the start, however many they are.

Sets of sizes a and b link only if they share c(a, b) = ceil(PERCENT * (a + b) / (100 + PERCENT)) shingles, so they
differ in at most d = a + b - 2c.

- Light sets (up to the boundary) enumerate their subsets of every such fixed size c; a linked pair has one in common.
- Heavy sets enter inverted lists, and so do light ones that may link to a heavy one. A list of one shingle would hold
  every document with a frequent passage, so the lists are finer: at each level (a range of sizes) the shingles fall
  into d + 1 + g parts by hash, and each part, with all it holds, is a list. A linked pair agrees in g + 1 parts at
  least. So a set leaves g of its parts, empty ones and then its longest lists, and still meets its partners.
- The boundary is the one of least cost by the numbers of sets of each small size: a subset is written once, a list
  entry is written, scanned and leads to candidates, ``LIST_COST`` in all.

Lists are scanned without all pairs of them: a set is first compared with the one that most of its lists begin with.
Of lists that this leaves in several components, those of up to ``LONG`` sets give their pairs of unlike components; in
longer ones the differences from a set near the list's (its hub) are joined in place of the sets (see ``_close``).
Pairs whose sketches differ in more bits than linked sets can in shingles leave these joins at once (``sketch``).
Links are decided by the exact sets, which are made anew for the texts that share a list. Components are those of all
links. Sets equal in their 64-bit hashes count as equal.

n_shingles is the size of the set; component_id the smallest doc_id reachable. No words, or null: an empty set, linked
with nothing, component_id is its own doc_id. Null ids don't count in a smallest one (a group of only those: null).
Repeated rows are rows of their own. An empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from stallwise.llm.common import components, dropped, parts_of, saved, table
from stallwise.llm.hashing import mixed, shingles, word_hashes

SHINGLE = 4
PERCENT = 85
#: Sizes for which subsets are thought of at all.
LIGHTEST, LONG, LIST_COST = 32, 64, 4
#: No set has as many shingles.
_LARGEST = 1 << 40
#: Columns of a sketch, 64 bits each.
SKETCH = ["s0", "s1", "s2", "s3"]


def least_common(a: int, b: int, percent: int) -> int:
    return -(-percent * (a + b) // (100 + percent))


@cache
def level_starts(percent: int) -> tuple[int, ...]:
    """Smallest size of each level; a set's partners lie in its own level or the next to it."""
    out = [1]
    while out[-1] < _LARGEST:
        out.append(max(out[-1] + 1, -(-out[-1] * 10_000 // percent**2)))
    return tuple(out)


def largest_partner(n: int, percent: int) -> int:
    return n * 100 // percent


def spare(level: int, percent: int) -> int:
    """g of a level: how many long lists a set may leave."""
    return 3 + _difference(level, percent) // 24


def _difference(level: int, percent: int) -> int:
    """Most shingles in which linked sets differ whose smaller one is of the level."""
    most = level_starts(percent)[level + 1] - 1
    return (100 - percent) * (most + largest_partner(most, percent)) // (100 + percent)


def parts_at(level: int, percent: int) -> int:
    return _difference(level, percent) + 1 + spare(level, percent)


def levels_of(n: int, percent: int) -> list[int]:
    """Levels of a size: its own, and the one below if a set of that may be its smaller partner."""
    starts = level_starts(percent)
    own = int(np.searchsorted(starts, n, side="right")) - 1
    below = own > 0 and n <= largest_partner(starts[own] - 1, percent)
    return [own, own - 1] if below else [own]


def subset_sizes(n: int, percent: int) -> list[int]:
    """Sizes of the subsets that a light set enumerates: one for each size of a partner."""
    partners = range(-(-n * percent // 100), largest_partner(n, percent) + 1)
    return sorted({c for b in partners if (c := least_common(n, b, percent)) <= min(n, b)})


def boundary(sets: dict[int, int], percent: int) -> int:
    """Largest light size, by least cost; ``sets`` counts the sets of each size up to ``LIGHTEST``."""

    def light(n: int) -> int:
        return sum(comb(n, c) for c in subset_sizes(n, percent))

    def heavy(n: int) -> int:
        return LIST_COST * sum(parts_at(level, percent) for level in levels_of(n, percent))

    def cost(x: int) -> int:
        return sum(count * ((n <= x) * light(n) + (100 * n >= percent * (x + 1)) * heavy(n)) for n, count in sets.items())

    return min(range(LIGHTEST + 1), key=lambda x: (cost(x), x))


def shingle_set(text: bytes | None, size: int) -> np.ndarray:
    return np.unique(shingles(word_hashes(np.frombuffer(text or b"", dtype=np.uint8))[2], size))


def list_keys(hashes: np.ndarray, level: int, percent: int) -> tuple[np.ndarray, int]:
    """Keys of the inverted lists of a set at a level, one for each part, by what it holds; and how many more it may
    leave. Empty parts are left first, as all their sets would meet; a set with too many stays in all (-1)."""
    parts = parts_at(level, percent)
    with np.errstate(over="ignore"):
        spread = mixed(hashes + np.uint64(level + 1))
        part = ((spread >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(spread[np.argsort(part, kind="stable")], dtype=np.uint64)])
        sizes = np.bincount(part, minlength=parts)
        ends = np.cumsum(sizes)
        held = sums[ends] - sums[ends - sizes]
        keys = mixed(mixed(held) + np.arange(parts, dtype=np.uint64) + (np.uint64(level + 1) << np.uint64(40)))
    left = spare(level, percent) - int(np.count_nonzero(sizes == 0))
    return (keys[sizes > 0], left) if left >= 0 else (keys, -1)


def sketch(hashes: np.ndarray) -> np.ndarray:
    """Parities of how many shingles fall on each bit: a shingle in which two sets differ changes one bit, so their
    sketches differ in as many bits at most."""
    with np.errstate(over="ignore"):
        bit = (mixed(hashes ^ np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)) % np.uint64(64 * len(SKETCH))
    odd = np.bincount(bit.astype(np.int64), minlength=64 * len(SKETCH)) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


@cache
def _left_out(n: int, c: int) -> np.ndarray:
    """Places left out of a set of n by each of its subsets of c."""
    return np.array(list(combinations(range(n), n - c)), dtype=np.int64).reshape(comb(n, c), n - c)


def subset_keys(hashes: np.ndarray, percent: int) -> np.ndarray:
    """Keys of all subsets that a light set enumerates."""
    with np.errstate(over="ignore"):
        values = mixed(hashes)
        keys = []
        for c in subset_sizes(len(hashes), percent):
            rest = values.sum(dtype=np.uint64) - values[_left_out(len(hashes), c)].sum(axis=1, dtype=np.uint64)
            keys.append(mixed(rest) + np.uint64(c))
        return np.concatenate(keys)


def _signed(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """A row of each row of docs: row, doc_id, text_hash; set and n: hash and size of its set; small: the set itself, if
    it is; level; own, own_left, below, below_left: ``list_keys`` at its own level and the one below."""
    rows = docs.select(docs["doc_id"], F.xxhash64(docs["text"]).alias("text_hash"), docs["text"].cast("binary"))
    names = ["doc_id", "text_hash", "set", "n", "small", "level", "own", "own_left", "below", "below_left"]
    longs = pa.list_(pa.int64())
    kinds = [pa.int64(), pa.int64(), longs, pa.int32(), longs, pa.int32(), longs, pa.int32()]

    def signature(hashes: np.ndarray) -> tuple:
        n = len(hashes)
        if not n:
            return 0, 0, *[None] * 6
        with np.errstate(over="ignore"):
            key = mixed(mixed(hashes).sum(dtype=np.uint64) + np.uint64(n))
        levels = levels_of(n, percent)
        lists = [(keys.view(np.int64), left) for keys, left in (list_keys(hashes, k, percent) for k in levels)]
        small = hashes.view(np.int64) if n <= LIGHTEST else None
        return int(key.view(np.int64)), n, small, levels[0], *lists[0], *(lists[1] if len(lists) > 1 else (None, None))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts_of(batches):
            out = [signature(shingle_set(text.as_py(), size)) for text in batch.column(2)]
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=names)

    kind = rows.schema["doc_id"].dataType.simpleString()
    lists = "own array<long>, own_left int, below array<long>, below_left int"
    signed = rows.mapInArrow(
        run, f"doc_id {kind}, text_hash long, set long, n long, small array<long>, level int, {lists}"
    )
    return signed.withColumn("row", F.monotonically_increasing_id())


def _entries(signed: DataFrame, light: int, percent: int) -> DataFrame:
    """(key, entry): the lists and subsets of each row; entry is 4 * row + 0 (own level), 1 (below), 2 (subset)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [subset_keys(np.asarray(s.values).view(np.uint64), percent).view(np.int64) for s in batch.column(1)]
            keys = pa.array(keys, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), keys], names=["row", "keys"])

    small = signed.where((F.col("n") > 0) & (F.col("n") <= light)).select("row", "small")
    subsets = small.mapInArrow(run, "row long, keys array<long>").select("row", F.lit(2).alias("kind"), "keys")
    heavy = signed.where(F.col("n") * 100 >= percent * (light + 1))
    own = heavy.select("row", F.lit(0).alias("kind"), F.col("own").alias("keys"))
    below = heavy.where("below IS NOT NULL").select("row", F.lit(1), "below")
    every = own.union(below).union(subsets)
    return every.select(F.explode("keys").alias("key"), (F.col("row") * 4 + F.col("kind")).alias("entry"))


def _met(entries: DataFrame) -> DataFrame:
    """The entries of lists with several rows."""
    met = entries.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    return saved(entries.join(met, "key", "left_semi"), "met")


def _members(met: DataFrame, rows: DataFrame) -> DataFrame:
    """(key, set, n, weight) of the lists with several sets, after each set has left as many of its longest as it may.
    Subsets are of level -1 and left by none. weight: the sizes of the set's lists, with those that it leaves."""
    kind = F.pmod("entry", F.lit(4))
    level = F.when(kind == 2, F.lit(-1)).otherwise(F.col("level") - kind)
    left = F.when(kind == 0, F.col("own_left")).when(kind == 1, F.col("below_left")).otherwise(F.lit(0))
    named = met.withColumn("row", F.shiftright("entry", 2)).join(rows, "row")
    named = named.select("key", "set", "n", level.cast("int").alias("level"), left.alias("left")).distinct()
    named = saved(named, "named")
    dropped(met)
    sizes = named.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    longest = W.partitionBy("set", "level").orderBy(F.desc("size"), "key")
    weight = F.sum("size").over(W.partitionBy("set", "level")).alias("weight")
    ranked = named.join(sizes, "key").select("*", weight, F.row_number().over(longest).alias("place"))
    members = saved(ranked.where("place > left").select("key", "set", "n", "weight"), "members")
    dropped(named)
    return members


def _first(members: DataFrame, name: str) -> DataFrame:
    """(key, name, name_n): of each list the set of most weight. One that others are copies of is in most of their
    lists, so it comes first in all of them, and they have one first set instead of many."""
    first = members.groupBy("key").agg(F.max(F.struct("weight", "set", "n")).alias("first"))
    return first.select("key", F.col("first.set").alias(name), F.col("first.n").alias(f"{name}_n"))


def _sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(set, hashes) and sketch of the wanted texts (set, doc_id, text_hash)."""
    texts = docs.select(docs["doc_id"].alias("d"), F.xxhash64(docs["text"]).alias("h"), docs["text"].cast("binary"))
    rows = texts.join(wanted, F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("h") == F.col("text_hash")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts_of(batches):
            hashes = [shingle_set(t.as_py(), size) for t in batch.column(1)]
            sketches = np.array([sketch(h) for h in hashes], dtype=np.int64).reshape(-1, len(SKETCH))
            lists = pa.array([h.view(np.int64) for h in hashes], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists, *map(pa.array, sketches.T)], names=names)

    names = ["set", "hashes", *SKETCH]
    schema = f"set long, hashes array<long>, {', '.join(f'{c} long' for c in SKETCH)}"
    return rows.select("set", "text").mapInArrow(run, schema).dropDuplicates(["set"])


def _may_link(a: str | Column, b: str | Column, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _not_apart(percent: int) -> Column:
    """Whether the sets a and b may link by their sizes and sketches."""
    bits = sum((F.bit_count(F.col(f"a_{c}").bitwiseXOR(F.col(f"b_{c}"))) for c in SKETCH), F.lit(0))
    both = F.col("a_n") + F.col("b_n")
    return _may_link("a_n", "b_n", percent) & ((100 + percent) * bits <= (100 - percent) * both)


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _best(met: DataFrame) -> DataFrame:
    """(a, b): of the sets b that each set a met, the one it met most."""
    counted = met.groupBy("a", "b").agg(F.count("*").alias("times"))
    best = counted.groupBy("a").agg(F.max(F.struct("times", "b")).alias("best"))
    return _ordered(best.select("a", F.col("best.b").alias("b")))


def _most_apart(n: Column, percent: int) -> Column:
    """Shingles in which a set of size n and any set linked with it differ at most."""
    return F.floor((100 - percent) * (n + F.floor(100 * n / percent)) / (100 + percent))


def _hubs(long: DataFrame) -> DataFrame:
    """(key, hub, hub_n) of long lists: from the first set of a list on, twice, to the heaviest first set of the lists
    that set is in. So lists of one group of copies have few hubs."""
    firsts = long.groupBy("key").agg(F.max(F.struct("weight", "set", "n")).alias("hub"))
    firsts = saved(firsts, "firsts")
    up = long.join(firsts, "key").groupBy(F.col("set").alias("from")).agg(F.max("hub").alias("to"))
    up = saved(up, "hubs")
    hubs = firsts
    for _ in range(2):
        hubs = hubs.join(up, F.col("hub.set") == F.col("from")).select("key", F.col("to").alias("hub"))
    return hubs.select("key", F.col("hub.set").alias("hub"), F.col("hub.n").alias("hub_n"))


def _differences(long: DataFrame, sets: DataFrame) -> DataFrame:
    """(hub, hub_n, set, n, sketch, apart) of the members of long lists: their differences from the hub of a list."""
    near = long.join(_hubs(long), "key").select("hub", "hub_n", "set", "n").distinct()
    both = near.join(sets.withColumnRenamed("hashes", "x"), "set")
    both = both.join(sets.select(F.col("set").alias("hub"), F.col("hashes").alias("h")), "hub")
    apart = F.concat(F.array_except("x", "h"), F.array_except("h", "x")).alias("apart")
    return saved(both.select("hub", "hub_n", "set", "n", *SKETCH, apart), "differences")


def _close(differences: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs of unlike components, near one hub, that may link; all of those that do are among them.

    Two sets differ in what their differences from the hub don't share, so close sets share much of those: a prefix
    filter, rarest shingles first. Of two sets the one nearer to the hub has a shared shingle among its first d / 2 + 1,
    the other among its first d + 1, if linked sets differ in at most d. One mark that all share, the last in the
    order, stands for pairs that may differ in all.
    """
    mark = F.lit(None).cast("long")
    rows = differences.join(labels, "set", "left").withColumn("label", F.coalesce("component", "set"))
    unlike = rows.groupBy("hub").agg(F.min("label").alias("l"), F.max("label").alias("h")).where("l <> h").select("hub")
    rows = rows.join(unlike, "hub", "left_semi").withColumn("d", F.size("apart")).select(
        "hub", "set", "n", *SKETCH, "d", "label", F.explode(F.concat("apart", F.array(mark))).alias("shingle")
    )
    often = rows.where("shingle IS NOT NULL").groupBy("hub", "shingle").agg(F.count("*").alias("often"))
    placed = rows.join(often, ["hub", "shingle"], "left")
    rare = W.partitionBy("hub", "set").orderBy(F.col("often").asc_nulls_last(), "shingle")
    most = _most_apart(F.col("n"), percent)
    placed = placed.withColumn("place", F.row_number().over(rare)).where(F.col("place") <= most + 1)
    first = (F.col("place") <= F.floor(most / 2) + 1).alias("first")
    shingle = F.coalesce("shingle", F.lit(0)).alias("shingle")
    placed = saved(placed.select("hub", shingle, first, "set", "n", *SKETCH, "d", "label"), "prefixes")
    columns = ("set", "n", *SKETCH, "d", "label")
    one, two = (placed.select("hub", "shingle", "first", *[F.col(c).alias(f"{x}_{c}") for c in columns]) for x in "ab")
    met = one.where("first").drop("first").join(two.drop("first"), ["hub", "shingle"])
    nearer = F.struct("a_d", "a_set") < F.struct("b_d", "b_set")
    met = met.where(nearer & (F.col("a_label") != F.col("b_label")) & _not_apart(percent))
    return met.select(F.col("a_set").alias("a"), F.col("b_set").alias("b"))


def _links(docs: DataFrame, signed: DataFrame, rows: DataFrame, size: int, percent: int) -> DataFrame:
    """(a, b): links of sets whose components are those of all links. The files of signed go."""
    counted = rows.where((F.col("n") > 0) & (F.col("n") <= LIGHTEST)).groupBy("n").agg(F.count("*").alias("sets"))
    light = boundary({r.n: r.sets for r in counted.collect()}, percent)
    met = _met(_entries(signed, light, percent))
    dropped(signed)
    members = _members(met, rows)
    place = F.struct("doc_id", "text_hash")
    texts = rows.join(members.select("set").distinct(), "set", "left_semi").groupBy("set").agg(F.min(place).alias("p"))
    sets = saved(_sets(docs, texts.select("set", "p.*"), size), "sets")

    def linked(pairs: DataFrame) -> DataFrame:
        hashes = sets.select("set", "hashes")
        both = pairs.join(hashes.toDF("a", "x"), "a").join(hashes.toDF("b", "y"), "b")
        common = F.size(F.array_intersect("x", "y"))
        link = (100 + percent) * common >= percent * (F.size("x") + F.size("y"))
        return saved(both.where(link).select("a", "b"), "set-links")

    def labelled(labels: DataFrame) -> DataFrame:
        """Members of the lists that hold several components, with those, and the list's size."""
        found = members.join(labels, "set", "left").withColumn("label", F.coalesce("component", "set")).drop("component")
        lists = found.groupBy("key").agg(F.min("label").alias("l"), F.max("label").alias("h"), F.count("*").alias("size"))
        return saved(found.join(lists.where("l <> h").select("key", "size"), "key"), "labelled")

    # With which of the first sets of its lists a set is compared at first doesn't matter: the last steps miss none.
    met = members.withColumnRenamed("set", "a").join(_first(members, "b"), "key")
    links = linked(_best(met.where((F.col("a") != F.col("b")) & _may_link("n", "b_n", percent)).select("a", "b")))

    found = labelled(components(links).withColumnRenamed("node", "set"))
    differences = _differences(found.where(F.col("size") > LONG), sets)
    near = (100 + percent) * F.size("apart") <= (100 - percent) * (F.col("n") + F.col("hub_n"))
    near = differences.where(near & (F.col("set") != F.col("hub")))
    ends = F.least("set", "hub").alias("a"), F.greatest("set", "hub").alias("b")
    links = links.union(saved(near.select(*ends), "near-hub"))

    labels = saved(components(links).withColumnRenamed("node", "set"), "set-labels")
    short = labelled(labels).where(F.col("size") <= LONG)
    short = saved(short.select("key", "set", "n", "label").join(sets.drop("hashes"), "set"), "short")
    one, two = (short.select("key", *[F.col(c).alias(f"{x}_{c}") for c in ("set", "n", *SKETCH, "label")]) for x in "ab")
    unlike = (F.col("a_label") < F.col("b_label")) & _not_apart(percent)
    met = one.join(two, "key").where(unlike).select(F.col("a_set").alias("a"), F.col("b_set").alias("b"))
    return links.union(linked(_ordered(met.union(_close(differences, labels, percent)))))


def linked_documents(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of docs (doc_id, text)."""
    signed = saved(_signed(docs, size, percent), "shingle-sets")
    rows = saved(signed.drop("small", "own", "below"), "set-rows")
    found = components(_links(docs, signed, rows, size, percent)).withColumnRenamed("node", "set")
    firsts = rows.where("n > 0").groupBy("set").agg(F.min("doc_id").alias("first"))
    rooted = firsts.join(found, "set", "left").withColumn("root", F.coalesce("component", "set"))
    roots = rooted.groupBy("root").agg(F.min("first").alias("lowest"))
    # Written, so that the next join has plain shuffles below, which Spark may split at a hot set.
    lowest = saved(rooted.join(roots, "root").select("set", "lowest"), "set-groups")
    out = rows.select("doc_id", "n", "set").join(lowest, "set", "left")
    own = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("lowest"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_documents(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * c >= 85 * (p.n + q.n - c)),
reach AS (
  SELECT DISTINCT a AS doc_id, a AS other FROM links
  UNION
  SELECT r.doc_id, b FROM reach r JOIN links ON other = a),
lowest AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(component_id, d.doc_id) AS component_id
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN lowest USING (doc_id)
"""
