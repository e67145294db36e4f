"""Hard negatives by inner product, with LEMP's pruning: length buckets, sorted coordinate lists, exact verification.

Vectors are quantised to integers, so scores are exact. Rows are split by length (a bucket holds lengths within a
factor of 2^(1/8)) and each bucket into pieces of about ``PIECE`` rows, whatever holds them: a hot label or vector
only makes more pieces. A query asks for the best ``k`` scores within windows [low, high]. It visits the pieces whose
greatest length can reach its lowest bound at all. In a piece the bound is an angle: with t = low / (|q| * greatest
length), only vectors within arccos(t) of the query count, so each coordinate of the unit vector has a feasible range.
The ranges of the query's ``FOCUS`` coordinates (its largest) are looked up in the piece's sorted lists, the narrowest
gives the candidates, the others are intersected with it, and what is left is scored exactly. Where the bound is not
positive nothing is pruned.

Positives are a first search (rows of the anchor's label); its bound is the k-th best score in one piece of the label,
from a search of that piece alone. Negatives are a second one, with a window for each positive.

A task holds one piece and streams the queries past it. Queries are dealt to blocks of ``QUERIES``, so neither side of
a cell (piece, block) grows with the input.

Left out: null vec_id, label or vector, and null or non-finite components. Quantised components beyond 2^24 are held
at that bound; vectors of unlike length are filled up with zeros. Other rows are those of another vec_id. A repeated
row counts as often as it occurs, but as an anchor once. An empty table gives an empty result; an anchor without
positives or hard negatives has no rows. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from stallwise.llm.common import saved, table

PIECE = 4096
QUERIES = 1 << 16
FOCUS = 3
BUCKETS_PER_DOUBLING = 8
#: Scores lie far within it.
LEAST = -(1 << 62)
_LIMIT = 1 << 24
#: Taken off bounds and added to ranges: what floating point may lose.
_SLACK = 1e-9


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component."""
    scaled = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    return F.transform(scaled, lambda x: F.greatest(F.lit(-_LIMIT), F.least(F.lit(_LIMIT), x)).cast("int"))


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return vector.isNotNull() & finite


def _length(vector: Column) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def index_of(rows: DataFrame) -> DataFrame:
    """rows (id, label, vec of integers) with their length bucket (-1: length 0) and a number to deal them by."""
    bucket = F.floor(F.log2(_length(F.col("vec"))) * BUCKETS_PER_DOUBLING).cast("int")
    return rows.select(
        "id",
        "label",
        "vec",
        F.coalesce(bucket, F.lit(-1)).alias("bucket"),
        F.xxhash64(F.monotonically_increasing_id()).alias("deal"),
    )


def _pieces(index: DataFrame, same_label: bool) -> DataFrame:
    """(label if it divides, bucket, parts): a row for each bucket."""
    by = ["label", "bucket"] if same_label else ["bucket"]
    return index.groupBy(*by).agg(F.ceil(F.count("*") / PIECE).alias("parts"))


def _visits(queries: DataFrame, pieces: DataFrame, same_label: bool) -> DataFrame:
    """queries with each (bucket, part) whose rows may reach their lowest bound."""
    listed = F.collect_list(F.struct("bucket", "parts"))
    if same_label:
        queries = queries.join(pieces.groupBy("label").agg(listed.alias("pieces")), "label")
    else:
        # One row: a length has at most some 60 doublings.
        queries = queries.withColumn("pieces", pieces.agg(listed).scalar())
    low = F.array_min(F.transform("windows", lambda w: w.low)).cast("double")
    reach = _length(F.col("vec")) * (1 + _SLACK)
    longest = lambda p: F.when(p.bucket < 0, F.lit(0.0)).otherwise(
        F.pow(F.lit(2.0), (p.bucket + 1) / BUCKETS_PER_DOUBLING)
    )
    near = queries.withColumn("pieces", F.filter("pieces", lambda p: longest(p) * reach >= low))
    near = near.select("*", F.explode("pieces").alias("p"))
    return near.select("*", "p.bucket", F.explode(F.sequence(F.lit(0).cast("long"), F.col("p.parts") - 1)).alias("part"))


class Piece:
    """Rows of one piece: exact vectors, and sorted lists of the coordinates of their unit vectors."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        lengths = np.sqrt((vectors.astype(float) ** 2).sum(axis=1))
        self.longest = float(lengths.max(initial=0))
        self._unit = vectors / np.where(lengths > 0, lengths, 1)[:, None]
        self._lists = {}

    def _list(self, f: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows by coordinate f, their values, and the place of each row."""
        if f not in self._lists:
            order = np.argsort(self._unit[:, f], kind="stable")
            place = np.empty_like(order)
            place[order] = np.arange(len(order))
            self._lists[f] = order, self._unit[order, f], place
        return self._lists[f]

    def candidates(self, query: np.ndarray, low: int) -> np.ndarray | None:
        """Rows that may reach the bound; None: all of them."""
        length = float(np.sqrt((query.astype(float) ** 2).sum()))
        if low <= 0:
            return None
        if length * self.longest * (1 + _SLACK) < low:
            return np.zeros(0, dtype=np.int64)
        angle = np.arccos(min(1.0, max(0.0, low / (length * self.longest) - _SLACK)))
        unit = query / length
        focus = np.argsort(-np.abs(unit), kind="stable")[:FOCUS]
        own = np.arccos(np.clip(unit[focus], -1, 1))
        least = np.cos(np.minimum(np.pi, own + angle)) - _SLACK
        most = np.cos(np.maximum(0, own - angle)) + _SLACK
        ranges = []
        for f, lo, hi in zip(focus, least, most, strict=True):
            values = self._list(int(f))[1]
            start, end = np.searchsorted(values, lo), np.searchsorted(values, hi, side="right")
            ranges.append((int(end - start), int(f), int(start), int(end)))
        ranges.sort()
        if not ranges:
            return None
        _, f, start, end = ranges[0]
        rows = self._list(f)[0][start:end]
        for _, f, start, end in ranges[1:]:
            place = self._list(f)[2][rows]
            rows = rows[(place >= start) & (place < end)]
        return rows

    def scores(self, rows: np.ndarray | slice, queries: np.ndarray) -> np.ndarray:
        """Exact inner products: in floating point where the sums are whole numbers below 2^53."""
        vectors = self.vectors[rows]
        if self.longest * np.sqrt((queries.astype(float) ** 2).sum(axis=-1).max(initial=0)) < 2**52:
            return np.rint(vectors.astype(float) @ queries.T.astype(float)).astype(np.int64)
        return vectors.astype(np.int64) @ queries.T.astype(np.int64)


def _matrix(column: pa.ListArray, width: int = 0) -> np.ndarray:
    """Vectors as rows, filled up with zeros to the longest, or to ``width``."""
    sizes = np.asarray(column.value_lengths())
    width = max(width, int(sizes.max(initial=0)))
    values = np.asarray(column.flatten())
    out = np.zeros((len(column), width), dtype=np.int64)
    out[np.arange(width) < sizes[:, None]] = values
    return out


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties by id."""
    places = np.arange(len(scores))
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        places = np.flatnonzero(scores >= least)
    return places[np.lexsort((ids[places], -scores[places]))][:k]


def _answers(piece: Piece, batch: pa.RecordBatch, k: int, same_label: bool) -> Iterator[tuple]:
    """(key, slot, id, score) of the best rows of the piece in each window of the queries."""
    vectors = _matrix(batch.column("vec"), piece.vectors.shape[1])
    if vectors.shape[1] > piece.vectors.shape[1]:
        more = vectors.shape[1] - piece.vectors.shape[1]
        piece = Piece(piece.ids, piece.labels, np.pad(piece.vectors, ((0, 0), (0, more))))
    windows = batch.column("windows").to_pylist()
    found = [piece.candidates(v, min(w["low"] for w in ws)) for v, ws in zip(vectors, windows, strict=True)]
    wide = [i for i, rows in enumerate(found) if rows is None or len(rows) * 4 > len(piece.ids)]
    for at in range(0, len(wide), 256):
        part = wide[at : at + 256]
        for i, scores in zip(part, piece.scores(slice(None), vectors[part]).T, strict=True):
            yield from _of_query(piece, batch, windows[i], i, np.arange(len(piece.ids)), scores, k, same_label)
    for i in sorted(set(range(len(found))).difference(wide)):
        if len(found[i]):
            scores = piece.scores(found[i], vectors[i])
            yield from _of_query(piece, batch, windows[i], i, found[i], scores, k, same_label)


def _of_query(piece, batch, windows, i, rows, scores, k, same_label) -> Iterator[tuple]:
    key, id_, label = (batch.column(c)[i].as_py() for c in ("key", "id", "label"))
    own = piece.labels[rows] == label
    allowed = own & (piece.ids[rows] != id_) if same_label else ~own
    allowed &= scores >= min(w["low"] for w in windows)
    rows, scores = rows[allowed], scores[allowed]
    for w in windows:
        inside = np.flatnonzero((scores >= w["low"]) & (scores <= w["high"]))
        for at in inside[_best(scores[inside], piece.ids[rows[inside]], k)]:
            yield key, w["slot"], int(piece.ids[rows[at]]), int(scores[at])


_FOUND = pa.schema([("key", pa.int64()), ("slot", pa.int32()), ("id", pa.int64()), ("score", pa.int64())])


def _searcher(k: int, same_label: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, rows, piece = None, [], None
        for batch in batches:
            keys = np.asarray(batch.column("cell"))
            asks = np.asarray(batch.column("asks"))
            cuts = np.flatnonzero((np.diff(keys) != 0) | (np.diff(asks) != 0)) + 1
            for start, end in zip([0, *cuts], [*cuts, len(keys)], strict=True):
                if start == end:
                    continue
                part = batch.slice(start, end - start)
                if keys[start] != cell:
                    cell, rows, piece = keys[start], [], None
                if not asks[start]:
                    rows.append(part)
                    continue
                if piece is None:
                    whole = pa.Table.from_batches(rows, batch.schema).combine_chunks()
                    ids, labels = (np.asarray(whole.column(c)) for c in ("id", "label"))
                    vectors = whole.column("vec").combine_chunks()
                    piece, rows = Piece(ids, labels, _matrix(vectors)), []
                for at in range(0, part.num_rows, 1024):
                    found = list(_answers(piece, part.slice(at, 1024), k, same_label))
                    if found:
                        columns = [pa.array(c, t) for c, t in zip(zip(*found, strict=True), _FOUND.types, strict=True)]
                        yield pa.RecordBatch.from_arrays(columns, schema=_FOUND)

    return run


def search(
    index: DataFrame, queries: DataFrame, k: int, same_label: bool, pieces: DataFrame | None = None
) -> DataFrame:
    """(key, slot, rank, id, score): the k best rows of each query and window, by score and then id.

    index: ``index_of``, saved. queries, saved: key, id, label, vec, windows (slot, low, high). Rows of the query's own
    label but another id, or of other labels. ``pieces``: only these of the index.
    """
    by = ["label", "bucket"] if same_label else ["bucket"]
    pieces = saved(_pieces(index, same_label) if pieces is None else pieces, "pieces")
    total = pieces.agg(F.coalesce(F.sum("parts"), F.lit(0)).alias("n")).first().n
    blocks = max(1, -(-queries.count() // QUERIES))
    block = F.sequence(F.lit(0), F.lit(blocks - 1))
    none = F.lit(None).cast("array<struct<slot:int,low:long,high:long>>")
    columns = ["asks", "key", "id", "label", "vec", "windows"]
    rows = index.join(pieces, by).withColumn("part", F.pmod("deal", "parts")).withColumn("block", F.explode(block))
    rows = rows.withColumns({"asks": F.lit(0), "key": F.lit(None).cast("long"), "windows": none})
    asked = _visits(queries, pieces, same_label).withColumn("block", F.pmod("key", F.lit(blocks)).cast("int"))
    cell = F.xxhash64(*by, "part", "block").alias("cell")
    both = rows.select(cell, *columns).union(asked.withColumn("asks", F.lit(1)).select(cell, *columns))
    # Few bytes but much work: a number of tasks by pieces, which Spark does not coalesce.
    both = both.repartition(min(2 * total * blocks, 20_000) or 1, "cell").sortWithinPartitions("cell", "asks")
    found = both.mapInArrow(_searcher(k, same_label), "key long, slot int, id long, score long")
    order = W.partitionBy("key", "slot").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 5, percent: int = 80
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of the rows (id, label, vec of
    integers) that ``anchor`` marks: hard negatives score at least ``percent`` of the positive and at most as much."""
    index = saved(index_of(rows), "vectors")
    anchors = index.where(anchor).select("id", "label", "vec").distinct()
    anchors = saved(anchors.withColumn("key", F.xxhash64("id", "label", "vec")), "anchors")
    window = lambda low, high: F.array(
        F.struct(F.lit(0).alias("slot"), low.cast("long").alias("low"), high.cast("long").alias("high"))
    )
    top = F.lit(-LEAST)

    # The largest bucket of each label, and of it one piece.
    pieces = _pieces(index, True)
    seeds = pieces.groupBy("label").agg(F.max(F.struct("parts", "bucket")).alias("p")).select("label", "p.*")
    sample = index.join(seeds, ["label", "bucket"]).where(F.pmod("deal", "parts") == 0).drop("parts")
    first = saved(anchors.withColumn("windows", window(F.lit(LEAST), top)), "anchors")
    seen = search(saved(sample, "vectors"), first, positives, True)
    bounds = seen.where(F.col("rank") == positives).select("key", F.col("score").alias("bound"))
    asked = anchors.join(bounds, "key", "left")
    asked = asked.withColumn("windows", window(F.coalesce("bound", F.lit(LEAST)), top)).drop("bound")
    found = search(index, saved(asked, "anchors"), positives, True, pieces)
    named = {"slot": F.col("rank"), "positive_id": F.col("id"), "positive_score": F.col("score")}
    found = saved(found.select("key", *[c.alias(name) for name, c in named.items()]), "positives")

    # A positive of a negative score has no window: a share of it would lie above it.
    low = F.expr(f"({percent} * positive_score + 99) div 100").alias("low")
    hard = found.where("positive_score >= 0").groupBy("key")
    hard = hard.agg(F.collect_list(F.struct("slot", low, F.col("positive_score").alias("high"))).alias("windows"))
    asked = saved(anchors.join(hard, "key"), "anchors")
    answers = search(index, asked, negatives, False).withColumnRenamed("id", "negative_id")
    named = answers.join(found, ["key", "slot"]).join(anchors.select("key", F.col("id").alias("anchor_id")), "key")
    return named.select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", F.col("score").alias("negative_score")
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    rows = rows.where(rows["vec_id"].isNotNull() & rows["label"].isNotNull() & usable(rows["embedding"]))
    label = F.when(rows["vec_id"] % 7 == 0, (rows["label"] + 1) % 10).otherwise(rows["label"]).cast("int")
    rows = rows.select(rows["vec_id"].alias("id"), label.alias("label"), quantised(rows["embedding"]).alias("vec"))
    return hard_negatives(rows, F.col("id") % 100 == 0)


OP11_SQL = """
WITH vectors AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)),
scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS alike, list_dot_product(a.v, r.v)::BIGINT AS score
  FROM vectors a JOIN vectors r ON a.vec_id % 100 = 0 AND r.vec_id <> a.vec_id),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT alike AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5
"""
