"""Language identification: interpolated Kneser-Ney character models, one per language.

Text: lower case, split into runs of letters. A model gives the probability of each letter of a word, and of the
word's end, after the four symbols before it (a word begins with padding).

Learning: every training document counts. Each task counts words, turns them into five-symbol grams with counts,
and Spark adds those up per (language, gram). Lower orders count distinct continuations, those at the beginning
of a word occurrences, all with one discount per order and language. The table of grams is a model, not the
corpus: it grows with the variety of five-letter sequences. No gram is left out.

Model of up to ``IN_MEMORY`` grams: sorted arrays of 64-bit gram hashes with a log probability per language, and
sorted arrays of context hashes with the weight of the lower order, broadcast. Of more: the same numbers as tables
on the cluster (``TableModel``), made by aggregates and joins; texts are scored by joins of their distinct words
with them, and nothing of the model's size comes to the driver or to a task. Both give the same probabilities.

Deciding: the language with the lowest cross-entropy per symbol. The score says how far the others are behind,
0 to 1. A document is accepted if its cross-entropy is not too far above what documents of that language, which
the counts did not see, have: the excess over their mean, in standard errors for its length, is at most
``SLACK`` times the quantile ``ACCEPTED`` of theirs.

Folds: crc32 of the id as text modulo 5. Fold 0 is held out, fold 1 calibrates, the others are counted. Language,
source and id are no inputs of a prediction.

Null texts and texts without a letter are ``und``, score 0, not accepted. Rows with a null id are
held out. Without any training document, all is ``und``. Repeated rows and extra columns change nothing.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from stallwise.llm.common import fresh, saved, table

ORDER = 5
#: Grams of a model that each worker holds in memory; a larger one stays in tables.
IN_MEMORY = 2_000_000
FOLDS = 5
ACCEPTED = 0.999
SLACK = 2.0
UNKNOWN = "und"
_PAD, _END = "\x02", "\x03"
_LETTERS = re.compile(r"[^\W\d_]+")
_SPACE = re.compile(r"\s")
#: Words that a task remembers the scores of, and characters of a text read at a time.
_WORDS = 200_000
_STRETCH = 1 << 20
#: Words of a language that a task counts before it hands their grams on.
_COUNTED = 50_000
#: Texts scored at a time.
_ROWS = 256
#: New words scored at a time: their grams have a row of scores per language.
_LEARNED = 1 << 13
_DECIDED = pa.schema(
    {"lang_pred": pa.string(), "score": pa.float64(), "entropy": pa.float64(), "symbols": pa.int64(), "accepted": pa.bool_()}
)


def _words(text: str) -> Iterator[list[str]]:
    """Runs of letters, in lists, a stretch of the text at a time."""
    text = text.lower()
    at = 0
    while at < len(text):
        end = _SPACE.search(text, at + _STRETCH) if len(text) - at > _STRETCH else None
        stop = end.start() if end else len(text)
        yield _LETTERS.findall(text, at, stop)
        at = stop


def _symbols(words: list[str], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Grams of all symbols of the words, a row each, and the place of each gram's word."""
    pad = _PAD * (order - 1)
    joined = "".join([f"{pad}{w}{_END}" for w in words])
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    if len(codes) < order:
        return np.empty((0, order), dtype=np.uint32), np.empty(0, dtype=np.int64)
    grams = np.lib.stride_tricks.sliding_window_view(codes, order)
    grams = grams[grams[:, -1] != ord(_PAD)]
    lengths = np.array([len(w) + 1 for w in words])
    return grams, np.repeat(np.arange(len(words)), lengths)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hashes(grams: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each row; the number of columns counts."""
    out = np.full(len(grams), grams.shape[1] + 1, dtype=np.uint64)
    for k in range(grams.shape[1]):
        out = _mixed(out * np.uint64(0x9E3779B97F4A7C15) + grams[:, k].astype(np.uint64))
    return out


def gram_counts(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, gram, n): grams of ``order`` symbols in the words of docs (lang, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for words in _words(text.as_py() or ""):
                    counter = counts.setdefault(lang, Counter())
                    counter.update(words)
                    if len(counter) > _COUNTED:
                        yield _counted(lang, counts.pop(lang), order)
        for lang, counter in counts.items():
            yield _counted(lang, counter, order)

    return (
        docs.select("lang", "text")
        .mapInArrow(run, "lang string, gram string, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )


def _counted(lang: str, counter: Counter, order: int) -> pa.RecordBatch:
    words = list(counter)
    grams, word = _symbols(words, order)
    weights = np.array([counter[w] for w in words], dtype=np.float64)[word] if words else np.empty(0)
    _, first, inverse = np.unique(_hashes(grams), return_index=True, return_inverse=True)
    n = np.bincount(inverse, weights=weights, minlength=len(first)).astype(np.int64)
    text = np.ascontiguousarray(grams[first]).view(f"<U{order}").ravel().tolist() if len(first) else []
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * len(text), pa.string()), pa.array(text, pa.string()), pa.array(n)], names=["lang", "gram", "n"]
    )


@dataclass
class Model:
    """Sorted gram and context hashes with a column per language; calibration per language."""

    languages: list[str]
    order: int
    grams: np.ndarray
    log_p: np.ndarray
    contexts: np.ndarray
    back: np.ndarray
    floor: np.ndarray
    mean: np.ndarray | None = None
    spread: np.ndarray | None = None
    limit: np.ndarray | None = None
    sent: Broadcast | None = field(default=None, repr=False, compare=False)

    def __getstate__(self) -> dict:
        return {**self.__dict__, "sent": None}

    def calibrated(self, mean: np.ndarray, spread: np.ndarray, limit: np.ndarray) -> Model:
        """This model, arrays and broadcast shared, with a calibration."""
        return replace(self, mean=mean, spread=spread, limit=limit)

    def broadcast(self, spark: SparkSession) -> Broadcast:
        """The arrays, sent once: a Python worker holds one copy, whatever the calibration."""
        if self.sent is None:
            self.sent = spark.sparkContext.broadcast(replace(self, mean=None, spread=None, limit=None))
        return self.sent

    def losses(self, words: list[str]) -> np.ndarray:
        """Nats that each language spends on each word."""
        out = np.zeros((len(words), len(self.languages)))
        grams, word = _symbols(words, self.order)
        if not len(grams):
            return out
        _, first, inverse = np.unique(_hashes(grams), return_index=True, return_inverse=True)
        per_gram = -self._log_p(np.ascontiguousarray(grams[first]))[inverse]
        starts = np.flatnonzero(np.diff(word, prepend=-1))
        return np.add.reduceat(per_gram, starts, axis=0)

    def _log_p(self, grams: np.ndarray) -> np.ndarray:
        """Log probability of each gram's last symbol after the others, by backing off."""
        order = self.order
        out = np.tile(self.floor, (len(grams), 1))
        found = np.zeros(len(grams), dtype=np.int64)
        for k in range(1, order + 1):
            at, there = _looked_up(self.grams, _hashes(grams[:, order - k :]))
            out[there] = self.log_p[at[there]]
            found[there] = k
        for k in range(order):
            # The context of k symbols is used where the longest gram found is no longer than k.
            at, there = _looked_up(self.contexts, _hashes(grams[:, order - 1 - k : order - 1]))
            there &= found <= k
            out[there] += self.back[at[there]]
        return out


def _looked_up(table_: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(table_):
        return np.zeros(len(keys), dtype=np.int64), np.zeros(len(keys), dtype=bool)
    at = np.minimum(np.searchsorted(table_, keys), len(table_) - 1)
    return at, table_[at] == keys


def _grouped(keys: np.ndarray, *sums: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """First place of each key, the group of each row, and the sums per group."""
    _, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
    out = []
    for values in sums:
        total = np.zeros((len(first), values.shape[1]))
        np.add.at(total, inverse, values)
        out.append(total)
    return first, inverse, out


def model_of(counts: pa.Table, order: int = ORDER) -> Model:
    """Kneser-Ney model of (lang, gram, n) rows."""
    languages = sorted(counts["lang"].unique().to_pylist())
    if not languages:
        nothing, none = np.empty((0, 0)), np.empty(0, dtype=np.uint64)
        return Model([], order, none, nothing, none, nothing, np.empty(0))
    # Arrow keeps the grams end to end as UTF-8: no string of its own for each on the driver.
    parts = [c.slice(0).buffers()[2].to_pybytes() for c in (pa.concat_arrays([x]) for x in counts["gram"].chunks) if len(c)]
    codes = np.frombuffer(b"".join(parts).decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
    rows = codes.reshape(-1, order)
    column = pc.index_in(counts["lang"], pa.array(languages, counts["lang"].type)).to_numpy()
    n = counts["n"].to_numpy()
    first, group, _ = _grouped(_hashes(rows))
    raw = np.zeros((len(first), len(languages)))
    raw[group, column] = n
    # Grams, occurrences and counts of each order, the longest first.
    levels = [(rows[first], raw, raw)]
    del parts, codes, rows, column, n, group
    for _ in range(order - 1):
        grams, raw, counted = levels[-1]
        first, _, (fewer_raw, fewer) = _grouped(_hashes(grams[:, 1:]), raw, (counted > 0).astype(float))
        shorter = grams[first, 1:]
        begins = shorter[:, :1] == ord(_PAD)
        levels.append((shorter, fewer_raw, np.where(begins, fewer_raw, fewer)))
    symbols = len(levels[-1][0]) + 1
    floor = np.full(len(languages), -np.log(symbols))
    lower_keys = np.empty(0, dtype=np.uint64)
    lower = np.empty((0, len(languages)))
    all_grams, all_p, all_contexts, all_back = [], [], [], []
    while levels:
        grams, _, counted = levels.pop()
        ones, twos = (counted == 1).sum(axis=0), (counted == 2).sum(axis=0)
        discount = np.where(ones > 0, ones / np.maximum(ones + 2 * twos, 1), 0.5)
        context_keys = _hashes(grams[:, :-1])
        first, group, (total, kinds) = _grouped(context_keys, counted, (counted > 0).astype(float))
        seen = total > 0
        gamma = np.where(seen, discount * kinds / np.maximum(total, 1), 1.0)
        share = np.maximum(counted - discount, 0) / np.maximum(total, 1)[group]
        if grams.shape[1] == 1:
            below = np.exp(np.tile(floor, (len(grams), 1)))
        else:
            at, there = _looked_up(lower_keys, _hashes(grams[:, 1:]))
            below = np.where(there[:, None], lower[at], np.exp(floor))
        p = share + gamma[group] * below
        keys = _hashes(grams)
        place = np.argsort(keys)
        lower_keys, lower = keys[place], p[place]
        all_grams.append(keys)
        all_p.append(np.log(p))
        all_contexts.append(context_keys[first])
        all_back.append(np.log(gamma))
    grams, contexts = np.concatenate(all_grams), np.concatenate(all_contexts)
    by_gram, by_context = np.argsort(grams), np.argsort(contexts)
    log_p = np.concatenate(all_p)[by_gram].astype(np.float32)
    back = np.concatenate(all_back)[by_context].astype(np.float32)
    return Model(languages, order, grams[by_gram], log_p, contexts[by_context], back, floor)


class _Known(dict):
    """Numbers words as they come up; ``new`` has those without scores yet."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = at = len(self)
        self.new.append(word)
        return at


class _Scorer:
    """Cross-entropies of texts, with a bounded memory of words."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.known, self.scores = _Known(), np.zeros((1 << 12, len(self.model.languages)))

    def _learn(self) -> None:
        new, self.known.new = self.known.new, []
        while len(self.scores) < len(self.known):
            self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)])
        first = len(self.known) - len(new)
        for at in range(0, len(new), _LEARNED):
            some = new[at : at + _LEARNED]
            self.scores[first + at : first + at + len(some)] = self.model.losses(some)

    def losses(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Nats of each language, and symbols, of each text."""
        loss, symbols = np.zeros((len(texts), len(self.model.languages))), np.zeros(len(texts))
        for low in range(0, len(texts), 256):
            if len(self.known) > _WORDS:
                self._forget()
            read = []
            for i in range(low, min(low + 256, len(texts))):
                # Numerals like a half pass for letters in a pattern; a text of those alone has none.
                if not any(map(str.isalpha, texts[i] or "")):
                    continue
                for words in _words(texts[i]):
                    read.append((i, np.array(list(map(self.known.__getitem__, words)), dtype=np.int64)))
                    symbols[i] += sum(map(len, words)) + len(words)
            if self.known.new:
                self._learn()
            for i, at in read:
                loss[i] += self.scores[at].sum(axis=0)
        return loss, symbols


def _decided(model: Model | TableModel, loss: np.ndarray, symbols: np.ndarray) -> pd.DataFrame:
    has = (symbols > 0) & bool(model.languages)
    n = np.maximum(symbols, 1)
    entropy = loss / n[:, None] if model.languages else np.zeros((len(n), 1))
    best = entropy.argmin(axis=1)
    lowest = entropy[np.arange(len(best)), best]
    behind = (entropy - lowest[:, None]) * np.sqrt(n)[:, None]
    score = 1 / np.exp(-np.minimum(behind, 700)).sum(axis=1)
    accepted = has.copy()
    if model.limit is not None:
        excess = (lowest - model.mean[best]) * np.sqrt(n) / model.spread[best]
        accepted &= excess <= model.limit[best]
    names = np.array([*model.languages, UNKNOWN], dtype=object)
    return pd.DataFrame(
        {
            "lang_pred": names[np.where(has, best, len(names) - 1)],
            "score": np.where(has, score, 0.0),
            "entropy": np.where(has, lowest, 0.0),
            "symbols": symbols.astype(np.int64),
            "accepted": accepted,
        }
    )


def predicted(spark: SparkSession, model: Model, text: Column) -> Column:
    """Struct of lang_pred, score, entropy (nats per symbol), symbols and accepted for a text."""
    held = model.broadcast(spark)
    calibration = model.mean, model.spread, model.limit  # one number per language each

    @arrow_udf("lang_pred string, score double, entropy double, symbols long, accepted boolean")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = _Scorer(held.value.calibrated(*calibration))
        for texts in batches:
            # A part of the batch at a time: no batch of long texts is there twice.
            rows = [
                _decided(scorer.model, *scorer.losses(texts.slice(at, _ROWS).to_pylist()))
                for at in range(0, max(len(texts), 1), _ROWS)
            ]
            yield pa.RecordBatch.from_pandas(pd.concat(rows), _DECIDED, preserve_index=False).to_struct_array()

    return run(text)


@dataclass
class TableModel:
    """A model as a table: (key, log_p, back), ``key`` a gram of any order or a context.

    ``log_p`` and ``back`` have a place per language, null where the language did not see the gram or context.
    """

    languages: list[str]
    order: int
    table: DataFrame
    floor: float
    mean: np.ndarray | None = None
    spread: np.ndarray | None = None
    limit: np.ndarray | None = None

    def calibrated(self, mean: np.ndarray, spread: np.ndarray, limit: np.ndarray) -> TableModel:
        return replace(self, mean=mean, spread=spread, limit=limit)

    def losses(self, words: DataFrame) -> DataFrame:
        """(word, loss): nats that each language spends on each word of the table (word), without repeats."""
        order = self.order
        whole = F.concat(F.lit(_PAD * (order - 1)), "word", F.lit(_END))
        grams = F.transform(F.sequence(F.lit(1), F.length("word") + 1), lambda i: F.substring(whole, i, F.lit(order)))
        uses = saved(words.select("word", F.explode(grams).alias("gram")), "word-grams")
        # What a gram may need: its ends as grams, and as contexts of its last symbol.
        keys = [F.substring("gram", order - k + 1, k) for k in range(1, order + 1)]
        keys += [F.substring("gram", order - k, k) for k in range(order)]
        needs = uses.select("gram").distinct().select("gram", F.posexplode(F.array(*keys)).alias("slot", "key"))
        # A gram without any of them still gets the floor: the empty context is in every model.
        met = needs.join(self.table, "key").select(
            "gram", F.struct("slot", F.when(F.col("slot") < order, F.col("log_p")).otherwise(F.col("back")).alias("v")).alias("e")
        )
        found = met.groupBy("gram").agg(F.map_from_entries(F.collect_list("e")).alias("found"))
        at = lambda slot, i: F.get(F.col("found")[F.lit(slot)], i)

        def log_p(i: Column) -> Column:
            out = F.lit(self.floor)
            for k in range(1, order + 1):
                out = F.coalesce(at(k - 1, i).cast("double"), F.coalesce(at(order + k - 1, i).cast("double"), F.lit(0.0)) + out)
            return out

        places = range(len(self.languages))
        costs = found.select("gram", *[(-log_p(F.lit(i))).alias(f"cost_{i}") for i in places])
        sums = uses.join(costs, "gram").groupBy("word").agg(*[F.sum(f"cost_{i}").alias(f"cost_{i}") for i in places])
        return sums.select("word", F.array(*[F.col(f"cost_{i}") for i in places]).alias("loss"))


def tables_of(counts: DataFrame, order: int = ORDER) -> TableModel:
    """The model of (lang, gram, n) rows, as ``model_of`` makes it, by aggregates and joins."""
    level = counts.select("lang", "gram", F.col("n").alias("raw"), F.col("n").alias("counted"))
    levels = [saved(level, "grams-of-order")]
    for k in range(order - 1, 0, -1):
        shorter = levels[-1].groupBy("lang", F.substring("gram", 2, k).alias("gram"))
        shorter = shorter.agg(F.sum("raw").alias("raw"), F.count(F.lit(1)).alias("kinds"))
        begins = F.substring("gram", 1, 1) == _PAD
        counted = F.when(begins, F.col("raw")).otherwise(F.col("kinds")).alias("counted")
        levels.append(saved(shorter.select("lang", "gram", "raw", counted), "grams-of-order"))
    # One row per language.
    languages = sorted(r.lang for r in levels[-1].select("lang").distinct().collect())
    floor = -float(np.log(levels[-1].select("gram").distinct().count() + 1))
    lower, parts = None, []
    for k, level in enumerate(reversed(levels), 1):
        ones, twos = F.count(F.when(F.col("counted") == 1, 1)), F.count(F.when(F.col("counted") == 2, 1))
        discount = F.when(ones > 0, ones / F.greatest(ones + 2 * twos, F.lit(1))).otherwise(0.5).alias("discount")
        discounts = level.groupBy("lang").agg(discount)
        context = F.substring("gram", 1, k - 1)
        contexts = level.groupBy("lang", context.alias("context"))
        contexts = contexts.agg(F.sum("counted").alias("total"), F.count(F.lit(1)).alias("kinds")).join(discounts, "lang")
        gamma = F.col("discount") * F.col("kinds") / F.col("total")
        contexts = saved(contexts.select("lang", "context", "total", "discount", gamma.alias("gamma")), "contexts-of-order")
        rows = level.withColumn("context", context).join(contexts, ["lang", "context"])
        below = F.exp(F.lit(floor))
        if lower is not None:
            rows = rows.withColumn("shorter", F.substring("gram", 2, k)).join(
                lower.select("lang", F.col("gram").alias("shorter"), F.col("p").alias("below")), ["lang", "shorter"]
            )
            below = F.col("below")
        share = F.greatest(F.col("counted") - F.col("discount"), F.lit(0.0)) / F.col("total")
        lower = saved(rows.select("lang", "gram", (share + F.col("gamma") * below).alias("p")), "probabilities")
        nothing = F.lit(None).cast("float")
        parts.append(lower.select("lang", F.col("gram").alias("key"), F.log("p").cast("float").alias("log_p"), nothing.alias("back")))
        parts.append(contexts.select("lang", F.col("context").alias("key"), nothing.alias("log_p"), F.log("gamma").cast("float").alias("back")))
    by_language = lambda name: F.array(*[F.max(F.when(F.col("lang") == x, F.col(name))) for x in languages]).alias(name)
    whole = reduce(DataFrame.unionByName, parts).groupBy("key").agg(by_language("log_p"), by_language("back"))
    return TableModel(languages, order, saved(whole, "language-model"), floor)


def _text_words(docs: DataFrame) -> DataFrame:
    """(key, word, n): words of each distinct text; ``key`` is the text's SHA-256."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py() or ""
                if not any(map(str.isalpha, text)):
                    continue
                counter = Counter(w for words in _words(text) for w in words)
                yield pa.RecordBatch.from_pydict({"key": [key] * len(counter), "word": list(counter), "n": list(counter.values())})

    rows = docs.select(F.sha2("text", 256).alias("key"), "text").where("text IS NOT NULL")
    # Equal texts have equal counts.
    return rows.mapInArrow(run, "key string, word string, n long").groupBy("key", "word").agg(F.max("n").alias("n"))


def marked(docs: DataFrame, model: Model | TableModel, name: str) -> DataFrame:
    """docs (text) with a column of that name: what ``predicted`` gives for the text."""
    if isinstance(model, Model):
        return docs.withColumn(name, predicted(docs.sparkSession, model, docs["text"]))
    words = saved(_text_words(docs), "text-words")
    costs = saved(model.losses(words.select("word").distinct()), "word-losses")
    places = range(len(model.languages))
    sums = words.join(costs, "word").groupBy("key").agg(
        F.array(*[F.sum(F.get("loss", F.lit(i)) * F.col("n")) for i in places]).alias("loss"),
        F.sum((F.length("word") + 1) * F.col("n")).alias("symbols"),
    )
    languages, calibration = model.languages, (model.mean, model.spread, model.limit)  # one number per language each

    @arrow_udf("lang_pred string, score double, entropy double, symbols long, accepted boolean")
    def decide(loss: pa.Array, symbols: pa.Array) -> pa.Array:
        plain = Model(languages, 0, *[np.empty(0)] * 5, *calibration)
        losses = np.array(loss.to_pylist(), dtype=float).reshape(len(loss), len(languages))
        rows = _decided(plain, losses, symbols.to_numpy(zero_copy_only=False).astype(float))
        return pa.RecordBatch.from_pandas(rows, _DECIDED, preserve_index=False).to_struct_array()

    key, found = fresh(docs.withColumn(name, F.lit(0)), "text_key", "decided")
    decided = sums.select(F.col("key").alias(key), decide("loss", "symbols").alias(found))
    unknown = [F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(0.0).alias("entropy")]
    unknown = F.struct(*unknown, F.lit(0).cast("long").alias("symbols"), F.lit(False).alias("accepted"))
    rows = docs.withColumn(key, F.sha2("text", 256)).join(decided, key, "left")
    return rows.withColumn(name, F.coalesce(found, unknown)).drop(key, found)


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; 0 for null."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS, F.lit(0))


def fit(
    docs: DataFrame, order: int = ORDER, max_grams: int | None = None, in_memory: int = IN_MEMORY
) -> Model | TableModel:
    """Model of docs (doc_id, text, lang): folds 2 to 4 counted, fold 1 for calibration.

    All grams count; only a caller that names ``max_grams`` gets a smaller model, without the rarest ones.
    """
    spark = docs.sparkSession
    labelled = docs.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & (fold(F.col("doc_id")) > 0))
    counts = saved(gram_counts(labelled.where(fold(F.col("doc_id")) > 1), order), "grams")
    lowest, n = 1, counts.count()
    while max_grams is not None and n > max_grams:
        lowest *= 2
        n = counts.where(F.col("n") >= lowest).count()
    counts = counts.where(F.col("n") >= lowest)
    # At most in_memory short rows come to the driver.
    model = model_of(counts.toArrow(), order) if n <= in_memory else tables_of(counts, order)
    if not model.languages:
        return model
    # Written before it is filtered: a filter on the scores would be pushed below them and score every text once more,
    # by a second Python worker for each task.
    seen = marked(labelled.where(fold(F.col("doc_id")) == 1), model, "p")
    seen = saved(seen.select("lang", "p.lang_pred", "p.entropy", "p.symbols"), "calibration")
    seen = seen.where("symbols > 0 AND lang_pred = lang").drop("lang_pred")
    per_symbol = F.sum(F.col("entropy") * F.col("symbols")) / F.sum("symbols")
    means = seen.groupBy("lang").agg(per_symbol.alias("mean"))
    scaled = (F.col("entropy") - F.col("mean")) * F.sqrt("symbols")
    means = seen.join(means, "lang").groupBy("lang").agg(
        F.first("mean").alias("mean"),
        F.sqrt(F.avg(scaled * scaled)).alias("spread"),
        F.percentile_approx(scaled, ACCEPTED, 10_000).alias("high"),
    )
    found = {r["lang"]: r for r in means.collect()}  # one row per language
    of = lambda lang, name, default: found[lang][name] if lang in found else default
    mean = np.array([of(x, "mean", 0.0) for x in model.languages])
    spread = np.array([max(of(x, "spread", 1.0), 1e-3) for x in model.languages])
    high = np.array([of(x, "high", np.inf) for x in model.languages])
    return model.calibrated(mean, spread, np.maximum(SLACK * high / spread, SLACK))


def keep_accepted(docs: DataFrame, model: Model | TableModel) -> DataFrame:
    """docs without the rows that the model rejects."""
    (mark,) = fresh(docs, "language")
    rows = marked(docs, model, mark)
    return rows.where(F.col(f"{mark}.accepted")).drop(mark)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = marked(docs.select("doc_id", "text"), fit(docs), "p")
    held_out = (fold(F.col("doc_id")) == 0).alias("held_out")
    return rows.select("doc_id", held_out, "p.lang_pred", "p.score", "p.accepted")
