"""Negative reviews: eligible texts, sample, topics, classification, enriched fact."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallwise.functions.constants import (
    DEADLINE_WORDS,
    DETRACTOR_MAX_SCORE,
    FALLBACK_REASON,
    LOT_SIZE,
    PRODUCT_WORDS,
    SAMPLE_SEED,
    SAMPLE_SIZE,
    UNCLASSIFIED,
    UNDETERMINED,
)
from stallwise.functions.numeric import percent, round_half_up
from stallwise.operators.sampling import seeded_sample
from stallwise.operators.uniqueness import keep_last
from stallwise.sources.layers import write_table
from stallwise.sources.schemas import BATCH_REPLY, CLASSIFICATION

TEXT = "review_comment_message"
FIELDS = CLASSIFICATION.fieldNames()
ENRICHED_TABLE = "fact_reviews_classified"
ANSWERS_TABLE = "review_answers"
WAVES = 8


def eligible(fact_orders: DataFrame) -> DataFrame:
    """Detractors with a text that is not blank; blanks are spaces only, a line break is text."""
    return fact_orders.filter(
        (F.col("review_score") <= DETRACTOR_MAX_SCORE) & F.col(TEXT).isNotNull() & (F.trim(TEXT) != "")
    ).select("order_id", "review_score", TEXT)


def population(fact_orders: DataFrame) -> DataFrame:
    return eligible(fact_orders).agg(F.count(F.lit(1)).alias("population"))


def review_sample(fact_orders: DataFrame, size: int = SAMPLE_SIZE, seed: int = SAMPLE_SEED) -> DataFrame:
    """Sample of the eligible reviews; the filter comes first, then ``size`` rows are drawn."""
    return seeded_sample(eligible(fact_orders), "order_id", size, seed)


def mentions(text: Column, words: Sequence[str]) -> Column:
    """Whether the lower-cased text holds any of the words."""
    lowered = F.lower(text)
    return reduce(lambda a, b: a | b, [F.contains(lowered, F.lit(w)) for w in words], F.lit(False))


def fallback_rows(
    reviews: DataFrame,
    deadline_words: Sequence[str] = DEADLINE_WORDS,
    product_words: Sequence[str] = PRODUCT_WORDS,
) -> DataFrame:
    """What a review becomes when its lot could not be classified: keyword flags and no category."""
    text = F.col(TEXT)
    return reviews.select(
        "order_id",
        F.lit(UNCLASSIFIED).alias("category"),
        F.lit(FALLBACK_REASON).alias("reason"),
        F.lit(UNDETERMINED).alias("severity"),
        mentions(text, deadline_words).alias("about_deadline"),
        mentions(text, product_words).alias("about_product"),
        F.lit(False).alias("about_service"),
    )


def classify_by_keywords(
    reviews: DataFrame,
    taxonomy: Mapping[str, Sequence[str]],
    deadline: str | None = None,
    product: Sequence[str] = (),
    service: str | None = None,
) -> DataFrame:
    """Category with most keywords in the text, earlier categories first on a tie; stays in the JVM.

    Severity follows the number of keywords found: 3 or more 'alta', 2 'media', 1 'baixa'.
    A text without any keyword is unclassified. ``deadline``, ``product`` and ``service`` name the
    categories whose keywords set the complaint flags.
    """
    lowered = reviews.withColumn("_text", F.lower(TEXT))
    found = {
        name: F.filter(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(F.col("_text"), w))
        for name, words in taxonomy.items()
    }
    scored = lowered.select("order_id", *[found[n].alias(f"_f{i}") for i, n in enumerate(taxonomy)])
    place = {name: i for i, name in enumerate(taxonomy)}
    best = F.array_max(
        F.array(
            *[
                F.struct(
                    F.size(f"_f{i}").alias("score"),
                    F.lit(-i).alias("rank"),
                    F.lit(name).alias("category"),
                    F.array_join(f"_f{i}", ", ").alias("words"),
                )
                for name, i in place.items()
            ]
        )
    )

    def touched(names: Sequence[str | None]) -> Column:
        known = [place[n] for n in names if n is not None]
        return reduce(lambda a, b: a | b, [F.size(f"_f{i}") > 0 for i in known], F.lit(False))

    matched = F.col("_best.score") > 0
    severity = (
        F.when(F.col("_best.score") >= 3, F.lit("alta"))
        .when(F.col("_best.score") == 2, F.lit("media"))
        .when(F.col("_best.score") == 1, F.lit("baixa"))
        .otherwise(F.lit(UNDETERMINED))
    )
    return scored.withColumn("_best", best).select(
        "order_id",
        F.when(matched, F.col("_best.category")).otherwise(F.lit(UNCLASSIFIED)).alias("category"),
        F.when(matched, F.col("_best.words")).otherwise(F.lit("")).alias("reason"),
        severity.alias("severity"),
        touched([deadline]).alias("about_deadline"),
        touched(product).alias("about_product"),
        touched([service]).alias("about_service"),
    )


def parse_replies(replies: DataFrame, column: str) -> DataFrame:
    """Rows of JSON batch replies under the declared contract; a reply that does not parse gives none."""
    parsed = F.from_json(F.col(column), BATCH_REPLY, {"mode": "PERMISSIVE"})
    return replies.select(F.explode(parsed.getField("classifications")).alias("c")).select("c.*")


# Batch function: rows of order_id and text in, JSON text or a list of dicts out.
BatchFunction = Callable[[pd.DataFrame], "str | list[dict]"]


def _checked(reply, valid: frozenset[str] | None) -> pd.DataFrame:
    """Reply rows under the contract, the last one of each order. A row that breaks the contract fails the lot."""
    rows = json.loads(reply)["classifications"] if isinstance(reply, str) else reply
    out = pd.DataFrame(list(rows), columns=FIELDS)
    for name in FIELDS:
        wanted = bool if name.startswith("about_") else str
        if not out[name].map(type).eq(wanted).all():
            raise TypeError(name)
    if valid is not None:
        out = out[out["category"].isin(valid)]
    return out.drop_duplicates("order_id", keep="last")


def _fallback(lot: pd.DataFrame, deadline_words: Sequence[str], product_words: Sequence[str]) -> pd.DataFrame:
    """The rows of ``fallback_rows`` for a lot; a missing text mentions nothing."""
    lowered = lot["text"].fillna("").str.lower()

    def mentioned(words: Sequence[str]) -> pd.Series:
        return reduce(
            lambda a, b: a | b, [lowered.str.contains(w, regex=False) for w in words], pd.Series(False, lot.index)
        )

    return pd.DataFrame(
        {
            "order_id": lot["order_id"],
            "category": UNCLASSIFIED,
            "reason": FALLBACK_REASON,
            "severity": UNDETERMINED,
            "about_deadline": mentioned(deadline_words),
            "about_product": mentioned(product_words),
            "about_service": False,
        }
    )[FIELDS]


def classify_lots(
    reviews: DataFrame,
    batch_function: BatchFunction,
    categories: Sequence[str] | None = None,
    lot_size: int = LOT_SIZE,
    parallelism: int | None = None,
    deadline_words: Sequence[str] = tuple(DEADLINE_WORDS),
    product_words: Sequence[str] = tuple(PRODUCT_WORDS),
) -> DataFrame:
    """Classify reviews lot by lot with a user function, lots in parallel over partitions.

    A lot whose call or reply fails does not fail the task: its rows become fallback rows. So do
    single rows with a category outside ``categories`` and rows the reply left out; rows the reply
    made up are ignored. A task holds one Arrow batch and one lot at a time.
    """
    valid = None if categories is None else frozenset(categories)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pending = None
        for batch in batches:
            pending = batch if pending is None else pd.concat([pending, batch], ignore_index=True)
            full = len(pending) // lot_size * lot_size
            for start in range(0, full, lot_size):
                yield classify(pending.iloc[start : start + lot_size])
            pending = pending.iloc[full:]
        if pending is not None and len(pending):
            yield classify(pending)

    def classify(lot: pd.DataFrame) -> pd.DataFrame:
        lot = lot.reset_index(drop=True)
        spare = _fallback(lot, deadline_words, product_words)
        try:
            answered = _checked(batch_function(lot), valid).set_index("order_id")
        except Exception:  # soft failure: any error of the user function marks the lot, not the job
            return spare
        there = lot["order_id"].isin(answered.index)
        rows = answered.reindex(lot.loc[there, "order_id"]).reset_index()
        return pd.concat([rows, spare[~there]], ignore_index=True)[FIELDS]

    source = reviews.select(F.col("order_id").cast("string").alias("order_id"), F.col(TEXT).alias("text"))
    if parallelism:
        source = source.repartition(parallelism)
    return source.mapInPandas(run, schema=CLASSIFICATION)


def classify_missing(
    reviews: DataFrame, batch_function: BatchFunction, base: str, waves: int = WAVES, **options
) -> DataFrame:
    """``classify_lots`` that keeps its answers: a table below ``base`` holds a row per answered order, and only orders
    without one are sent. One row per order: its answer, or the fallback row until a later run has one.

    Orders are dealt into waves by a hash of their id; each wave's answers are written before the next is sent, so a
    run that stops loses one wave at most. What the result's reader does afterwards calls nothing. A failed lot leaves
    no answer and is sent again by the next run. Of several texts of an order the smallest is sent; a null order_id
    is sent by every run.
    """
    spark, path = reviews.sparkSession, f"{base}/{ANSWERS_TABLE}"
    texts = reviews.groupBy(F.col("order_id").cast("string").alias("order_id")).agg(F.min(TEXT).alias(TEXT))
    spark.createDataFrame([], CLASSIFICATION).write.mode("append").parquet(path)
    failed = (F.col("category") == UNCLASSIFIED) & (F.col("reason") == FALLBACK_REASON)

    def answers() -> DataFrame:
        return spark.read.schema(CLASSIFICATION).parquet(path)

    for wave in range(waves):
        due = texts.where(F.pmod(F.xxhash64("order_id"), F.lit(waves)) == wave)
        due = due.join(answers().select("order_id"), "order_id", "left_anti")
        classify_lots(due, batch_function, **options).where(~failed).write.mode("append").parquet(path)
    # Two runs at a time may both have answered an order.
    known = keep_last(answers(), ["order_id"], [F.col(c).asc() for c in FIELDS if c != "order_id"])
    words = {k: v for k, v in options.items() if k in ("deadline_words", "product_words")}
    rest = fallback_rows(texts.join(known.select("order_id"), "order_id", "left_anti"), **words)
    return known.join(texts.select("order_id"), "order_id", "left_semi").select(*FIELDS).unionByName(rest)


def failure_share(classified: DataFrame) -> DataFrame:
    """Rows, unclassified rows and their percentage."""
    failed = F.count(F.when(F.col("category") == UNCLASSIFIED, 1))
    return classified.agg(F.count(F.lit(1)).alias("total"), failed.alias("unclassified")).withColumn(
        "unclassified_pct", round_half_up(percent("unclassified", "total"), 1)
    )


def valid_rows(classified: DataFrame) -> Column:
    """Predicate for real classifications; tables of older runs mark failures in the reason only."""
    if "is_fallback" in classified.columns:
        return ~F.col("is_fallback")
    return ~F.col("reason").like("%fallback%")


def enriched(classified: DataFrame, run_id: str | None = None, order_by: Sequence[Column] | None = None) -> DataFrame:
    """One row per order, the last one given, with fallback mark, run id and time.

    Rows have no order in Spark: ``order_by`` says which of several is last (latest first);
    without it real classifications win over fallbacks.
    """
    marked = classified.withColumn("is_fallback", F.col("category") == UNCLASSIFIED)
    order = list(order_by or [F.col("is_fallback").asc(), *[F.col(c).asc() for c in FIELDS if c != "order_id"]])
    return (
        keep_last(marked, ["order_id"], order)
        .select(*FIELDS, "is_fallback")
        .withColumn("run_id", F.lit(run_id or uuid.uuid4().hex[:12]))
        .withColumn("classified_at", F.current_timestamp())
    )


def save_enriched(classified: DataFrame, base: str, run_id: str | None = None) -> str:
    """Replace the enriched fact; categories of different runs never mix."""
    return write_table(enriched(classified, run_id), base, ENRICHED_TABLE)


def enrich(
    fact_orders: DataFrame,
    classify: Callable[[DataFrame], DataFrame],
    size: int | None = None,
    seed: int = SAMPLE_SEED,
    run_id: str | None = None,
) -> DataFrame:
    """Eligible reviews (a sample of them if ``size`` says so) through a classifier to the enriched fact."""
    reviews = eligible(fact_orders) if size is None else review_sample(fact_orders, size, seed)
    return enriched(classify(reviews), run_id)


def sample_coverage(sample: DataFrame, fact_orders: DataFrame) -> DataFrame:
    everyone = population(fact_orders).scalar()
    return (
        sample.agg(F.count(F.lit(1)).alias("sampled"))
        .withColumn("population", everyone)
        .withColumn("coverage_pct", round_half_up(percent("sampled", "population"), 1))
    )
