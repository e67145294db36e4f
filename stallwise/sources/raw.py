"""Raw CSV files to typed frames, with type failures kept per row."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stallwise.functions.numeric import no_nan
from stallwise.sources.schemas import MULTI_LINE, OPTIONAL_ENTITIES, RAW_COLUMNS

# array<struct<column, text>>: values that did not parse as their declared type.
BAD_VALUES = "bad_values"
# struct<file, block, row>: place of the row in its file; orders keep-first uniqueness.
POSITION = "ingest_position"


class MissingSource(FileNotFoundError):
    """A required raw file is absent."""


def read_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Text columns of a CSV with header; doubled quotes and, if asked, quoted line breaks.

    Files with quoted line breaks cannot be split, so only entities that have them ask for it.
    """
    return (
        spark.read.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .csv(path)
    )


def apply_types(raw: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Cast the declared columns; text that does not parse becomes NULL and lands in BAD_VALUES."""
    typed, bad = [], []
    for name in raw.columns:
        kind = columns.get(name, "string")
        if kind == "string":
            typed.append(F.col(name))
            continue
        value = F.col(name).try_cast(kind)
        bad.append(
            F.when(
                F.col(name).isNotNull() & value.isNull(),
                F.struct(F.lit(name).alias("column"), F.col(name).alias("text")),
            )
        )
        typed.append((no_nan(value) if kind == "double" else value).alias(name))
    nothing = F.array().cast("array<struct<column:string,text:string>>")
    return raw.select(*typed, (F.array_compact(F.array(*bad)) if bad else nothing).alias(BAD_VALUES))


def read_entity(spark: SparkSession, path: str, entity: str) -> DataFrame:
    """Typed entity with BAD_VALUES and POSITION."""
    columns = RAW_COLUMNS[entity]
    raw = read_csv(spark, path, entity in MULTI_LINE)
    missing = [c for c in columns if c not in raw.columns]
    if missing:
        raise ValueError(f"{path}: missing columns {missing}")
    position = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return apply_types(raw.withColumn(POSITION, position), columns)


def load_raw(
    spark: SparkSession, raw_dir: str, files: dict[str, str] | None = None
) -> dict[str, DataFrame]:
    """All entities of a raw folder; a missing required file stops the run, an optional one is skipped."""
    names = {entity: f"{entity}.csv" for entity in RAW_COLUMNS} | (files or {})
    frames = {}
    for entity, name in names.items():
        path = f"{raw_dir.rstrip('/')}/{name}"
        try:
            frames[entity] = read_entity(spark, path, entity)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            if entity not in OPTIONAL_ENTITIES:
                raise MissingSource(f"raw file for '{entity}' not found: {path}") from error
    return frames
