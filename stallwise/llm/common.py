"""What the operators share: tables, written intermediate tables, connected components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stallwise.session import shared_dir

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def parts_of(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in parts of so many rows: what a task makes of long texts at a time stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like the given ones that no column of df has, whatever the case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def saved(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet to the shared folder and read back: computed once, and no lost executor
    takes it along. The files go when the application ends, or with ``dropped``."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    files, where = _file_system(spark, path)
    files.deleteOnExit(where)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stallwise_path = path
    return out


def dropped(df: DataFrame) -> None:
    """Delete the files of a ``saved`` table that nothing reads any more."""
    files, where = _file_system(df.sparkSession, df._stallwise_path)
    files.delete(where, True)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the undirected edges (a, b); component is the smallest node reachable.

    Large-star and small-star steps by turns: each reduces to a minimum per node (combined before the
    shuffle) and a join, which AQE splits where a node has very many links. Every round is written out.
    """
    a, b = F.col("a"), F.col("b")
    links = edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).where("hi <> lo").distinct()
    links = saved(links, "links")
    before = None
    while True:
        state = links.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("hi", "lo")).alias("x")).first()
        if state == before or not state.n:
            return links.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(
                links.select("lo", "lo").distinct()
            )
        before = state
        ends = links.union(links.select("lo", "hi")).toDF("u", "v")
        lows = ends.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = ends.where("v > u").join(lows, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        rest = large.join(least, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        done = links
        links = saved(rest.union(least).distinct(), "links")
        dropped(done)
