"""Session settings the package expects."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Temporary folders of local sessions, by application; removed when Python ends.
_TEMPORARY: dict[str, str] = {}


def build_session(app_name: str = "stallwise", master: str | None = None, **conf) -> SparkSession:
    """Session with UTC, AQE and AQE skew handling on; ANSI mode stays at Spark's default.

    ``master`` is for tests and benches; on a cluster it comes from spark-submit.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Split skewed joins even where the next step then needs one more shuffle.
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it then gets one temporary folder, removed at the end.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    application = spark.sparkContext.applicationId
    if application not in _TEMPORARY:
        _TEMPORARY[application] = tempfile.mkdtemp(prefix="stallwise-")
        atexit.register(shutil.rmtree, _TEMPORARY[application], ignore_errors=True)
    return _TEMPORARY[application]


def written(df: DataFrame, name: str) -> DataFrame:
    """df as Parquet in the shared folder, read back: computed once, and it outlives lost executors.

    The files go when the application ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
