"""Session settings that the pipelines expect, and lineage cutting.

On a cluster the session comes from outside; `tune` only fills in settings the
caller left open.  Nothing here fixes a partition count: AQE sizes the shuffle
partitions from the real bytes, splits skewed ones, and turns a sort-merge join
into a broadcast join only when the measured side is below the threshold.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # a side is broadcast only when its measured size is below this
    "spark.sql.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # the federal files are windows-1252, which needs the JVM's own charsets
    "spark.sql.legacy.javaCharsets": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Sets what the session and its context leave open."""
    context = spark.sparkContext.getConf()
    for key, value in RUNTIME_SETTINGS.items():
        if not context.contains(key) and spark.conf.get(key, None) in (None, _default(spark, key)):
            spark.conf.set(key, value)
    return spark


def _default(spark: SparkSession, key: str) -> str | None:
    """The value of a setting in a session that nobody has changed."""
    return spark.newSession().conf.get(key, None)


def local_session(cores: int | str = "*", app: str = "contraluz",
                  memory: str = "8g", **settings: str) -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.driver.memory", memory)
               .config("spark.ui.enabled", "false")
               .config("spark.sql.shuffle.partitions", "8"))
    for key, value in {**RUNTIME_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    A fallback folder is made only where the session names none, which is the
    case in local tests.
    """
    context = spark.sparkContext
    named = (spark.conf.get("spark.checkpoint.dir", None)
             or context.getConf().get("spark.checkpoint.dir", None))
    if named:
        return named
    if context.getCheckpointDir():
        return context.getCheckpointDir()
    if not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder")
    return tempfile.mkdtemp(prefix="contraluz-checkpoint-")


def stored(df: DataFrame) -> DataFrame:
    """The rows as a Parquet table in the shared folder, read back.

    For an intermediate that several branches of a job read: it is computed
    once, later scans prune its columns, and it outlives any executor.
    """
    path = f"{checkpoint_folder(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def few(df: DataFrame, most: int = 1_000_000) -> DataFrame:
    """The rows, marked for broadcast if they are counted to be few.

    For lists and stored tables of a few narrow columns: the size that Spark estimates
    for them may be above the threshold, and then the facts beside them would move at
    every join.  Beyond `most` rows the join is left to Spark.
    """
    return F.broadcast(df) if df.count() <= most else df


@contextmanager
def dealt_by_less(spark: SparkSession) -> Iterator[None]:
    """Actions inside join rows where they lie, if both sides are dealt by some of the keys."""
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def spread(df: DataFrame) -> DataFrame:
    """Rows spread over all cores where a scan has fewer splits than cores.

    A large table has more splits than the cluster has cores and is returned
    as it is, without a shuffle; only a compact file is dealt out.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
