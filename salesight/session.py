"""Session construction and settings (all else takes an existing session)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession

# Splitting hot join keys is allowed even where it costs one more shuffle: the
# de-duplication can re-use a join's partitioning, and without this it would also
# inherit its skew. Joined partitions stay small: sorts and hash maps hold a partition
# uncompressed, ten times its shuffled size and more.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
}

ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
#: Bytes of input files for each shuffle partition that a plan begins with.
INPUT_BYTES = 4 << 20


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session made elsewhere; joined partitions that it has smaller stay so."""
    size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    for key, value in SETTINGS.items():
        if key != ADVISORY or size(spark.conf.get(key)) > size(value):
            spark.conf.set(key, value)
    return spark


def input_bytes(spark: SparkSession, paths: Iterable[str]) -> int:
    """Bytes of the files under these paths."""
    size = 0
    for path in paths:
        there = spark._jvm.org.apache.hadoop.fs.Path(path)
        files = there.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        size += files.getContentSummary(there).getLength()
    return size


def fit_shuffles(spark: SparkSession, paths: Iterable[str]) -> SparkSession:
    """Let plans begin with a shuffle partition for every 4 MB of these files, if that is more
    than ``spark.sql.shuffle.partitions``: so what a task holds does not grow with the input.

    Adaptive execution joins the small partitions again.
    """
    wanted = -(-input_bytes(spark, paths) // INPUT_BYTES)
    if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(INITIAL, str(wanted))
    else:
        spark.conf.unset(INITIAL)
    return spark


def session(
    app: str = "salesight",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **conf: str,
) -> SparkSession:
    """Build or fetch a session with adaptive execution on.

    ``shuffle_partitions`` is only the starting count: AQE coalesces small
    shuffle partitions and splits skewed join partitions at run time. On a
    cluster size it for the largest shuffle, or let ``fit_shuffles`` do it.
    Further settings go in as ``**{"spark.checkpoint.dir": "hdfs:///shared/ckpt"}``.
    """
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC")
    if master is not None:
        builder = builder.master(master)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
