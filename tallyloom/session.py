"""Session settings shared by the jobs, the bench and the tests."""

from __future__ import annotations

from pyspark.sql import SparkSession

# AQE and its skew-join rule are on by default in Spark 4; they are named here
# because several plans rely on them to split a hot key.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.ui.enabled": "false",
}


# What Spark sets spark.sql.shuffle.partitions to when nobody does.
_SHUFFLE_KEY, _SHUFFLE_DEFAULT = "spark.sql.shuffle.partitions", "200"
# Remembers the number this module has set.
_OWN_KEY = "tallyloom.shuffle.partitions"


# Bytes of a shuffle partition aimed at, and rows in memory to bytes of a file.
PARTITION_BYTES, EXPANSION = 128 << 20, 3


def shuffle_partitions(cores: int, size: int = 0) -> int:
    """A number to start shuffles with on a cluster, for ``size`` bytes of input; AQE
    coalesces partitions that are too small, but splits only skewed ones."""
    return max(2_000, 4 * cores, -(-size * EXPANSION // PARTITION_BYTES))


def sized_for(spark: SparkSession, root: str) -> None:
    """Raise the session's shuffle partitions to what the tables under ``root`` need,
    unless it runs locally or the number was set by someone else."""
    if spark.sparkContext.master.startswith("local"):
        return
    now = spark.conf.get(_SHUFFLE_KEY)
    if now not in (_SHUFFLE_DEFAULT, spark.conf.get(_OWN_KEY, None)):
        return
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    size = files.getContentSummary(path).getLength()
    needed = str(shuffle_partitions(spark.sparkContext.defaultParallelism, size))
    spark.conf.set(_SHUFFLE_KEY, needed)
    spark.conf.set(_OWN_KEY, needed)


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """Start or reuse a session. Leave ``master`` unset under spark-submit.

    On a cluster the number of shuffle partitions is raised unless it was set:
    too many are coalesced, too few would not fit in memory.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    on_cluster = not spark.sparkContext.master.startswith("local")
    if on_cluster and spark.conf.get(_SHUFFLE_KEY) == _SHUFFLE_DEFAULT:
        cores = spark.sparkContext.defaultParallelism
        spark.conf.set(_SHUFFLE_KEY, str(shuffle_partitions(cores)))
        spark.conf.set(_OWN_KEY, spark.conf.get(_SHUFFLE_KEY))
    return spark
