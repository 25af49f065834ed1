"""Intermediate tables in the cluster's shared folder.

A table written here cuts lineage and survives the loss of an executor. The
folder is the one the session names in ``spark.checkpoint.dir``; in local mode,
where it may be unset, one beside the session's warehouse.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_KEY = "spark.checkpoint.dir"


def scratch_root(spark: SparkSession) -> str:
    root = spark.conf.get(_KEY, None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not spark.conf.get("spark.master").startswith("local"):
        raise RuntimeError(f"set {_KEY} to a folder all executors can reach")
    warehouse = spark.conf.get("spark.sql.warehouse.dir", None) or "spark-warehouse"
    return f"{warehouse.rstrip('/')}/_scratch"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path, never one used before, under a folder named after the application
    so that what a finished application left can be dropped in one go."""
    app = spark.sparkContext.applicationId
    return f"{scratch_root(spark).rstrip('/')}/tallyloom/{app}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a table under the scratch folder that no later step reads."""
    if "/tallyloom/" not in path:
        raise ValueError(f"{path} is not a scratch table")
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def drop_scratch(spark: SparkSession) -> None:
    """Delete all that this application has written to the scratch folder."""
    app = spark.sparkContext.applicationId
    drop_path(spark, f"{scratch_root(spark).rstrip('/')}/tallyloom/{app}")
