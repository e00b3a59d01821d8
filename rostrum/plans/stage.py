"""Written intermediate tables in the shared checkpoint folder.

Staging a small dimension gives the optimizer its true size, so a broadcast is planned only when
the files are below ``spark.sql.autoBroadcastJoinThreshold``; above it the join shuffles. It also
cuts lineage in a way that survives the loss of executors.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def work_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a folder of our own only where none is set and Spark is local."""
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="rostrum-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path


def _root(spark: SparkSession) -> str:
    return f"{work_dir(spark).rstrip('/')}/staged-{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{_root(spark)}/{name}-{uuid.uuid4().hex}"


def drop_staged(spark: SparkSession) -> None:
    """Remove this application's staged tables, once its results are written elsewhere."""
    remove(spark, _root(spark))


def remove(spark: SparkSession, path: str) -> None:
    """Remove one written table that nothing reads any more."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` as a written table, and its path for :func:`remove`."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def stage(df: DataFrame, name: str) -> DataFrame:
    return written(df, name)[0]


def drop_shuffles(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of steps whose results are written.

    Its cleaner removes them when the driver's garbage is collected, which by itself may not happen before the end.
    """
    spark.sparkContext._jvm.System.gc()


def spread(df: DataFrame, key: str, write: bool = False) -> DataFrame:
    """Hash rows over the cores when the scan has fewer splits than cores; larger inputs pass through.

    ``write=True`` writes such a small input out once, for plans that scan it several times.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    even = df.repartition(cores, key)
    return stage(even, "spread") if write else even


def by_key(df: DataFrame, key: str) -> DataFrame:
    """Place rows by ``key`` in the session's full number of shuffle partitions.

    For iterative work that computes much per byte: adaptive coalescing would leave small tables in
    one or two partitions.
    """
    spark = df.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return df.repartition(n, key)
