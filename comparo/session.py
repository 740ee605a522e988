"""Session construction and the shared work folder.

On a cluster the work folder is the one the cluster names in
``spark.checkpoint.dir`` (a shared filesystem such as HDFS or an object
store). A folder is only invented here when that setting is unset, which is
the case in local tests.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "comparo") -> SparkSession:
    """Session for local runs and tests. On a cluster, use the cluster's session: shuffle partitions then come
    from its configuration and AQE coalesces or splits them at run time."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if shuffle_partitions is None and master and master.startswith("local"):
        shuffle_partitions = 8
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = (
        builder.config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("COMPARO_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder. A scratch folder is made only if none is set, and only for a local master: on a
    cluster a folder of one machine would not be seen by the others."""
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all machines share (master {master})")
        conf = tempfile.mkdtemp(prefix="comparo-ckpt-", dir=os.environ.get("COMPARO_SCRATCH", "/tmp"))
    spark.sparkContext.setCheckpointDir(conf)
    return spark.sparkContext.getCheckpointDir() or conf


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Settings that hold for the jobs inside."""
    before = {name: spark.conf.get(name, None) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _tables(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{spark.sparkContext.applicationId}"


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written table, under the shared checkpoint folder."""
    return f"{_tables(spark)}/kept/{name}-{uuid.uuid4().hex[:12]}"


def drop_tables(spark: SparkSession) -> None:
    """Delete the intermediate tables that :func:`materialize` has written in this application. Call it when no result
    that reads them is needed any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{_tables(spark)}/stages")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, name: str = "stage", **options) -> DataFrame:
    """Cut lineage by writing ``df`` as parquet to the shared folder and reading it back.

    A written table survives the loss of executors (unlike cached or locally
    checkpointed blocks) and lets later stages re-read it by name. ``options`` go to the writer.
    """
    spark = df.sparkSession
    path = f"{_tables(spark)}/stages/{name}-{uuid.uuid4().hex[:12]}"
    df.write.mode("overwrite").options(**options).parquet(path)
    return spark.read.parquet(path)
