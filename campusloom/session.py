"""Session settings and durable cut points."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", partitions: int = 8) -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("campusloom")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    In local mode, where driver and tasks share one disk, a temporary one is used if
    none is set.  Elsewhere a machine's own folder would lose rows, so that is an error.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = sc.getConf().get("spark.checkpoint.dir")
        if not folder and (not sc.master.startswith("local") or sc.master.startswith("local-cluster")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="campusloom-"))
    return sc.getCheckpointDir()


def work_folder(spark: SparkSession) -> str:
    """A new folder in the checkpoint folder, reachable from every executor."""
    return f"{checkpoint_folder(spark)}/work-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """Write the rows as a table in the checkpoint folder and read them back.

    Cuts the lineage and survives the loss of executors.  Unlike a checkpointed
    plan the table is columnar and has a known size, so that later reads are
    pruned and a small one can be broadcast.
    """
    spark, folder = df.sparkSession, work_folder(df.sparkSession)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def spread(scan: DataFrame) -> DataFrame:
    """Spread a scan over all cores when it has fewer splits than cores.

    For costly work per row on a small input of one file; an input with enough
    splits is returned as it is, without a shuffle.  Give it a plain scan.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan
