"""Session building and lineage cutting."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "ohmstead", cores: int | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster the submitter's settings win."""
    n = cores or os.cpu_count() or 4
    return (
        SparkSession.builder.master(f"local[{n}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.files.maxPartitionBytes", "16m")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; a cluster must name a
    shared one, since executors may be lost.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None:
            if not sc.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir must name a shared folder")
            named = tempfile.mkdtemp(prefix="ohmstead-checkpoint-")
        sc.setCheckpointDir(named)
    return df.checkpoint(eager=True)


def wide_side(df: DataFrame) -> DataFrame:
    """A side of a join that is never sent whole to the driver.

    Spark takes a table to be as large as what it is exploded from, and so may broadcast millions of cells
    that come from a small table. With this hint both sides are shuffled.
    """
    return df.hint("merge")
