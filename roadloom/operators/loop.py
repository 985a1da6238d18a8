"""Cutting lineage in loops."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def cut(df: DataFrame) -> DataFrame:
    """df computed into the shared checkpoint folder.

    What the optimizer knows about df's columns isn't carried on: in a loop of joins that
    knowledge doubles with every step.
    """
    spark = df.sparkSession
    shared_dir(spark)
    name = "spark.sql.constraintPropagation.enabled"
    before = spark.conf.get(name, "true")
    spark.conf.set(name, "false")
    try:
        return df.checkpoint(eager=True)
    finally:
        spark.conf.set(name, before)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir.

    Where that isn't set, a temporary folder serves a session on one machine; on a cluster
    it could not, so that is an error.
    """
    sc = spark.sparkContext
    told = spark.conf.get("spark.checkpoint.dir", None)
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        if not told and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(told or tempfile.mkdtemp(prefix="ckpt-"))
    return told or sc._jsc.sc().getCheckpointDir().get()
