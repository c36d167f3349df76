"""Cuts of the lineage for loops over DataFrames."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def durable(df: DataFrame) -> DataFrame:
    """Writes df to the folder the cluster names in spark.checkpoint.dir and goes on from there; only where none is set, as in tests, to a temporary one."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="spark-ckpt-"))
    return df.checkpoint(eager=True)
