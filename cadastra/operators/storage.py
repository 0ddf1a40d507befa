"""Cutting lineage between the steps of a chain."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

from cadastra.session import guarded


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; where it is unset, one of this machine, which only a local master may use."""
    context = guarded(spark).sparkContext  # what is kept here is planned later
    if not context._jsc.sc().getCheckpointDir().isDefined():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not context.master.startswith("local[") and context.master != "local":
            raise ValueError("spark.checkpoint.dir names no folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="cadastra-"))
    return context._jsc.sc().getCheckpointDir().get()


def kept(frame: DataFrame) -> DataFrame:
    """``frame`` computed once, in the shared folder."""
    shared_folder(frame.sparkSession)
    return frame.checkpoint()
