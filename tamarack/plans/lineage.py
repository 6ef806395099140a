"""Cutting lineage so that a lost executor never costs an iterative job its past rounds."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder that spark.checkpoint.dir names; set one only where none is set (tests, local runs)."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        context.setCheckpointDir(named)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tamarack-checkpoint-"))
    else:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


def cut(df: DataFrame) -> DataFrame:
    """Write df to the shared checkpoint folder and continue from the written copy."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def forget(df: DataFrame) -> None:
    """Delete the written copy behind a frame that ``cut`` returned and nothing reads any more."""
    plan = df._jdf.queryExecution().logical()
    file = plan.rdd().getCheckpointFile() if hasattr(plan, "rdd") else None
    if file is not None and file.isDefined():
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(file.get())
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def cut_clean(df: DataFrame) -> DataFrame:
    """Like ``cut``, and delete the shuffle files that led to the written copy, which else stay as long as the driver holds the plan."""
    out = cut(df)
    plan, cleaner = df._jdf.queryExecution().executedPlan(), df.sparkSession._jsc.sc().cleaner()
    if hasattr(plan, "context") and cleaner.isDefined():
        for shuffle in plan.context().shuffleIds().keySet().toArray():
            cleaner.get().doCleanupShuffle(shuffle, True)
    return out
