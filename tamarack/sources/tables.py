"""Reading the Parquet tables of a data directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, directory: str, name: str, *columns: str) -> DataFrame:
    """The table ``name`` of ``directory``; with ``columns``, only those reach the scan."""
    df = spark.read.parquet(f"{directory}/{name}.parquet")
    return df.select(*columns) if columns else df


def text_table(spark: SparkSession, directory: str, name: str, *columns: str) -> DataFrame:
    """Like ``table``, for costly work per row: a file too small to be split is dealt out to all cores.

    Tables that already come in enough parts, as all large ones do, are left as they are.
    """
    df = table(spark, directory, name, *columns)
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if 2 * df.rdd.getNumPartitions() <= cores else df
