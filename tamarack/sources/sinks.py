"""Writers: snapshots, appends that skip what is there, sheets and logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tamarack.schemas import CORPUS, LABELLING_SHEET


def write_snapshot(df: DataFrame, path: str) -> None:
    """A new version of a table as Parquet; never the path that the plan reads."""
    if any(path.rstrip("/") in f for f in df.inputFiles()):
        raise ValueError("a snapshot cannot overwrite what it is made from")
    df.write.mode("overwrite").parquet(path)


def append_json(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path, ignoreNullFields=False)


def append_new(df: DataFrame, path: str, key: str) -> DataFrame:
    """Append the rows whose key is not yet in the table at ``path``; repeated keys of the batch are written once. Returns what was written."""
    spark: SparkSession = df.sparkSession
    fresh = df.dropDuplicates([key])
    try:
        fresh = fresh.join(spark.read.parquet(path).select(key), key, "left_anti")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
    fresh.write.mode("append").parquet(path)
    return fresh


def new_documents(found: DataFrame, manifest: DataFrame) -> DataFrame:
    """Found documents whose id and address are both unknown, each id and each address once; rows without an address are known by their id."""
    unseen = found.join(manifest.select("doc_id"), "doc_id", "left_anti").join(manifest.select("source_url"), "source_url", "left_anti")
    rest = [c for c in found.columns if c not in ("doc_id", "source_url")]
    # the smallest of the rows of an id, then the smallest id of an address, so every run keeps the same ones
    once = unseen.groupBy("doc_id").agg(F.min(F.struct("source_url", *rest)).alias("_r")).select("doc_id", "_r.*")
    addressed = once.filter("source_url is not null").groupBy("source_url").agg(F.min(F.struct("doc_id", *rest)).alias("_r")).select("source_url", "_r.*")
    return addressed.unionByName(once.filter("source_url is null")).select(*found.columns)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header, quotes doubled, null as nothing."""
    df.write.mode("overwrite").csv(path, header=True, quote='"', escape='"', emptyValue="", nullValue="")


def write_corpus(df: DataFrame, path: str) -> None:
    """The corpus by doc_id, its columns in order, helper columns left out."""
    write_csv(df.select(*[F.coalesce(F.col(f.name), F.lit("")).alias(f.name) if f.name in df.columns else F.lit("").alias(f.name) for f in CORPUS]).orderBy("doc_id"), path)


def write_chunks(df: DataFrame, path: str, rebuild: bool = False) -> None:
    """Chunks as JSON lines; without ``rebuild`` those of documents already there are skipped."""
    if not rebuild:
        try:
            df = df.join(df.sparkSession.read.json(path).select("doc_id").distinct(), "doc_id", "left_anti").select(*df.columns)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
    df.write.mode("overwrite" if rebuild else "append").json(path)


def write_splits(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").partitionBy("split").option("header", True).csv(path)


def labelling_sheet(sample: DataFrame) -> DataFrame:
    """Rows to label by hand: the weak label is withheld, the label columns are blank."""
    return sample.select(*[F.col(f.name) if f.name in ("doc_id", "org", "card_text") else F.lit("").alias(f.name) for f in LABELLING_SHEET])
