"""Readers of manifests, sheets, text folders and raw files."""

from __future__ import annotations

from pathlib import Path

import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from tamarack.functions.text import strip
from tamarack.operators.latest import latest
from tamarack.schemas import MANIFEST


def _or_empty(spark: SparkSession, schema: T.StructType, load) -> DataFrame:
    try:
        return load()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], schema)
        raise


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines under a fixed schema; blank lines are skipped, a missing path is an empty table."""
    return _or_empty(spark, schema, lambda: spark.read.schema(schema).json(path))


def read_manifest(spark: SparkSession, path: str, order_col: str | None = None) -> DataFrame:
    """The manifest, one row per doc_id: the line with the greatest ``order_col``, or else the last line of the last file."""
    schema = MANIFEST if order_col is None else T.StructType([*MANIFEST.fields, T.StructField(order_col, T.LongType())])
    rows = _or_empty(spark, schema, lambda: spark.read.schema(schema).json(path))
    if order_col is not None:
        return latest(rows, "doc_id", order_col)
    # the file and the place in it, as the scan numbers them
    placed = rows.withColumn("_place", F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()))
    return latest(placed, "doc_id", "_place").drop("_place")


def read_csv(spark: SparkSession, path: str, schema: T.StructType, stripped: bool = False) -> DataFrame:
    """A quoted CSV with a header, all under a fixed schema, empty fields as null; a missing file is an empty table."""
    rows = _or_empty(spark, schema, lambda: spark.read.schema(schema).csv(path, header=True, multiLine=True, quote='"', escape='"', enforceSchema=False))
    return rows.select(*[strip(F.col(f.name)).alias(f.name) if stripped and isinstance(f.dataType, T.StringType) else F.col(f.name) for f in schema]) if stripped else rows


def read_lookup(spark: SparkSession, path: str, schema: T.StructType, key: str) -> DataFrame:
    """A lookup table: values stripped, one row per key, the last row of the file for a repeated one."""
    rows = read_csv(spark, path, schema, stripped=True).filter(F.length(key) > 0).withColumn("_place", F.monotonically_increasing_id())
    return latest(rows, key, "_place").drop("_place")


def read_ids(spark: SparkSession, path: str, schema: T.StructType, col: str = "doc_id") -> DataFrame:
    return read_csv(spark, path, schema, stripped=True).select(col).filter(F.length(col) > 0).distinct()


def read_rules(path: str) -> dict:
    """Topic rules of a YAML file: small, read by the driver."""
    return yaml.safe_load(Path(path).read_text(encoding="utf-8"))


def read_texts(spark: SparkSession, folder: str, suffix: str = ".txt") -> DataFrame:
    """One row (doc_id, text) per text file; the id is the file's name."""
    schema = T.StructType([T.StructField("doc_id", T.StringType()), T.StructField("text", T.StringType())])
    name = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(?:\.[^.]*)?$", 1)
    return _or_empty(spark, schema, lambda: spark.read.text(folder, wholetext=True, pathGlobFilter=f"*{suffix}").select(name.alias("doc_id"), F.col("value").alias("text")))


def read_raw(spark: SparkSession, folder: str, contents: bool = False) -> DataFrame:
    """(doc_id, file_type, n_bytes) of raw files, with their contents only if asked: otherwise no file is opened."""
    files = spark.read.format("binaryFile").load(folder)
    name = F.element_at(F.split("path", "/"), -1)
    out = files.select(F.regexp_extract(name, r"^(.*?)\.[^.]*$", 1).alias("doc_id"), F.lower(F.regexp_extract(name, r"\.([^.]*)$", 1)).alias("file_type"), F.col("length").alias("n_bytes"), *(["content"] if contents else []))
    return out


def file_totals(files: DataFrame) -> DataFrame:
    """Number and bytes of files by type, and of all."""
    return files.rollup("file_type").agg(F.count("*").alias("n_files"), F.sum("n_bytes").alias("n_bytes"))


def pdf_text(blocks: DataFrame) -> DataFrame:
    """(doc_id, text, needs_ocr) from the text blocks of PDF pages.

    Blocks are read top to bottom and left to right, pages are joined by markers. Two and more pages
    with under 200 characters together have no text and need OCR.
    """
    text = blocks.filter("block_type = 0").withColumn("t", strip(F.col("text"))).filter(F.length("t") > 0)
    pages = text.groupBy("doc_id", "page").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("y0", "x0", "t"))), lambda b: b["t"]), "\n").alias("t"))
    every = blocks.groupBy("doc_id").agg(F.max("page").alias("n_pages"))
    whole = pages.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("page", "t"))).alias("ps"), F.sum(F.length("t")).alias("n_chars"))
    marked = F.array_join(F.transform("ps", lambda p: F.when(p["page"] > 1, F.concat(F.lit("[[page "), p["page"].cast("string"), F.lit("]]\n"), p["t"])).otherwise(p["t"])), "\n")
    ocr = (F.col("n_pages") > 1) & (F.coalesce("n_chars", F.lit(0)) < 200)
    return every.join(whole, "doc_id", "left").select("doc_id", F.when(~ocr, F.coalesce(marked, F.lit(""))).alias("text"), ocr.alias("needs_ocr"))
