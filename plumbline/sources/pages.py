"""Page tables from files, batch or stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

PAGE_SCHEMA = "page_id bigint, url string, html string"


def read_pages(spark: SparkSession, path, fmt: str = "parquet") -> DataFrame:
    """Pages from Parquet or JSON files with a fixed schema (no inference pass)."""
    return spark.read.schema(PAGE_SCHEMA).format(fmt).load(path)


def stream_pages(spark: SparkSession, path: str, fmt: str = "parquet", files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(PAGE_SCHEMA).format(fmt)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)
