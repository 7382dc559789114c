"""Registry of runnable queries and, where SQL can say the same, their oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from plumbline.session import use_local_shared_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
SURVEY_IDS: dict[str, str] = {}


def query(survey_id: str, sql: str | None = None, name: str | None = None):
    """Register ``fn(read)`` where ``read(table)`` loads one given table."""

    def wrap(fn):
        key = name or fn.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            use_local_shared_dir(spark)

            def read(table: str) -> DataFrame:
                return spark.read.parquet(f"{sf_dir}/{table}.parquet")

            read.spark = spark
            read.path = lambda table: f"{sf_dir}/{table}.parquet"
            return fn(read)

        run.__name__ = key
        run.__doc__ = fn.__doc__
        QUERIES[key] = run
        SURVEY_IDS[key] = survey_id
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return wrap
