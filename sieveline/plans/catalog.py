"""The registry of runnable queries and of the SQL that states each one's rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register a query under ``name``, with the SQL that must give the same rows."""

    def keep(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


FLAGSHIP = "exact_dedup_documents"


@register("agg_count_by_value", "SELECT source, count(*) AS n FROM documents GROUP BY source")
def agg_count_by_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("n"))
