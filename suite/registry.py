"""Registration of queries and access to the input tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
          "pages", "benchmark", "labels", "conversations"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The parquet tables below one folder, read when asked for."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.root}/{name}.parquet")

    def sql(self, template: str) -> DataFrame:
        """Run a statement that names tables as ``{orders}``."""
        used = {n: getattr(self, n) for n in TABLES if "{" + n + "}" in template}
        return self.spark.sql(template, **used)


def plain(template: str) -> str:
    """The same statement with bare table names."""
    for n in TABLES:
        template = template.replace("{" + n + "}", n)
    return template


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name``; ``sql`` gives the same rows on the same tables."""

    def register(fn: Callable[[Tables], DataFrame]):
        assert name not in QUERIES, name
        QUERIES[name] = lambda spark, root: fn(Tables(spark, root))
        if sql is not None:
            ORACLES[name] = plain(sql)
        return fn

    return register
