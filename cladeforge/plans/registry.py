"""Named queries over the driver's tables, each beside the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The tables of one folder, and shapes made of them by SQL in which {name} stands for a table."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def __call__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def sql(self, text: str, **more: DataFrame) -> DataFrame:
        used = {t: self(t) for t in TABLES if f"{{{t}}}" in text}
        return self.spark.sql(text, **used, **more)


def query(name: str, sql: str | None = None) -> Callable:
    def register(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            plain = sql
            for t in TABLES:
                plain = plain.replace(f"{{{t}}}", t)
            ORACLES[name] = plain
        return f

    return register
