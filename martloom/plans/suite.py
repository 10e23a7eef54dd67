"""The registered queries: a Spark builder per key, and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.session import shared_dir, tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The driver's tables as attributes: ``t.orders``, ``t.lineitem``, ..."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        # Called for names not set yet: each table's footers are read once per query.
        df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        setattr(self, name, df)
        return df

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def scratch(self) -> str:
        return shared_dir(self.spark)


def plain(df: DataFrame) -> DataFrame:
    """Decimal columns as DOUBLE, the form the SQL side returns."""
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def query(key: str, sql: str | None = None):
    """Register a builder ``Tables -> DataFrame`` and its SQL."""

    def add(build: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(build(Tables(tune(spark), sf_dir)))

        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = sql
        return build

    return add
