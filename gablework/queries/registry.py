"""Named queries over the given tables, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gablework.shared import col

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; without ``sql`` it has no SQL counterpart and is tested by its properties."""

    def keep(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} exists")
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def neat(df: DataFrame, digits: int = 6, **special: int) -> DataFrame:
    """Doubles rounded, so that two engines' last bits do not matter. Adding zero turns -0.0 into 0.0."""

    def shown(f: T.StructField):
        if isinstance(f.dataType, T.DoubleType):
            return (F.round(col(f.name), special.get(f.name, digits)) + F.lit(0.0)).alias(f.name)
        return col(f.name)

    return df.select(*[shown(f) for f in df.schema])


def r(expr: str, digits: int = 6) -> str:
    """The SQL side of ``neat``."""
    return f"(round({expr}, {digits}) + 0.0)"
