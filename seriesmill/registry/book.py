"""Registration of queries and helpers for comparable output."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesmill.functions.columns import rounded

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def tidy(df: DataFrame, coarse: Sequence[str] = ()) -> DataFrame:
    """Doubles rounded to six places, ``coarse`` ones to four: sums in another order compare equal."""
    return df.select(
        *[
            rounded(F.col(c), 4 if c in coarse else 6).alias(c) if t == "double" else F.col(c)
            for c, t in df.dtypes
        ]
    )


def r6(expression: str, alias: str) -> str:
    return f"(round({expression}, 6) + 0.0) AS {alias}"
