"""Deterministic samples: hash-ordered, so the same rows on every run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesmill.operators.selection import take_hashed
from seriesmill.operators.slices import number_rows
from seriesmill.spec import SeriesSpec, ordered


def stratified_sample(df: DataFrame, label: str, key: Sequence[str], max_rows: int, seed: int = 42) -> DataFrame:
    """About ``max_rows`` rows in the proportions of the classes, at least one of each."""
    total = df.count()
    if total <= max_rows:
        return df
    rate = max_rows / total
    return take_hashed(df, [label], key, seed, F.greatest(F.lit(1), F.bround(F.col("n") * F.lit(rate))))


def equal_sample(df: DataFrame, label: str, key: Sequence[str], per_class: int, seed: int = 42) -> DataFrame:
    return take_hashed(df, [label], key, seed, F.lit(per_class))


def sample_cap(df: DataFrame, key: Sequence[str], rows: int, seed: int = 42) -> DataFrame:
    return take_hashed(df, [], key, seed, F.lit(rows))


def downsample(df: DataFrame, spec: SeriesSpec, target: int = 30_000) -> DataFrame:
    """Every k-th row of an entity in time order, k = rows // target + 1."""
    numbered = number_rows(df, [spec.entity], spec.order, spec.max_rows_per_task)
    step = F.floor(F.col("key_rows") / F.lit(target)) + 1
    return numbered.where((F.col("row_no") - 1) % step == 0).drop("row_no", "key_rows")


def head_per_class(df: DataFrame, spec: SeriesSpec, rows: int) -> DataFrame:
    """First rows of each class in entity and time order; the rank filter also runs before the shuffle."""
    w = Window.partitionBy(spec.label).orderBy(*ordered(spec.entity, spec.ts, *spec.tiebreak))
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= rows).drop("_rank")
