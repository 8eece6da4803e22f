"""Exact interpolated percentiles that do not hold a group's values in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill.operators.selection import FEW_ROWS, IMAGE_DIGITS, image, image_digit, rows_at
from seriesmill.operators.slices import attach
from seriesmill.session import materialise


def long_form(df: DataFrame, keep: Sequence[str], sensors: Sequence[str]) -> DataFrame:
    """One row per kept columns and sensor: ``sensor``, ``value``."""
    return df.select(*keep, *sensors).unpivot(list(keep), list(sensors), "sensor", "value")


def exact_quantiles(df: DataFrame, groups: Sequence[str], probs: dict[str, float], value: str = "value", few: int = FEW_ROWS) -> DataFrame:
    """Percentiles of ``value`` per group, one column per entry of ``probs``, linear between the two ranks next to them."""
    points = quantile_points(df, groups, list(probs.values()), value, few)
    return points.select(*groups, *[F.col("points")[i].alias(n) for i, n in enumerate(probs)])


def quantile_points(df: DataFrame, groups: Sequence[str], probs: Sequence[float], value: str = "value", few: int = FEW_ROWS) -> DataFrame:
    """Per group the percentiles ``points`` in the order of ``probs``.

    The values at the ranks are found digit by digit; a group with at most ``few`` rows is counted by value at once.  Nulls do not count.
    """
    by = list(groups) or ["_all"]
    present = df.where(F.col(value).isNotNull()).select(*(groups or [F.lit(0).alias("_all")]), F.col(value).cast("double").alias("_v"))
    totals = materialise(present.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")), "totals")
    parts = F.array(*[F.lit(float(p)) for p in probs])
    places = F.transform(parts, lambda p: p * (F.col("_n") - 1))
    ranks = F.array_distinct(F.flatten(F.transform(places, lambda x: F.array(F.floor(x), F.ceil(x)))))
    wanted = totals.select(*by, F.explode(ranks).alias("_rank"), F.col("_n").alias("_rows")).withColumn("_rest", F.col("_rank"))
    found = rows_at(present.withColumn("_image", image(F.col("_v"))), by, wanted, "_v", image_digit("_image"), IMAGE_DIGITS, few)
    held = found.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_key"))).alias("_values"))
    at = lambda rank: F.element_at("_values", rank)
    point = lambda x: at(F.floor(x)) + (at(F.ceil(x)) - at(F.floor(x))) * (x - F.floor(x))
    return attach(held, totals, by).select(*groups, F.transform(places, point).alias("points"))
