"""Fitting and applying feature scalers."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesmill.operators.quantiles import exact_quantiles, long_form

STATS_SCHEMA = T.StructType(
    [
        T.StructField("feature", T.StringType()),
        T.StructField("mean", T.DoubleType()),
        T.StructField("std", T.DoubleType()),
    ]
)
EPSILON = 1e-8


_MOMENTS = "feature string, n double, mean double, m2 double"


def _moments(names: Sequence[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per feature the values of a task, their mean and squared distances from it; nothing where the task has no row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mean, m2 = (np.zeros(len(names)) for _ in range(3))
        seen = False
        with np.errstate(all="ignore"):
            for batch in batches:
                seen = seen or batch.num_rows > 0
                for i, column in enumerate(batch.columns):
                    x = column.drop_null().to_numpy()
                    if not len(x):
                        continue
                    there = x.mean()
                    gap, size = there - mean[i], n[i] + len(x)
                    m2[i] += np.square(x - there).sum() + gap * gap * n[i] * len(x) / size
                    mean[i] += gap * len(x) / size
                    n[i] = size
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(n), pa.array(mean), pa.array(m2)], names=["feature", "n", "mean", "m2"])

    return run


def fit_scaler(df: DataFrame, names: Sequence[str], ddof: int = 0, round_to: int = 8) -> DataFrame:
    """Mean and standard deviation per feature; a zero deviation becomes one.

    Every task sums up its rows, feature by feature; a shuffle of one row per task and feature puts the sums together.
    """
    names = list(names)
    doubles = df.select(*[F.col(n).cast("double").alias(n) for n in names])
    every = Window.partitionBy("feature")
    size = F.sum("n").over(every)
    parts = doubles.mapInArrow(_moments(names), _MOMENTS).select(
        "feature", "n", "mean", "m2", size.alias("size"), (F.sum(F.col("mean") * F.col("n")).over(every) / F.nullif(size, F.lit(0.0))).alias("middle")
    )
    gap = F.col("mean") - F.col("middle")
    table = parts.groupBy("feature", F.col("size"), F.col("middle")).agg(F.sum(F.col("m2") + F.col("n") * gap * gap).alias("m2"))
    std = F.round(F.sqrt(F.when(F.col("size") > ddof, F.col("m2") / (F.col("size") - ddof))), round_to)
    return table.select(
        "feature",
        (F.round("middle", round_to) + F.lit(0.0)).alias("mean"),
        F.when(std.isNull() | (std == 0), F.lit(1.0)).otherwise(std).alias("std"),
    )


def stats_map(stats: DataFrame) -> dict[str, tuple[float, float]]:
    """The fitted table on the driver: one row per feature."""
    return {r["feature"]: (r["mean"], r["std"]) for r in stats.collect()}


def _scaled(name: str, mean: float, std: float) -> Column:
    return (F.col(name) - F.lit(mean)) / F.lit(std)


def zscore(df: DataFrame, stats: dict[str, tuple[float, float]], names: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """``keep`` and one ``<feature>_norm`` per feature; features without stats stay as they are."""
    return df.select(
        *keep,
        *[(_scaled(n, *stats[n]) if n in stats else F.col(n)).alias(f"{n}_norm") for n in names],
    )


def zscore_serving(
    df: DataFrame, stats: dict[str, tuple[float, float]], names: Sequence[str], keep: Sequence[str]
) -> DataFrame:
    """As :func:`zscore`, with stats found under either name and constant features set to zero."""

    def one(name: str) -> Column:
        found = stats.get(name) or stats.get(f"{name}_norm")
        if found is None:
            return F.col(name)
        return _scaled(name, *found) if found[1] > 1e-9 else F.lit(0.0)

    return df.select(*keep, *[one(n).alias(f"{n}_norm") for n in names])


def minmax(df: DataFrame, names: Sequence[str], keep: Sequence[str]) -> DataFrame:
    ends = df.agg(*[F.min(n).alias(f"lo_{n}") for n in names], *[F.max(n).alias(f"hi_{n}") for n in names]).first()
    return df.select(
        *keep,
        *[
            ((F.col(n) - F.lit(ends[f"lo_{n}"])) / (F.lit(ends[f"hi_{n}"]) - F.lit(ends[f"lo_{n}"]) + F.lit(EPSILON))).alias(f"{n}_minmax")
            for n in names
        ],
    )


def robust(df: DataFrame, names: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Distance from the median in interquartile ranges."""
    rows = exact_quantiles(
        long_form(df, [], names),
        ["sensor"],
        {"q1": 0.25, "q2": 0.5, "q3": 0.75},
    ).collect()
    q = {r["sensor"]: r for r in rows}
    return df.select(
        *keep,
        *[
            (
                (F.col(n) - F.lit(q[n]["q2"])) / (F.lit(q[n]["q3"]) - F.lit(q[n]["q1"]) + F.lit(EPSILON))
                if n in q
                else F.col(n)
            ).alias(f"{n}_robust")
            for n in names
        ],
    )


def sample_skewness(column: Column) -> Column:
    """Bias-corrected skewness; Spark's own is the population form."""
    n = F.count(column).cast("double")
    return F.when(n > 2, F.skewness(column) * F.sqrt(n * (n - 1)) / (n - 2))


def compare_scalers(df: DataFrame, sensor: str) -> DataFrame:
    """Minimum, maximum, mean, deviation and skewness of one sensor under each scaler."""
    rows = df.where(F.col(sensor).isNotNull()).select(sensor)
    plain = rows.agg(F.avg(sensor).alias("m"), F.stddev_pop(sensor).alias("s")).first()
    # a constant column is zero under every scaler; a column without values has no statistics
    z = (F.col(sensor) - F.lit(plain["m"])) / F.lit(plain["s"] or 1.0)
    scaled = robust(rows, [sensor], [sensor, F.col(sensor).alias("original"), z.alias("zscore")])
    scaled = scaled.withColumnRenamed(f"{sensor}_robust", "robust")
    ends = rows.agg(F.min(sensor).alias("lo"), F.max(sensor).alias("hi")).first()
    scaled = scaled.withColumn(
        "minmax", (F.col(sensor) - F.lit(ends["lo"])) / (F.lit(ends["hi"]) - F.lit(ends["lo"]) + F.lit(EPSILON))
    )
    methods = ["original", "zscore", "minmax", "robust"]
    return (
        scaled.unpivot([], methods, "method", "value")
        .groupBy("method")
        .agg(
            F.min("value").alias("min"),
            F.max("value").alias("max"),
            F.avg("value").alias("mean"),
            F.stddev_pop("value").alias("std"),
            sample_skewness(F.col("value")).alias("skew"),
        )
    )
