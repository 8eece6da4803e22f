"""Profiles of sensors, classes and splits."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesmill.functions.columns import share
from seriesmill.operators.quantiles import exact_quantiles, long_form
from seriesmill.operators.slices import attach, bounded
from seriesmill.operators.scale import sample_skewness
from seriesmill.spec import UNKNOWN_LABEL, SeriesSpec


def with_label_text(df: DataFrame, labels: DataFrame, label: str, text: str = "event") -> DataFrame:
    """Add the text of the class; classes the dimension lacks get the default.

    ``labels`` has columns ``code`` and ``label``.
    """
    side = bounded(labels.select(F.col("code").alias(label), F.col("label").alias(text)))
    joined = attach(df, side, [label], "left")
    return joined.withColumn(text, F.coalesce(F.col(text), F.lit(UNKNOWN_LABEL)))


def class_dist(df: DataFrame, label: str) -> DataFrame:
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("pct", F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy()))


def imbalance(df: DataFrame, label: str) -> DataFrame:
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(
        F.count(F.lit(1)).alias("classes"),
        F.max("n").alias("largest"),
        F.min("n").alias("smallest"),
        (F.max("n") / F.min("n")).alias("ratio"),
        F.max_by(label, F.struct(F.col("n"), F.col(label))).alias("largest_class"),
    )


def sensor_profile(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Count, missing share, out-of-range count and the usual statistics of each sensor."""
    values = long_form(df, [], spec.sensors)
    v, s = F.col("value"), F.col("sensor")
    bad = F.lit(False)
    for name, (lo, hi) in spec.ranges.items():
        bad = bad | ((s == name) & ((v < lo) | (v > hi)))
    plain = values.groupBy("sensor").agg(
        F.count(v).alias("n"),
        F.avg(F.when(v.isNull(), 100.0).otherwise(0.0)).alias("null_pct"),
        F.count_if(bad).alias("out_of_range"),
        F.min(v).alias("min"),
        F.avg(v).alias("mean"),
        F.max(v).alias("max"),
        F.stddev_samp(v).alias("std"),
    )
    points = exact_quantiles(values, ["sensor"], {"p25": 0.25, "median": 0.5, "p75": 0.75, "p99": 0.99})
    return attach(plain, points, ["sensor"], "left")


def class_sensor_stats(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    return (
        long_form(df, [spec.label], spec.sensors)
        .groupBy(spec.label, "sensor")
        .agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"))
    )


def discriminative(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Spread of the class means of each sensor, ranked, with the best and worst marked."""
    means = class_sensor_stats(df, spec)
    power = means.groupBy("sensor").agg(F.stddev_samp("mean").alias("power"))
    every = Window.partitionBy()
    rank = F.row_number().over(Window.orderBy(F.col("power").desc_nulls_last(), F.col("sensor")))
    return power.select(
        "sensor",
        "power",
        rank.alias("rank"),
        (F.col("power") >= F.median("power").over(every)).alias("above_median"),
        (F.col("power") == F.max("power").over(every)).alias("best"),
        (F.col("power") == F.min("power").over(every)).alias("worst"),
    )


def null_pct(df: DataFrame, sensors: Sequence[str], alert: float = 5.0) -> DataFrame:
    """Missing share of each sensor in percent, and whether it is above the alert level."""
    shares = df.agg(*[F.avg(F.when(F.col(s).isNull(), 100.0).otherwise(0.0)).alias(s) for s in sensors])
    return shares.unpivot([], list(sensors), "sensor", "null_pct").withColumn(
        "alert", F.col("null_pct") > alert
    )


def corr_matrix(df: DataFrame, sensors: Sequence[str], complete_rows: bool = False) -> DataFrame:
    """Correlation of every pair of sensors, one row per pair in either order.

    One aggregate over the upper triangle.  A pair uses the rows where both are
    known, or with ``complete_rows`` the rows where all sensors are.
    """
    rows = df.na.drop(how="any", subset=list(sensors)) if complete_rows else df
    pairs = list(combinations(sensors, 2))
    both = [F.col(a).isNotNull() & F.col(b).isNotNull() for a, b in pairs]
    wide = rows.agg(
        *[F.corr(F.when(ok, F.col(a)), F.when(ok, F.col(b))).alias(f"r{i}") for i, ((a, b), ok) in enumerate(zip(pairs, both))],
        *[F.stddev_pop(s).alias(f"d{i}") for i, s in enumerate(sensors)],
    )

    def cell(a: str, b: str, r):
        return F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), r.alias("corr"))

    cells = [cell(a, b, F.col(f"r{i}")) for i, (a, b) in enumerate(pairs)]
    cells += [cell(b, a, F.col(f"r{i}")) for i, (a, b) in enumerate(pairs)]
    cells += [cell(s, s, F.when(F.col(f"d{i}") > 0, F.lit(1.0))) for i, s in enumerate(sensors)]
    return wide.select(F.inline(F.array(*cells)))


def corr_pairs(matrix: DataFrame, sensors: Sequence[str], limit: float = 0.7) -> DataFrame:
    """Pairs of the matrix with a strong correlation, each once, in sensor order."""
    place = F.create_map(*[x for i, s in enumerate(sensors) for x in (F.lit(s), F.lit(i))])
    return matrix.where((place[F.col("a")] < place[F.col("b")]) & (F.abs("corr") > limit))


def box_stats(df: DataFrame, spec: SeriesSpec, least: int = 5) -> DataFrame:
    """Quartiles, whiskers and outliers per class and sensor, over all values."""
    values = long_form(df, [spec.label], spec.sensors).where("value IS NOT NULL")
    by = [spec.label, "sensor"]
    boxes = exact_quantiles(values, by, {"q1": 0.25, "q2": 0.5, "q3": 0.75})
    boxes = bounded(
        boxes.withColumns(
            {
                "_lo": F.col("q1") - 1.5 * (F.col("q3") - F.col("q1")),
                "_hi": F.col("q3") + 1.5 * (F.col("q3") - F.col("q1")),
            }
        )
    )
    v, inside = F.col("value"), F.col("value").between(F.col("_lo"), F.col("_hi"))
    return (
        attach(values, boxes, by)
        .groupBy(*by, "q1", "q2", "q3")
        .agg(
            F.count(v).alias("n"),
            F.min(F.when(inside, v)).alias("whisker_low"),
            F.max(F.when(inside, v)).alias("whisker_high"),
            F.count_if(~inside).alias("outliers"),
        )
        .where(F.col("n") >= least)
    )


def histogram(df: DataFrame, column: str, low: float, high: float, bins: int) -> DataFrame:
    """Counts and density over equal bins of [low, high], empty ones too; values outside are left out.

    The last bin includes its upper edge.  Without values the density is null.
    """
    width = (high - low) / bins
    v = F.col(column)
    place = F.least(F.floor((v - low) / width), F.lit(bins - 1)).cast("int")
    counts = df.where(v.between(low, high)).groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    whole = every.join(counts, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())  # as many rows as bins
    return whole.select(
        "bin",
        (F.lit(low) + F.col("bin") * F.lit(width)).alias("left_edge"),
        "n",
        F.try_divide(F.col("n").cast("double"), total * F.lit(width)).alias("density"),
    )


def histogram_of_range(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Bins between the extremes; a constant column gets a range of one around it, an empty one [0, 1]."""
    ends = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi")).first()
    if ends["lo"] is None:
        return histogram(df, column, 0.0, 1.0, bins)
    low, high = float(ends["lo"]), float(ends["hi"])
    return histogram(df, column, *((low, high) if low < high else (low - 0.5, high + 0.5)), bins)


def busiest_entity(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """The entity with the most distinct classes; of several, the lowest id."""
    pairs = df.groupBy(spec.entity, spec.label).agg(F.count(F.lit(1)).alias("rows"))
    return (
        pairs.groupBy(spec.entity)
        .agg(F.count(F.col(spec.label)).alias("classes"), F.sum("rows").alias("n_rows"))
        .orderBy(F.col("classes").desc(), F.col(spec.entity).asc_nulls_last())
        .limit(1)
    )


def split_class_share(df: DataFrame, label: str, splits: Sequence[str], split: str = "split") -> DataFrame:
    """Share of each class inside every split, one column per split, in percent."""
    counts = df.groupBy(label, split).agg(F.count(F.lit(1)).alias("n"))
    pct = F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy(split))
    return counts.withColumn("pct", pct).groupBy(label).pivot(split, list(splits)).agg(F.first("pct"))


def split_summary(df: DataFrame, label: str, split: str = "split") -> DataFrame:
    """Rows of each split and its classes as a sorted list."""
    pairs = df.groupBy(split, label).agg(F.count(F.lit(1)).alias("n"))
    return pairs.groupBy(split).agg(
        F.sum("n").alias("n_rows"), F.concat_ws(",", F.sort_array(F.collect_set(label))).alias("classes")
    )


def skew_compare(df: DataFrame, sensors: Sequence[str]) -> DataFrame:
    """Mean, deviation and bias-corrected skewness of each column."""
    return (
        long_form(df, [], sensors)
        .groupBy("sensor")
        .agg(
            F.avg("value").alias("mean"),
            F.stddev_samp("value").alias("std"),
            sample_skewness(F.col("value")).alias("skew"),
        )
    )


def pred_summary(df: DataFrame, predicted: str, labels: DataFrame) -> DataFrame:
    """Rows and share of time per predicted event."""
    counts = df.groupBy(predicted).agg(F.count(F.lit(1)).alias("n"))
    whole = F.sum("n").over(Window.partitionBy())
    return with_label_text(counts.withColumn("pct_time", share(F.col("n") * 100.0, whole)), labels, predicted)
