"""Cleaning rules of the Silver layer."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesmill.functions.columns import within
from seriesmill.operators.quantiles import exact_quantiles, long_form
from seriesmill.operators.slices import attach, bounded, fill
from seriesmill.session import materialise
from seriesmill.spec import SeriesSpec, ordered


def null_out_of_range(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    return df.withColumns({s: within(F.col(s), lo, hi) for s, (lo, hi) in spec.ranges.items() if s in df.columns})


def range_counts(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Readings outside the physical range, per sensor."""
    bad = df.agg(
        *[F.count_if((F.col(s) < lo) | (F.col(s) > hi)).alias(s) for s, (lo, hi) in spec.ranges.items()]
    )
    return bad.unpivot([], list(spec.ranges), "sensor", "out_of_range")


def fill_series(df: DataFrame, spec: SeriesSpec, none_hot: bool = False) -> DataFrame:
    return fill(df, spec.group, spec.order, spec.sensors, spec.max_rows_per_task, none_hot)


def keep_first(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """One row per entity and time: lowest label, then lowest tie-break.

    The rank filter is applied before the shuffle as well, so a heap of copies
    leaves each map task as one row.
    """
    w = Window.partitionBy(spec.entity, spec.ts).orderBy(*ordered(spec.label, *spec.tiebreak))
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def drop_all_null(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    return df.na.drop(how="all", subset=list(spec.sensors))


def median_fallback(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Fill what is still missing with the class median, then the median of the result."""
    missing = df.agg(*[F.count_if(F.col(s).isNull()).alias(s) for s in spec.sensors]).first()
    gaps = [s for s in spec.sensors if missing[s]]
    if not gaps:
        return df
    by_class = exact_quantiles(
        long_form(df, [spec.label], gaps), [spec.label, "sensor"], {"median": 0.5}
    )
    wide = by_class.groupBy(spec.label).pivot("sensor", gaps).agg(F.first("median"))
    wide = bounded(wide.withColumnsRenamed({s: f"_median_{s}" for s in gaps}))
    filled = attach(df, wide, [spec.label], "left").withColumns(
        {s: F.coalesce(F.col(s), F.col(f"_median_{s}")) for s in gaps}
    )
    filled = filled.select(*df.columns)
    overall = exact_quantiles(
        long_form(filled, [], gaps), ["sensor"], {"median": 0.5}
    ).collect()
    medians = {r["sensor"]: r["median"] for r in overall if r["median"] is not None}
    return filled.na.fill(medians) if medians else filled


def silver(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Range rule, fill, dedup, all-null drop, median fallback: in this order.

    A value can stay missing only where a whole key has none.  One count per key
    tells so beforehand; the fallback then works on a written table.
    """
    ranged = null_out_of_range(df, spec)
    per_key = ranged.groupBy(*spec.group).agg(
        F.count(F.lit(1)).alias("_n"), F.least(*[F.count(s) for s in spec.sensors], F.count(F.lit(1))).alias("_known")
    )
    worst = per_key.agg(F.max("_n").alias("n"), F.min("_known").alias("known")).first()
    none_hot = (worst["n"] or 0) <= spec.max_rows_per_task
    filled = fill_series(ranged, spec, none_hot)
    rows = drop_all_null(keep_first(filled, spec), spec)
    return rows if worst["known"] else median_fallback(materialise(rows, "cleaned"), spec)
