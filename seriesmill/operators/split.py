"""Train, validation and test splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesmill.functions.columns import hash_key
from seriesmill.operators.ranks import keys_at, label_by_cuts
from seriesmill.operators.slices import attach, bounded
from seriesmill.operators.selection import hash_cuts
from seriesmill.spec import SeriesSpec

SPLITS = ("train", "val", "test")
CUTS = (0.70, 0.70 + 0.15)


def split_column(df: DataFrame, order: Sequence[str], cuts: Sequence[float] = CUTS) -> Column:
    return label_by_cuts(df, order, keys_at(df, order, cuts), SPLITS)


def ordinal_split(df: DataFrame, spec: SeriesSpec, cuts: Sequence[float] = CUTS) -> DataFrame:
    """By position after sorting on entity, then time: tells entities apart, not times."""
    return df.withColumn("split", split_column(df, (spec.entity, spec.ts, *spec.tiebreak), cuts))


def time_split(df: DataFrame, spec: SeriesSpec, cuts: Sequence[float] = CUTS) -> DataFrame:
    return df.withColumn("split", split_column(df, (spec.ts, spec.entity, *spec.tiebreak), cuts))


def stratified_split(
    df: DataFrame, label: str, key: Sequence[str], seed: int = 42, part: float = 0.15
) -> DataFrame:
    """Per class, the first share in digest order is test, the next validation, the rest train.

    Rows with one key stay together.
    """
    tagged = df.withColumn("_h", hash_key(key, seed))
    size = F.bround(F.col("n") * F.lit(part))
    cuts = bounded(hash_cuts(tagged.select(label, "_h"), [label], [size, size * 2]))
    placed = attach(tagged, cuts, [label], "left")
    split = (
        F.when(F.col("_h") <= F.col("_cut_0"), F.lit("test"))
        .when(F.col("_h") <= F.col("_cut_1"), F.lit("val"))
        .otherwise(F.lit("train"))
    )
    return placed.withColumn("split", split).select(*df.columns, "split")


def missing_classes(df: DataFrame, label: str, split: str = "split") -> DataFrame:
    """Classes that some split lacks, with the split that lacks them.

    Works on the distinct (class, split) pairs, not on the rows.
    """
    present = df.groupBy(F.col(label), F.col(split).alias("split")).agg(F.count(F.lit(1)).alias("n"))
    every = present.groupBy(label).agg(F.collect_set("split").alias("_in"))
    return every.select(
        label, F.explode(F.array_except(F.array(*[F.lit(s) for s in SPLITS]), "_in")).alias("split")
    )


def resplit_if_needed(
    df: DataFrame, spec: SeriesSpec, key: Sequence[str], seed: int = 42
) -> DataFrame:
    """Keep the given split unless train is empty or a class is missing somewhere."""
    seen = {r[0] for r in df.select("split").distinct().collect()}
    if "train" not in seen:
        df = ordinal_split(df.drop("split"), spec)
    if missing_classes(df, spec.label).isEmpty():
        return df
    return stratified_split(df.drop("split"), spec.label, key, seed)
