"""Hot keys are cut into slices; results must equal the plain windows."""

from __future__ import annotations

from dataclasses import replace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from seriesmill.operators import features as feat
from seriesmill.operators import silver
from seriesmill.operators.slices import carve, number_rows
from seriesmill.spec import SeriesSpec

SPEC = SeriesSpec(entity="e", label="c", ts="t", tiebreak=("i",), sensors=("x", "y"), windows=(2, 5), lags=(1, 3))


@pytest.fixture(scope="module")
def series(spark):
    """One key holds most rows, one a few, one has no entity; many gaps."""
    rng = np.random.default_rng(7)
    n = 400
    entity = np.where(rng.random(n) < 0.8, "hot", np.where(rng.random(n) < 0.5, "cold", None))
    x = np.where(rng.random(n) < 0.5, np.nan, rng.normal(size=n).round(3))
    frame = pd.DataFrame(
        {
            "e": entity,
            "c": rng.integers(0, 2, n),
            "t": rng.integers(0, 60, n),
            "i": np.arange(n),
            "x": x,
            "y": rng.normal(size=n).round(3),
        }
    )
    rows = [tuple(None if isinstance(v, float) and np.isnan(v) else v for v in r) for r in frame.itertuples(index=False)]
    return spark.createDataFrame(rows, "e string, c int, t int, i int, x double, y double").repartition(4)


@pytest.mark.parametrize("max_rows", [1, 7, 60])
def test_fill_equals_plain_window(series, rows_of, max_rows):
    plain = silver.fill_series(series, SPEC)
    cut = silver.fill_series(series, replace(SPEC, max_rows_per_task=max_rows))
    assert rows_of(cut) == rows_of(plain)


@pytest.mark.parametrize("max_rows", [1, 3, 60])
def test_features_equal_plain_window(series, rows_of, max_rows):
    plain = feat.features(series, SPEC)
    cut = feat.features(series, replace(SPEC, max_rows_per_task=max_rows))
    assert rows_of(cut) == rows_of(plain)


def test_row_numbers_equal_plain_window(series, rows_of):
    plain = number_rows(series, ["e"], SPEC.order, 10**9)
    cut = number_rows(series, ["e"], SPEC.order, 20)
    assert rows_of(cut) == rows_of(plain)


def test_slices_stay_small(series):
    carved = carve(series, ["e"], SPEC.order, 20)
    sizes = [r["_len"] for r in carved.slices.collect()]
    assert sum(sizes) == carved.hot.count()
    assert max(sizes) <= 60  # range bounds are sampled: about 20, never the whole key


def test_copies_of_one_row_are_spread(spark):
    """A third of all rows are the very same row: they do not share one slice."""
    same = spark.range(0, 300, 1, 6).select(
        F.lit("a").alias("e"), F.lit(0).alias("c"), F.lit(5).alias("t"), F.lit(0).alias("i"), F.lit(None).cast("double").alias("x"), F.lit(1.0).alias("y")
    )
    other = spark.range(600).select(
        F.lit("a").alias("e"), F.lit(0).alias("c"), F.col("id").cast("int").alias("t"), F.lit(1).alias("i"), F.col("id").cast("double").alias("x"), F.lit(2.0).alias("y")
    )
    rows = same.unionByName(other)
    carved = carve(rows, SPEC.group, SPEC.order, 90)
    assert carved.hot.where("x IS NULL").select("_slice").distinct().count() > 1
    filled = silver.fill_series(rows, replace(SPEC, max_rows_per_task=90))
    assert filled.count() == 900
    assert {r["x"] for r in filled.where("i = 0").collect()} == {4.0}


def test_no_hot_key_means_plain_plan(series):
    plan = silver.fill_series(series, SPEC)._jdf.queryExecution().toString()
    assert "_slice" not in plan


def test_features_share_one_exchange_and_one_sort(spark, tmp_path):
    path = str(tmp_path / "s")
    spark.range(100).selectExpr(
        "'a' AS e", "0 AS c", "int(id) AS t", "int(id) AS i", "double(id) AS x", "double(id) AS y"
    ).write.parquet(path)
    df = feat.features(spark.read.parquet(path), SPEC)
    plan = df._jdf.queryExecution().sparkPlan().toString()
    executed = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window ") == 1
    assert executed.count("Exchange hashpartitioning") == 1
    assert executed.count("Sort [") == 1


def test_dedup_filters_before_the_shuffle(series):
    plan = silver.keep_first(series, SPEC)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_window_matches_pandas(series):
    got = feat.features(series, SPEC).toPandas().sort_values(["e", "c", "t", "i"])
    base = series.toPandas().sort_values(["e", "c", "t", "i"])
    group = base.groupby(["e", "c"], dropna=False)["x"]
    got = got.set_index("i")
    checks = {
        "x_roll_mean_5": lambda s: s.rolling(5, min_periods=1).mean(),
        "x_roll_std_5": lambda s: s.rolling(5, min_periods=1).std().fillna(0),
        "x_roll_max_2": lambda s: s.rolling(2, min_periods=1).max(),
        "x_lag_3": lambda s: s.shift(3),
        "x_delta": lambda s: s.diff(),
    }
    for name, rule in checks.items():
        want = group.transform(rule)
        want.index = base["i"]
        np.testing.assert_allclose(got[name].astype(float).reindex(want.index), want, atol=1e-9, err_msg=name)


def test_fill_matches_pandas(series):
    base = series.toPandas().sort_values(["e", "c", "t", "i"])
    want = base.groupby(["e", "c"], dropna=False)["x"].transform(lambda s: s.ffill().bfill())
    want.index = base["i"]
    got = silver.fill_series(series, SPEC).toPandas().set_index("i")["x"].astype(float)
    np.testing.assert_allclose(got.reindex(want.index), want)


def test_another_entity_changes_nothing(series, rows_of):
    one = series.where("e = 'hot'")
    alone = feat.features(one, SPEC)
    together = feat.features(series, SPEC).where("e = 'hot'")
    assert rows_of(alone) == rows_of(together)
    assert one.select(F.count_distinct("i")).first()[0] > 0
