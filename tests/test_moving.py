"""Features by numpy equal Spark's own window frames; scaler and rounding equal Spark's aggregates and its round."""

from __future__ import annotations

import math
import struct

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from seriesmill.functions.columns import rounded
from seriesmill.operators import features as feat
from seriesmill.operators import scale
from seriesmill.plans import medallion
from seriesmill.session import METHOD_LIMIT, limit_methods
from seriesmill.spec import SeriesSpec

SPEC = SeriesSpec(entity="e", label="c", ts="t", tiebreak=("i",), sensors=("x-1", "y"), windows=(2, 5, 7), lags=(1, 3))
INF, NAN = float("inf"), float("nan")


@pytest.fixture(scope="module")
def odd(spark):
    rng = np.random.default_rng(11)
    plain = lambda: None if rng.random() < 0.3 else float(rng.normal() * 10.0 ** rng.integers(-3, 6))
    rows = [([None, "a", "b"][rng.integers(0, 3)], int(rng.integers(0, 2)), None if rng.random() < 0.1 else int(rng.integers(0, 90)), i, plain(), plain()) for i in range(300)]
    rows += [("odd", 0, t, t, v, float(t)) for t, v in enumerate([1.0, INF, 2.0, None, -INF, NAN, 3.0, None, None, 4.0, 5.0, 6.0, 7.0, 8.0, 9.0, 10.0, 11.0])]
    rows += [("gone", 1, t, t, None, None) for t in range(4)]
    return spark.createDataFrame(rows, "e string, c int, t int, i int, `x-1` double, y double").repartition(3)


def bits(df, names):
    """Doubles by their bits, all NaN alike."""
    kept = lambda v: "nan" if isinstance(v, float) and math.isnan(v) else struct.pack("<d", v) if isinstance(v, float) else v
    return sorted((tuple(kept(r[n]) for n in names) for r in df.collect()), key=repr)


@pytest.mark.parametrize("backfill", [False, True])
def test_equal_to_frames_bit_by_bit(spark, odd, backfill):
    w = Window.partitionBy(*SPEC.group).orderBy(*SPEC.order)
    want = odd.select(
        "*",
        *[c for s in SPEC.sensors for c in feat.rolling_columns(f"`{s}`" if "-" in s else s, SPEC, w, feat.STATS)],
        *[c for s in SPEC.sensors for c in feat.lag_columns(s, SPEC, w, backfill)],
        *[feat.delta_column(s, SPEC, w, backfill) for s in SPEC.sensors],
    )
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "9")
    try:
        made = feat.features(odd, SPEC, "backfill" if backfill else "keep")
        names = [*SPEC.meta, *SPEC.features]
        assert bits(made, names) == bits(want.toDF(*made.columns), names)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_no_frame_is_walked_row_by_row(odd):
    plan = feat.features(odd, SPEC)._jdf.queryExecution().toString()
    assert "MapInArrow" in plan and "stddev" not in plan


def test_other_types_stay_in_frames(spark):
    spec = SeriesSpec(entity="e", label="c", ts="t", sensors=("x",), windows=(2,), lags=(1,))
    made = feat.features(spark.createDataFrame([("a", 0, 1, 5), ("a", 0, 2, 7)], "e string, c int, t int, x int"), spec)
    assert dict(made.dtypes)["x_roll_max_2"] == "int" and {(r.t, r.x_lag_1, r.x_delta) for r in made.collect()} == {(1, None, None), (2, 5, 2)}


def test_scaler_in_one_row_a_task_and_feature(spark, odd):
    rows = odd.where("e <> 'odd' OR e IS NULL").withColumn("none", F.lit(None).cast("double")).withColumn("same", F.lit(3.5))
    names = ["x-1", "y", "none", "same"]
    for ddof, spread in ((0, F.stddev_pop), (1, F.stddev_samp)):
        fitted = scale.fit_scaler(rows, names, ddof)
        assert "Expand" not in fitted._jdf.queryExecution().toString()
        got = scale.stats_map(fitted)
        want = rows.agg(*[f(n).alias(f"{k}{i}") for i, n in enumerate(names) for k, f in (("m", F.avg), ("s", spread))]).first()
        assert got["none"] == (None, 1.0) and got["same"] == (3.5, 1.0)
        for i in (0, 1):
            assert got[names[i]] == pytest.approx((want[f"m{i}"], want[f"s{i}"]), rel=1e-12, abs=1e-8)
    assert math.isnan(scale.stats_map(scale.fit_scaler(odd, ["x-1"]))["x-1"][0])
    assert scale.stats_map(scale.fit_scaler(rows.where("false"), names)) == {}
    assert scale.stats_map(scale.fit_scaler(rows.where("i = 7").limit(1), ["same"], 1)) == {"same": (3.5, 1.0)}


def test_rounded_equals_round(spark):
    rng = np.random.default_rng(5)
    values = [*(rng.normal(size=3000) * 10.0 ** rng.integers(-8, 14, 3000)), *((rng.integers(-(10**9), 10**9, 2000) * 2 + 1) / 2e6), *((rng.integers(-(10**12), 10**12, 2000) * 10 + 5) / 1e7)]
    df = spark.createDataFrame([(v,) for v in [*map(float, values), 0.0, -0.0, -1e-9, NAN, INF, -INF, 1e300, 5e-7, -5e-7, 0.285, None]], "v double")
    both = df.select(*[c.alias(f"{k}{d}") for d in (4, 6) for k, c in (("a", rounded(F.col("v"), d)), ("b", F.round("v", d) + F.lit(0.0)))])
    for d in (4, 6):
        assert bits(both, [f"a{d}"]) == bits(both, [f"b{d}"])
        assert both.where(f"NOT (a{d} <=> b{d})").isEmpty()


def test_queries_limit_generated_methods(spark):
    spark.conf.unset(METHOD_LIMIT[0])
    limit_methods(spark)
    assert spark.conf.get(METHOD_LIMIT[0]) == "8000"


def test_scaler_is_fitted_on_keys_up_to_the_cut(odd, monkeypatch):
    """Keys behind the cut are left out before their features are made."""
    seen = []
    kept = feat.features

    def noted(rows, *rest):
        seen.append(rows)
        return kept(rows, *rest)

    monkeypatch.setattr(feat, "features", noted)
    odd = odd.where("e <> 'odd'")
    rows, stats = medallion.gold(odd, SPEC)
    assert {r.e for r in seen[-1].select("e").distinct().collect()} < {r.e for r in odd.select("e").distinct().collect()}
    train = kept(odd, SPEC, "zero").join(rows.where("split = 'train'").select("e", "c", "i"), ["e", "c", "i"])
    got = scale.stats_map(stats)
    want = train.agg(F.avg("y"), F.stddev_pop("y_roll_mean_5")).first()
    assert got["y"][0] == pytest.approx(want[0], rel=1e-9) and got["y_roll_mean_5"][1] == pytest.approx(want[1], rel=1e-9)
