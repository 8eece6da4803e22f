"""Hand-written frames for the cleaning rules, scalers, evaluation and thresholds."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from seriesmill.functions.columns import finite_or_zero, numeric, sensor_of
from seriesmill.operators import evaluate, features, profile, report, scale, silver, threshold
from seriesmill.spec import WELL_SENSORS, WELL_SERIES, SeriesSpec, event_labels

SPEC = SeriesSpec(
    entity="e", label="c", ts="t", sensors=("x", "y"), ranges={"x": (0.0, 10.0), "y": (-1.0, 1.0)}, windows=(2, 3), lags=(1, 2)
)
COLUMNS = "e string, c int, t int, x double, y double"


def frame(spark, rows):
    return spark.createDataFrame(rows, COLUMNS)


def by_time(df, column):
    return [r[column] for r in df.orderBy("c", "t").collect()]


def test_feature_names():
    names = WELL_SERIES.features
    assert len(names) == 136
    assert {"P-PDG", "P_PDG_roll_mean_5", "T_JUS_CKP_roll_std_30", "QGL_lag_3", "P_JUS_CKGL_delta"} <= set(names)


def test_range_is_inclusive(spark):
    df = silver.null_out_of_range(frame(spark, [("a", 0, i, x, None) for i, x in enumerate([-0.1, 0.0, 10.0, 10.1, None])]), SPEC)
    assert by_time(df, "x") == [None, 0.0, 10.0, None, None]


def test_fill_gaps(spark):
    rows = [("a", 0, i, x, None) for i, x in enumerate([None, None, 1.0, None, 2.0, None])] + [("a", 1, 9, None, 0.5)]
    df = silver.fill_series(frame(spark, rows), SPEC)
    assert by_time(df, "x") == [1.0, 1.0, 1.0, 1.0, 2.0, 2.0, None]
    assert by_time(df, "y") == [None] * 6 + [0.5]


def test_lowest_class_wins_and_missing_time_is_one_key(spark):
    rows = [("a", 2, 1, 2.0, 0.0), ("a", 1, 1, 1.0, 0.0), ("a", 3, None, 3.0, 0.0), ("a", 0, None, 4.0, 0.0), ("b", 2, 1, 5.0, 0.0)]
    kept = silver.keep_first(frame(spark, rows), SPEC).collect()
    assert sorted(r["x"] for r in kept) == [1.0, 4.0, 5.0]


def test_silver_medians(spark):
    """Class 0 has a median; class 1 has none for x, so the median after the class fill is taken."""
    rows = (
        [("a", 0, i, float(i), 0.5) for i in (1, 2, 3)]
        + [("b", 0, 1, 99.0, 0.1), ("c", 1, 5, None, 0.2), ("d", 1, 6, None, None)]
    )
    got = {(r["e"], r["t"]): (r["x"], r["y"]) for r in silver.silver(frame(spark, rows), SPEC).collect()}
    assert ("d", 6) not in got  # no reading at all
    assert got["b", 1] == (2.0, 0.1)
    assert got["c", 5] == (2.0, 0.2)  # median of 1, 2, 3, 2
    assert got["a", 1] == (1.0, 0.5)


def test_silver_of_nothing(spark):
    assert silver.silver(frame(spark, []), SPEC).count() == 0


def test_null_policies(spark):
    df = frame(spark, [("a", 0, i, x, 1.0) for i, x in enumerate([1.0, 2.0, 4.0])])
    assert features.features(df, SPEC, "drop_any").count() == 1
    zero = features.features(df, SPEC, "zero")
    assert by_time(zero, "x_lag_2") == [0.0, 0.0, 1.0]
    serving = features.features(df.drop("y"), SPEC.serving(), "backfill")
    assert by_time(serving, "x_lag_2") == [1.0, 1.0, 1.0]
    assert by_time(serving, "x_delta") == [0.0, 1.0, 2.0]
    assert by_time(serving, "y") == [0.0] * 3
    assert by_time(zero, "x_roll_std_2") == pytest.approx([0.0, 0.5**0.5, 2**0.5])
    with pytest.raises(ValueError):
        features.features(df, SPEC, "other")


def test_numbers_and_nan(spark):
    df = spark.createDataFrame([("1.5",), ("n/a",), ("NaN",), (None,)], "s string")
    assert [r[0] for r in df.select(numeric(F.col("s"))).collect()] == [1.5, None, None, None]
    inf = float("inf")
    df = spark.createDataFrame([(1.0,), (inf,), (-inf,), (float("nan"),), (None,)], "v double")
    assert [r[0] for r in df.select(finite_or_zero(F.col("v"))).collect()] == [1.0, 0.0, 0.0, 0.0, 0.0]
    assert features.non_finite_counts(df, ["v"]).first()["replaced"] == 4


def test_sensor_of_feature(spark):
    df = spark.createDataFrame([("P_PDG_roll_mean_10_norm",), ("T-JUS-CKGL_norm",), ("T_JUS_CKP_lag_1",), ("z",)], "f string")
    got = [r[0] for r in df.select(sensor_of(F.col("f"), WELL_SENSORS)).collect()]
    assert got == ["P-PDG", "T-JUS-CKGL", "T-JUS-CKP", "outro"]


def test_scaler_guards_zero_deviation(spark):
    df = frame(spark, [("a", 0, 1, 1.0, 3.0), ("a", 0, 2, 2.0, 3.0)])
    stats = scale.stats_map(scale.fit_scaler(df, ["x", "y"]))
    assert stats == {"x": (1.5, 0.5), "y": (3.0, 1.0)}
    assert scale.stats_map(scale.fit_scaler(df, ["x"], ddof=1))["x"][1] == pytest.approx(0.5**0.5, abs=1e-8)
    tiny = df.withColumn("y", F.col("x") * 1e-10)
    assert scale.stats_map(scale.fit_scaler(tiny, ["y"]))["y"][1] == 1.0
    serving = scale.zscore_serving(df, {"x_norm": (1.5, 0.5), "y": (0.0, 1e-12)}, ["x", "y"], ["t"]).orderBy("t").collect()
    assert [tuple(r) for r in serving] == [(1, -1.0, 0.0), (2, 1.0, 0.0)]


def test_scaled_train_is_standard(spark):
    rng = np.random.default_rng(1)
    df = frame(spark, [("a", 0, i, float(v), 1.0) for i, v in enumerate(rng.normal(5, 3, 200))])
    stats = scale.stats_map(scale.fit_scaler(df, ["x"]))
    got = scale.zscore(df, stats, ["x"], ["t"]).agg(F.avg("x_norm"), F.stddev_pop("x_norm")).first()
    assert tuple(got) == pytest.approx((0.0, 1.0), abs=1e-7)


def test_skewness_matches_pandas(spark):
    values = np.random.default_rng(2).gamma(2.0, size=60)
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    assert df.agg(scale.sample_skewness(F.col("x"))).first()[0] == pytest.approx(pd.Series(values).skew())


def test_correlation_uses_complete_pairs(spark):
    rng = np.random.default_rng(5)
    a, b = rng.normal(size=(2, 50))
    b[::7] = np.nan
    pdf = pd.DataFrame({"x": a, "y": b})
    df = frame(spark, [("a", 0, i, float(u), None if np.isnan(v) else float(v)) for i, (u, v) in enumerate(zip(a, b))])
    got = {(r["a"], r["b"]): r["corr"] for r in profile.corr_matrix(df, ["x", "y"]).collect()}
    assert got["x", "y"] == got["y", "x"] == pytest.approx(pdf.corr().loc["x", "y"])
    assert got["x", "x"] == 1.0


def test_macro_f1_counts_labels_of_both_sides(spark):
    """Class 2 is never predicted, class 3 never actual: both count with zero."""
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (2, 3)], "y int, p int")
    cells = evaluate.counts(df, "y", "p")
    got = evaluate.f1_summary(cells).first()
    assert got["accuracy"] == 0.5
    assert got["f1_macro"] == pytest.approx((2 / 3 + 2 / 3 + 0 + 0) / 4)
    assert got["f1_weighted"] == pytest.approx((2 * 2 / 3 + 2 / 3) / 4)
    table = {r["class"]: r for r in evaluate.class_report(cells, [0, 5]).collect()}
    assert (table[5]["support"], table[5]["f1"]) == (0, 0.0)
    grid = evaluate.confusion(cells, [0, 1, 2]).collect()
    assert len(grid) == 9 and {r["pct"] for r in grid if r["actual"] == 2} == {0.0}


def test_balanced_weights(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(1,)] * 2, "y int")
    assert {r["y"]: r["weight"] for r in evaluate.class_weights(df, "y").collect()} == {0: 8 / 12, 1: 2.0}


def test_decision_ties_zero_and_missing(spark):
    df = spark.createDataFrame([([0.4, 0.4, 0.2],), ([0.1, 0.2, 0.7],), ([0.0, 0.0, 0.0],)], "p array<double>")
    plain = [r[0] for r in df.select(threshold.argmax(F.col("p"))).collect()]
    assert plain == [0, 2, 0]
    said = [r[0] for r in df.select(threshold.decide(F.col("p"), [0.5, 0.0, None])).collect()]
    assert said == [1, 1, 0]  # a zero threshold is lifted to the smallest one


def brute(p, y, t, classes):
    said = np.argmax(p / np.clip(np.array(t), 1e-6, 1.0), axis=1)
    scores = []
    for c in sorted(set(y) | set(said)):
        tp = ((y == c) & (said == c)).sum()
        scores.append(2 * tp / ((y == c).sum() + (said == c).sum()))
    return said, float(np.mean(scores))


@pytest.mark.parametrize("seed", range(3))
def test_sweep_equals_brute_force(spark, seed):
    """Coarse probabilities make many ties, zeros included."""
    rng = np.random.default_rng(seed)
    p = rng.integers(0, 6, size=(300, 4)) / 10.0
    y = rng.integers(0, 4, 300)
    df = spark.createDataFrame([(int(a), [float(v) for v in b]) for a, b in zip(y, p)], "y int, p array<double>")
    t = [0.3, 0.5, 0.25, 1.0]
    points = threshold.grid(50)
    np.testing.assert_allclose(points, np.linspace(0.01, 1.0, 50), atol=1e-15)
    for c in range(4):
        got = {r["step"]: r["f1_macro"] for r in threshold.sweep(df, "y", "p", c, t, 50).collect()}
        for i, v in enumerate(points):
            assert got[i] == pytest.approx(brute(p, y, t[:c] + [v] + t[c + 1 :], 4)[1], abs=1e-12)


def test_tune_equals_brute_force(spark):
    rng = np.random.default_rng(9)
    y = rng.choice(3, 400, p=[0.8, 0.15, 0.05])
    p = rng.dirichlet([2, 1, 1], 400)
    p[np.arange(400), y] += 0.2
    df = spark.createDataFrame([(int(a), [float(v) for v in b]) for a, b in zip(y, p)], "y int, p array<double>")
    best = [float((y == c).mean()) for c in range(3)]
    for c in range(3):
        tried = [(brute(p, y, best[:c] + [v] + best[c + 1 :], 3)[1], v) for v in threshold.grid(20)]
        top = max(f for f, _ in tried)
        best[c] = next(v for f, v in tried if f > top - 1e-12)
    assert threshold.tune(df, "y", "p", 3, 20) == pytest.approx(best)


def test_gates(spark):
    df = spark.createDataFrame([("val", 1.0)], "split string, x_norm double")
    got = {r["check"]: (r["passed"], r["value"]) for r in report.quality_gates(df).collect()}
    assert got == {"splits_present": (False, 1), "rows": (True, 1), "norm_features": (False, 1), "train_rows": (False, 0)}
    with pytest.raises(ValueError, match="train_rows"):
        report.require_gates(df)


def test_label_text_default(spark):
    df = spark.createDataFrame([(0,), (99,), (None,)], "c int")
    got = [r["event"] for r in profile.with_label_text(df, event_labels(spark), "c").collect()]
    assert got == ["Normal", "Desconhecido", "Desconhecido"]


def test_histogram_has_every_bin_and_takes_constant_and_empty_columns(spark):
    from seriesmill.operators import profile, scale

    df = spark.createDataFrame([(0.0, 3.0, None), (10.0, 3.0, None)], "a double, b double, c double")
    a = sorted((r["bin"], r["n"]) for r in profile.histogram_of_range(df, "a", 5).collect())
    assert a == [(0, 1), (1, 0), (2, 0), (3, 0), (4, 1)]
    assert sum(r["n"] for r in profile.histogram_of_range(df, "b", 5).collect()) == 2
    assert [r["n"] for r in profile.histogram_of_range(df, "c", 2).collect()] == [0, 0]
    assert {r["method"]: r["mean"] for r in scale.compare_scalers(df, "b").collect()} == {"original": 3.0, "zscore": 0.0, "minmax": 0.0, "robust": 0.0}
    assert scale.compare_scalers(df, "c").count() in (0, 4)
