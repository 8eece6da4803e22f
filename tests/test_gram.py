"""Correlations of many columns against numpy, pair by pair."""

from __future__ import annotations

import numpy as np
import pytest

from seriesmill.operators import gram


@pytest.mark.parametrize("block", [3, 32])
def test_pairs_against_numpy(spark, monkeypatch, block):
    monkeypatch.setattr(gram, "BLOCK", block)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 7)) @ rng.normal(size=(7, 7)) + 1e6
    x[:, 5] = 3.25  # constant
    x[rng.random(x.shape) < 0.2] = np.nan
    x[:, 6] = np.nan  # unknown throughout
    names = [f"x {i}" for i in range(7)]
    rows = [tuple(None if np.isnan(v) else float(v) for v in r) for r in x]
    df = spark.createDataFrame(rows, ", ".join(f"`{n}` double" for n in names)).repartition(5)
    got = {(r["a"], r["b"]): r["corr"] for r in gram.corr_of_many(df, [f"`{n}`" for n in names]).collect()}
    assert len(got) == 49
    for i in range(7):
        for j in range(7):
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            value = got[f"`x {i}`", f"`x {j}`"]
            if max(i, j) >= 5:
                assert value is None
            else:
                assert value == pytest.approx(np.corrcoef(x[both, i], x[both, j])[0, 1], abs=1e-9)


def test_no_rows(spark):
    df = spark.createDataFrame([], "a double, b double")
    assert [r["corr"] for r in gram.corr_of_many(df, ["a", "b"]).collect()] == [None] * 4
