"""Registered queries do the whole of their job, on a small table of their own."""

from __future__ import annotations

import datetime
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesmill.operators import boosting, features, silver
from seriesmill.registry import QUERIES
from seriesmill.registry.fixtures import LINES, lines

SCHEMA = """l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double,
    l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"""


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = np.random.default_rng(8)
    made = []
    for i in range(900):
        day = datetime.datetime(1995, 1, 1) + datetime.timedelta(days=int(rng.integers(0, 900)))
        values = (float(rng.integers(1, 51)), float(np.round(rng.uniform(900, 100_000), 2)), float(rng.integers(0, 11)) / 100, float(rng.integers(0, 9)) / 100)
        made.append((i // 4, int(rng.integers(1, 200)), int(rng.integers(1, 4)), i % 4, *values, "ANR"[int(rng.integers(0, 3))], "OF"[int(rng.integers(0, 2))], day))
    at = str(tmp_path_factory.mktemp("lines"))
    spark.createDataFrame(made, SCHEMA).write.parquet(f"{at}/lineitem.parquet")
    return at


def test_correlations_of_every_pair_of_features(spark, folder):
    made = {(r["a"], r["b"]): r["corr"] for r in QUERIES["corr_features"](spark, folder).collect()}
    assert made.pop(("pairs", "pairs")) == len(LINES.features) ** 2
    assert set(made) == {(a, b) for a in LINES.features for b in LINES.features}
    derived = features.features(silver.silver(lines(spark, folder), LINES), LINES)
    some = [("l_tax_lag_5", "l_tax"), ("l_quantity_lag_1", "l_quantity_roll_mean_5"), ("l_discount_lag_3", "l_discount_lag_5")]
    wanted = derived.agg(*[F.corr(a, b) for a, b in some]).first()
    for pair, corr in zip(some, wanted):
        assert made[pair] == pytest.approx(corr, abs=1e-6)


def test_boosted_models_have_all_their_rounds(spark, folder, monkeypatch):
    asked = []
    fit = boosting.fit

    def short(rows, names, classes, s):
        asked.append(s)
        return fit(rows, names, classes, replace(s, rounds=2))

    monkeypatch.setattr(boosting, "fit", short)
    made = QUERIES["gbt_train"](spark, folder).collect()
    assert sorted((r["model"], r["split"]) for r in made) == [(m, s) for m in ("lgb", "xgb") for s in ("test", "train", "val")]
    assert asked == [boosting.BY_DEPTH, boosting.BY_LEAF] and [s.rounds for s in asked] == [500, 1000]
