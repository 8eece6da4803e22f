"""Training, persistence, scoring and additive attributions on a small learnable series."""

from __future__ import annotations

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesmill.operators import attribution, model, report, scale, split
from seriesmill.plans import scoring, training
from seriesmill.sources import files
from seriesmill.spec import SeriesSpec, event_labels

SPEC = SeriesSpec(entity="e", label="c", ts="t", sensors=("u", "v"), windows=(3,), lags=(1,))
NAMES = ["u_norm", "v_norm"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(4)
    made = []
    for i in range(900):
        c = (0, 0, 0, 4, 4, 7)[i % 6]
        made.append((f"w{i % 3}", i, c, float(rng.normal(c)), float(rng.normal(-c, 2.0))))
    df = spark.createDataFrame(made, "e string, t int, c int, u double, v double")
    scaled = scale.zscore(df, scale.stats_map(scale.fit_scaler(df, SPEC.sensors)), SPEC.sensors, ["e", "t", "c"])
    return split.stratified_split(scaled, "c", ["e", "t"])


@pytest.fixture(scope="module")
def forest(rows):
    return model.train_forest(rows, "c", NAMES, numTrees=8, maxDepth=5)


@pytest.fixture(scope="module")
def boosted(rows):
    return model.train_boosted(rows, "c", NAMES, rounds=6, depth=3, eta=0.3)


def test_label_index_is_contiguous(rows):
    assert {r["c"]: r["idx"] for r in model.label_index(rows, "c").collect()} == {0: 0, 4: 1, 7: 2}


@pytest.mark.parametrize("kind", ["forest", "boosted"])
def test_better_than_the_majority(rows, kind, request):
    fitted = request.getfixturevalue(kind)
    said = fitted.predict(rows.where("split = 'test'"))
    assert said.where("predicted = c").count() / said.count() > 0.7
    p = np.array([r["p"] for r in said.collect()])
    np.testing.assert_allclose(p.sum(axis=1), 1.0)


@pytest.mark.parametrize("kind", ["forest", "boosted"])
def test_save_and_load(spark, rows, kind, request, tmp_path, rows_of):
    fitted = request.getfixturevalue(kind)
    fitted.save(spark, str(tmp_path / "m"))
    back = model.EventModel.load(spark, str(tmp_path / "m"))
    assert (back.labels, back.features) == (fitted.labels, fitted.features)
    keep = ["e", "t", "predicted", "confidence"]
    assert rows_of(back.predict(rows).select(*keep)) == rows_of(fitted.predict(rows).select(*keep))


def test_attributions_add_up(rows, forest):
    """Root value plus credits is the probability."""
    some = rows.where("split = 'test'")
    values = attribution.attribute(some, forest, ["e", "t"])
    assert values.count() == some.count() * 2 * 3  # two features, three classes
    sums = values.groupBy("e", "t", "class").agg((F.sum("value") + F.first("root_value")).alias("total"))
    p = forest.probabilities(some).select("e", "t", F.posexplode("p").alias("i", "p"))
    p = p.withColumn("class", F.element_at(F.array(*[F.lit(x) for x in forest.labels]), F.col("i") + 1))
    worst = sums.join(p, ["e", "t", "class"]).agg(F.max(F.abs(F.col("total") - F.col("p"))), F.count("*")).first()
    assert worst[0] < 1e-5 and worst[1] == some.count() * 3


def test_boosting_goes_on_while_validation_gains(spark, rows):
    fitted = model.train_boosted(rows, "c", NAMES, rounds=40, depth=2, eta=0.5, patience=4)
    curve = model.learning_curve(spark, fitted)
    losses = [r["loss"] for r in curve.where("split = 'val'").orderBy("iteration").collect()]
    best = losses.index(min(losses)) + 1
    assert best == len(fitted.fitted.trees) > 1 and len(losses) in (40, best + 4)
    train = [r["loss"] for r in curve.where("split = 'train'").orderBy("iteration").collect()]
    assert train[0] > train[best - 1]


def test_importance(spark, forest, boosted):
    for fitted in (forest, boosted):
        assert fitted.importance(spark).agg(F.sum("importance")).first()[0] == pytest.approx(1.0)


def test_training_plan(spark, rows, tmp_path):
    done = training.train_and_tune(
        rows, SPEC, NAMES, ["e", "t"], models=("rf",), max_train_rows=500, min_features=2, steps=10, params={"rf": {"numTrees": 5, "maxDepth": 4}}
    )
    training.write_reports(done, str(tmp_path))
    back = report.metrics_from_documents(files.read_json(spark, str(tmp_path / "metrics"), "document string")).collect()
    assert {(r["model"], r["split"]) for r in back} == {("rf", "val"), ("rf", "test")}
    assert set(back[0]["top5_features"]) == set(NAMES)
    found = report.thresholds_from_document(files.read_json(spark, str(tmp_path / "thresholds"), "model string, document string"))
    assert {r["class"]: r["threshold"] for r in found.collect()} == {str(c): t for c, t in done["thresholds"]["rf"].items()}
    row = done["report"].first()
    assert row["model"] == "rf" and 0.5 < row["f1_test"] <= 1.0 and row["gain_points"] >= 0
    assert set(done["thresholds"]["rf"]) == {0, 4, 7}
    kept = {r["split"]: r["count"] for r in done["rows"].groupBy("split").count().collect()}
    whole = {r["split"]: r["count"] for r in rows.groupBy("split").count().collect()}
    assert kept["train"] == 500 and (kept["val"], kept["test"]) == (whole["val"], whole["test"])  # only fitted rows are bounded
    tuning = spark.read.json(str(tmp_path / "tuning" / "rf"))
    assert {r["split"] for r in tuning.collect()} == {"val", "test"} and "f1_macro" in tuning.columns
    assert spark.read.json(str(tmp_path / "class_report" / "rf" / "tuned")).count() == 6
    every = training.explain(done["rows"], done["models"]["rf"], "c", ["e", "t"])
    assert every.count() == done["rows"].count() * 2 * 3
    values = training.explain(done["rows"], done["models"]["rf"], "c", ["e", "t"], 20)
    shares = attribution.sensor_importance(attribution.global_importance(values), SPEC.sensors)
    assert shares.agg(F.sum("pct")).first()[0] == pytest.approx(100.0)
    documents = attribution.attribution_json(attribution.attribution_report(values, SPEC.sensors)).collect()
    assert len(documents) == 3 and "u_norm" in documents[0]["top_features"]
    whole = json.loads(attribution.attribution_document(values, SPEC.sensors, event_labels(spark)).first()[0])
    assert len(whole["classes"]) == 3 and whole["rows"] == 60 and whole["features"] == 2
    assert sum(whole["sensor_pct"].values()) == pytest.approx(100.0, abs=0.2)


def test_scoring_of_a_new_series(spark, forest):
    new = spark.createDataFrame([("w9", i, 0.0 if i < 50 else 7.0) for i in range(100)], "e string, t int, u double")
    stats = spark.createDataFrame([("u", 2.5, 2.8), ("v_norm", -2.5, 3.3)], "feature string, mean double, std double")
    scored = scoring.score_series(new, SPEC, forest, stats)
    assert scored.count() == 100
    assert {r["predicted"] for r in scored.where("t < 50").collect()} == {0}
    summary = scoring.event_summary(scored, event_labels(spark))
    assert summary.agg(F.sum("pct_time")).first()[0] == pytest.approx(100.0)
