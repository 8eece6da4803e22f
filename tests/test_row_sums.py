"""Attributions with one row for each scored one, and the queries that read them and the serving features."""

from __future__ import annotations

from pyspark.sql import functions as F
from test_whole_jobs import folder  # noqa: F401

from seriesmill.operators import attribution, boosting, model
from seriesmill.registry import QUERIES, learning


def test_rows_hold_the_values_of_the_long_table(spark, rows_of):
    made = [(i, float(i % 7), float(i % 3), i % 2) for i in range(200)]
    df = spark.createDataFrame(made, "id int, a double, b double, y int").withColumn("split", F.lit("train"))
    fitted = model.train_boosted(df, "y", ["a", "b"], defaults=boosting.BY_LEAF, rounds=2)
    wide = attribution.attribute(df, fitted, ["id"], long=False)
    assert wide.count() == 200 and wide.columns == ["id", "_values"]
    assert rows_of(wide.select("id", F.inline("_values"))) == rows_of(attribution.attribute(df, fitted, ["id"]))


def test_attribution_adds_up_without_a_key_of_rows(spark, folder, monkeypatch):  # noqa: F811
    asked = []
    attribute = attribution.attribute
    monkeypatch.setattr(attribution, "attribute", lambda df, fitted, keep, **how: asked.append(keep) or attribute(df, fitted, keep, **how))
    made = QUERIES["attribution"](spark, folder).collect()
    assert {(r["actual"], r["class"]) for r in made} == {(a, c) for a in "ANR" for c in "ANR"}
    assert {(r["features"], r["off"]) for r in made} == {(4, 0)}
    assert asked == [["l_returnflag", "p"]]  # no number per row that sums would have to meet by


def test_serving_features_are_derived_once_for_scaler_and_fit(spark, folder, monkeypatch):  # noqa: F811
    seen = []
    stats = learning.serving_stats
    monkeypatch.setattr(learning, "serving_stats", lambda made, names: seen.append(made) or stats(made, names))
    scored = {r["predicted"]: r["n"] for r in QUERIES["score_series"](spark, folder).collect()}
    assert sum(scored.values()) == learning.labelled(spark, folder).count()
    assert all("serving-" in f for f in seen[0].inputFiles())  # a written table, of the columns that are read
    assert seen[0].columns[-2:] == ["l_returnflag", "split"] and len(seen[0].columns) == 8
