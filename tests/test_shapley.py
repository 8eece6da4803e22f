"""Shapley values against their definition: all subsets of known features."""

from __future__ import annotations

from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from seriesmill.operators import attribution, boosting, model

SIX = 6


def random_tree(rng, depth: int, classes: int) -> dict:
    """A tree that splits on features more than once, with covers that add up."""
    left, right, feature, threshold, cover = [], [], [], [], []

    def grow(level: int, rows: float) -> int:
        node = len(left)
        for column, value in zip((left, right, feature, threshold, cover), (-1, -1, 0, 0.0, rows)):
            column.append(value)
        if level < depth and rng.random() < 0.85:
            feature[node], threshold[node] = int(rng.integers(SIX)), float(rng.normal())
            share = rng.uniform(0.05, 0.95)
            left[node], right[node] = grow(level + 1, rows * share), grow(level + 1, rows * (1 - share))
        return node

    grow(0, 100.0)
    arrays = {n: np.array(v) for n, v in (("left", left), ("right", right), ("feature", feature), ("threshold", threshold), ("cover", cover))}
    return {**arrays, "classes": slice(0, classes), "value": rng.normal(size=(len(left), classes))}


def known(tree: dict, x: np.ndarray, subset: frozenset, node: int = 0) -> np.ndarray:
    """Mean output where only the features of ``subset`` are known."""
    if tree["left"][node] < 0:
        return tree["value"][node]
    a, b = tree["left"][node], tree["right"][node]
    if tree["feature"][node] in subset:
        return known(tree, x, subset, a if x[tree["feature"][node]] <= tree["threshold"][node] else b)
    share = tree["cover"][a] / tree["cover"][node]
    return share * known(tree, x, subset, a) + (1 - share) * known(tree, x, subset, b)


def enumerated(trees: list[dict], x: np.ndarray, classes: int) -> np.ndarray:
    made = np.zeros((classes, SIX + 1))
    value = lambda s: sum(known(t, x, frozenset(s)) for t in trees)
    for i in range(SIX):
        others = [j for j in range(SIX) if j != i]
        for size in range(SIX):
            for s in combinations(others, size):
                made[:, i] += factorial(size) * factorial(SIX - size - 1) / factorial(SIX) * (value({*s, i}) - value(s))
    made[:, SIX] = value(())
    return made


def test_random_trees_against_enumeration():
    rng = np.random.default_rng(5)
    for turn in range(6):
        trees = [random_tree(rng, depth, 2) for depth in (0, 2, 5, 7)]
        x = rng.normal(size=(12, SIX))
        if turn == 0:
            x[0] = trees[-1]["threshold"][0]  # on a threshold
        got = attribution.shapley(x, trees, 2)
        np.testing.assert_allclose(got, [enumerated(trees, row, 2) for row in x], atol=1e-10)


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(600, SIX))
    y = np.digitize(x[:, 0] + x[:, 1] * x[:, 2] + 0.2 * x[:, 3], [-0.5, 0.6])
    made = [(i, *map(float, v), int(k), ("train", "train", "train", "val")[i % 4]) for i, (v, k) in enumerate(zip(x, y))]
    return spark.createDataFrame(made, "id int, " + ", ".join(f"f{i} double" for i in range(SIX)) + ", c int, split string")


NAMES = [f"f{i}" for i in range(SIX)]


@pytest.mark.parametrize("kind", ["forest", "boosted", "leafwise"])
def test_fitted_models(spark, rows, kind, monkeypatch):
    """Equal to enumeration, and adding up to the output; also with the trees in many broadcasts."""
    if kind == "forest":
        fitted = model.train_forest(rows, "c", NAMES, numTrees=4, maxDepth=5)
    else:
        fitted = model.train_boosted(rows, "c", NAMES, defaults=boosting.BY_DEPTH if kind == "boosted" else boosting.BY_LEAF, rounds=3, eta=0.3)
    some = rows.where("id < 40")
    values = attribution.attribute(some, fitted, ["id"])
    assert values.count() == 40 * 3 * SIX
    sums = values.groupBy("id", "class").agg((F.sum("value") + F.first("root_value")).alias("total"))
    if kind == "forest":
        scored = fitted.fitted.transform(model.assemble(some, NAMES)).select("id", vector_to_array("probability").alias("out"))
        out = {r["id"]: r["out"] for r in scored.collect()}
    else:
        held = some.select("id", *NAMES).collect()
        made = fitted.fitted.margins(np.array([[r[n] for n in NAMES] for r in held]))
        out = {r["id"]: list(m) for r, m in zip(held, made)}
    for r in sums.collect():
        assert r["total"] == pytest.approx(out[r["id"]][r["class"]], abs=1e-9)
    trees = attribution._trees(spark, fitted)
    for row in some.limit(3).collect():
        want = enumerated_by_class(trees, np.array([row[n] for n in NAMES]), 3)
        for r in values.where(F.col("id") == row["id"]).collect():
            assert r["value"] == pytest.approx(want[r["class"], NAMES.index(r["feature"])], abs=1e-9)
    monkeypatch.setattr(attribution, "BROADCAST_BYTES", 1)
    again = attribution.attribute(some, fitted, ["id"]).withColumnRenamed("value", "other")
    off = values.join(again, ["id", "class", "feature"]).agg(F.max(F.abs(F.col("value") - F.col("other"))), F.count("*")).first()
    assert off[0] < 1e-9 and off[1] == 40 * 3 * SIX


def enumerated_by_class(trees: list[dict], x: np.ndarray, classes: int) -> np.ndarray:
    made = np.zeros((classes, SIX + 1))
    for tree in trees:
        width = tree["value"].shape[1]
        made[tree["classes"]] += enumerated([{**tree, "classes": slice(0, width)}], x, width)
    return made
