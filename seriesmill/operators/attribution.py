"""Shapley values of tree ensembles, per row and class, and their summaries.

A tree's output for a known subset of features is the mean of its leaves over the rows that training saw, as far as
unknown features are concerned: at a split on an unknown feature both branches count by their cover.  A feature's Shapley
value is its mean contribution over all orders in which features become known.

A leaf counts for a subset with the product, over the features on its path, of 1 or 0 (known: does the row
stay on the path?) or the covered share (unknown).  Grouped by the size of the subset these products are the
coefficients of a polynomial, one factor per feature of the path, so no subset is enumerated: a leaf with m features costs m^2 steps, once for every
pattern of features that stay on the path, whatever the number of rows.  The root value (the mean
output over the training rows) plus a row's values is the model's output for it.

A tree only compares: rows between the same two thresholds in every feature have the same values.  So values are computed once per *cell*, a
combination of such intervals that occurs, and joined to its rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seriesmill.functions.columns import display_name, finite_or_zero, sensor_of, share
from seriesmill.operators.model import EventModel
from seriesmill.operators.profile import with_label_text
from seriesmill.operators.slices import bounded
from seriesmill.session import materialise, scratch_path
from seriesmill.spec import OTHER_SENSOR

_BATCH = 4_096
_LEAST = 256  # cells that are worth a task
# Most bytes of trees in one broadcast; more trees go in several, and their values are added up.
BROADCAST_BYTES = 256 << 20


def _node_arrays(rows: pd.DataFrame, classes: int, weight: float) -> dict:
    """One tree of a forest: leaves hold the shares of the classes among their weighted rows."""
    rows = rows.sort_values("id")
    stats = np.stack(rows["impurityStats"].to_numpy())
    values = np.zeros((len(rows), classes))
    values[:, : stats.shape[1]] = weight * stats / stats.sum(axis=1, keepdims=True)
    split = rows["split"].to_list()
    cut = [s["leftCategoriesOrThreshold"] for s in split]
    return {
        "classes": slice(0, classes),
        "left": rows["leftChild"].to_numpy(dtype=np.int32),
        "right": rows["rightChild"].to_numpy(dtype=np.int32),
        "feature": np.array([s["featureIndex"] for s in split], dtype=np.int32),
        "threshold": np.array([c[0] if len(c) else 0.0 for c in cut]),
        "value": values,
        "cover": stats.sum(axis=1),
    }


def _trees(spark: SparkSession, model: EventModel) -> list[dict]:
    """Every tree as arrays."""
    if model.kind == "boosted":
        return [
            {
                "classes": slice(k, k + 1),
                "value": tree.value[:, None],
                **{n: getattr(tree, n) for n in ("left", "right", "feature", "threshold", "cover")},
            }
            for trees in model.fitted.trees
            for k, tree in enumerate(trees)
        ]
    path = scratch_path(spark, "model")
    model.fitted.write().save(path)
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    count = model.fitted.getNumTrees
    return [_node_arrays(nodes.where(F.col("treeID") == t).toPandas(), len(model.labels), 1.0 / count) for t in range(count)]


def _leaves(tree: dict) -> list[tuple]:
    """Per leaf: its node, the features on its path, the interval (low, high] each must lie in, and the share each covers."""
    found, todo = [], [(0, {})]
    while todo:
        node, path = todo.pop()
        if tree["left"][node] < 0:
            names = np.array(list(path), dtype=np.int64)
            low, high, part = (np.array([path[f][i] for f in path]) for i in range(3))
            found.append((node, names, low, high, part))
            continue
        f, cut = int(tree["feature"][node]), tree["threshold"][node]
        low, high, part = path.get(f, (-np.inf, np.inf, 1.0))
        for child, edges in ((tree["left"][node], (low, min(high, cut))), (tree["right"][node], (max(low, cut), high))):
            todo.append((child, {**path, f: (*edges, part * tree["cover"][child] / tree["cover"][node])}))
    return found


def _path_weights(stays: np.ndarray, part: np.ndarray) -> np.ndarray:
    """Shapley values of a leaf of value 1, for every pattern (row) of features that stay on its path."""
    n, m = stays.shape
    whole = np.zeros((n, m + 1))
    whole[:, 0] = 1.0
    for j in range(m):
        shifted = np.zeros_like(whole)
        shifted[:, 1:] = whole[:, :-1] * stays[:, j : j + 1]
        whole = whole * part[j] + shifted
    sizes = np.array([factorial(k) * factorial(m - 1 - k) / factorial(m) for k in range(m)])
    # a feature off the path: its own factor is its share, which its contribution has too
    off = -(whole[:, :m] @ sizes)
    made = np.empty((n, m))
    for i in range(m):
        # the other features' polynomial, dividing by (share + x) from the top
        rest, carry = np.zeros((n, m)), np.zeros(n)
        for k in range(m, 0, -1):
            carry = whole[:, k] - part[i] * carry
            rest[:, k - 1] = carry
        made[:, i] = np.where(stays[:, i], (1.0 - part[i]) * (rest @ sizes), off)
    return made


def shapley(x: np.ndarray, trees: list[dict], classes: int) -> np.ndarray:
    """Values of shape rows x classes x (features + 1); the last entry is the root value."""
    n, f = x.shape
    made = np.zeros((f + 1, n, classes))
    for tree in trees:
        for node, names, low, high, part in _leaves(tree):
            value = tree["value"][node]
            made[f, :, tree["classes"]] += value * part.prod()
            if not len(names):
                continue
            stays = (x[:, names] > low) & (x[:, names] <= high)
            if len(names) <= 62:
                code = stays @ (np.int64(1) << np.arange(len(names), dtype=np.int64))
                _, first, back = np.unique(code, return_index=True, return_inverse=True)
                weights = _path_weights(stays[first], part)[back]
            else:
                weights = _path_weights(stays, part)
            for j, name in enumerate(names):
                made[name, :, tree["classes"]] += weights[:, j : j + 1] * value
    return made.transpose(1, 2, 0)


def _grouped(trees: list[dict]) -> list[list[dict]]:
    """The trees in groups that are small enough to be sent to every executor."""
    groups, held = [[]], 0
    for tree in trees:
        size = sum(x.nbytes for x in tree.values() if isinstance(x, np.ndarray))
        if groups[-1] and held + size > BROADCAST_BYTES:
            groups.append([])
            held = 0
        groups[-1].append(tree)
        held += size
    return groups


def attribute(df: DataFrame, model: EventModel, keep: Sequence[str], long: bool = True) -> DataFrame:
    """Long table: ``keep``, ``class``, ``feature``, ``value``, and ``root_value``, the same for all features of a class.

    Unless ``long``, one row for each of ``df`` with these four in the structs of ``_values``: what is asked per row then needs no shuffle.

    A class's root value and the values of all its features add up to the model's output for it: the probability of a
    forest, the margin of a boosted model.
    """
    trees = _trees(df.sparkSession, model)
    placed = _placed(df, model, keep, cuts_of(trees, len(model.features)))
    found = placed.join(_cells(placed, model, trees), "_cell").select(*keep, "_values")
    return found.select(*keep, F.inline("_values")) if long else found


def cuts_of(trees: list[dict], features: int) -> list[np.ndarray]:
    """Per feature the thresholds of all trees, rising."""
    inner = [(t["feature"][t["left"] >= 0], t["threshold"][t["left"] >= 0]) for t in trees]
    return [np.unique(np.concatenate([cut[f == i] for f, cut in inner])) if inner else np.empty(0) for i in range(features)]


def _placed(df: DataFrame, model: EventModel, keep: Sequence[str], cuts: list[np.ndarray]) -> DataFrame:
    """``keep`` and ``_cell``: per feature how many thresholds lie below its value, as 32-bit integers."""

    @F.pandas_udf("binary")
    def cell(*values: pd.Series) -> pd.Series:
        places = np.stack([np.searchsorted(cut, v.to_numpy(), side="left") for cut, v in zip(cuts, values)], axis=1)
        raw, width = places.astype(np.int32).tobytes(), 4 * len(cuts)
        return pd.Series([raw[i : i + width] for i in range(0, len(raw), width)], dtype=object)

    return df.select(*keep, cell(*[finite_or_zero(F.col(f)).cast("double") for f in model.features]).alias("_cell"))


def _cells(placed: DataFrame, model: EventModel, trees: list[dict]) -> DataFrame:
    """Every cell that occurs, with ``_values``: class, feature, value and root value."""
    spark = placed.sparkSession
    classes, features = len(model.labels), len(model.features)
    # a value of the cell: its upper threshold, beyond the last one infinity
    tops = [np.append(c, np.inf) for c in cuts_of(trees, features)]

    def part(group: list[dict]):
        sent = spark.sparkContext.broadcast(group)

        @F.pandas_udf("array<double>")
        def values(cells: pd.Series) -> pd.Series:
            out = []
            for start in range(0, len(cells), _BATCH):
                places = np.frombuffer(b"".join(cells.iloc[start : start + _BATCH]), dtype=np.int32).reshape(-1, features)
                x = np.stack([top[places[:, i]] for i, top in enumerate(tops)], axis=1)
                out.extend(shapley(x, sent.value, classes).reshape(len(x), -1))
            return pd.Series(out, dtype=object)

        return values("_cell")

    found = materialise(placed.select("_cell").distinct(), "cells")
    count = found.count()
    tasks = max(-(-count // _BATCH), min(spark.sparkContext.defaultParallelism, -(-count // _LEAST)), 1)
    flat = reduce(lambda a, b: F.zip_with(a, b, lambda x, y: x + y), [part(group) for group in _grouped(trees)])
    entry = []
    for k, label in enumerate(model.labels):
        at, start = k * (features + 1), float(model.fitted.start[k]) if model.kind == "boosted" else 0.0
        for i, name in enumerate(model.features):
            value, root = F.col("_c")[at + i], F.col("_c")[at + features] + F.lit(start)
            entry.append(F.struct(F.lit(label).alias("class"), F.lit(name).alias("feature"), value.alias("value"), root.alias("root_value")))
    made = found.repartition(tasks).select("_cell", flat.alias("_c"))
    return materialise(made.select("_cell", F.array(*entry).alias("_values")), "cell-values")


def top_features(table: DataFrame, score: str, n: int) -> DataFrame:
    """The n features with the highest score; of equals, the first name."""
    return table.orderBy(F.col(score).desc(), "feature").limit(n)


def global_importance(values: DataFrame) -> DataFrame:
    """Mean absolute value of each feature over rows and classes."""
    return values.groupBy("feature").agg(F.avg(F.abs("value")).alias("mean_abs"))


def class_importance(values: DataFrame) -> DataFrame:
    return values.groupBy("class", "feature").agg(F.avg(F.abs("value")).alias("mean_abs"))


def top_per_class(by_class: DataFrame, n: int = 10) -> DataFrame:
    w = Window.partitionBy("class").orderBy(F.col("mean_abs").desc(), "feature")
    return by_class.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def sensor_importance(overall: DataFrame, sensors: Sequence[str]) -> DataFrame:
    """Sum of the importances of each sensor's features and its share in percent."""
    totals = (
        overall.withColumn("sensor", sensor_of(F.col("feature"), sensors))
        .where(F.col("sensor") != OTHER_SENSOR)
        .groupBy("sensor")
        .agg(F.sum("mean_abs").alias("importance"))
    )
    return totals.withColumn(
        "pct", share(F.col("importance") * 100.0, F.sum("importance").over(Window.partitionBy()))
    )


def sensor_by_class(by_class: DataFrame, sensors: Sequence[str]) -> DataFrame:
    """Share of each sensor inside every class in percent; a class without importance has zeros."""
    totals = (
        by_class.withColumn("sensor", sensor_of(F.col("feature"), sensors))
        .where(F.col("sensor") != OTHER_SENSOR)
        .groupBy("class", "sensor")
        .agg(F.sum("mean_abs").alias("importance"))
    )
    whole = F.sum("importance").over(Window.partitionBy("class"))
    return totals.withColumn("pct", share(F.col("importance") * 100.0, whole))


def sensor_class_matrix(shares: DataFrame, sensors: Sequence[str], classes: Sequence) -> DataFrame:
    """One row per sensor, one column per class."""
    return shares.where(F.col("sensor").isin(*sensors)).groupBy("sensor").pivot("class", list(classes)).agg(F.first("pct")).na.fill(0.0)


def attribution_report(values: DataFrame, sensors: Sequence[str], n: int = 10) -> DataFrame:
    """Per class: its top features with sensor and value, rounded as in the report, and the sensor's share."""
    by_class = bounded(class_importance(values))
    shares = sensor_by_class(by_class, sensors).select(
        "class", "sensor", F.round("pct", 1).alias("sensor_pct")
    )
    top = top_per_class(by_class, n).select(
        "class",
        "rank",
        display_name(F.col("feature")).alias("name"),
        "feature",
        sensor_of(F.col("feature"), sensors).alias("sensor"),
        F.round("mean_abs", 6).alias("mean_abs"),
    )
    return top.join(shares, ["class", "sensor"], "left")


def attribution_json(report: DataFrame) -> DataFrame:
    """One JSON document per class: its top features."""
    entry = F.struct("rank", "feature", "sensor", "mean_abs")
    return report.groupBy("class").agg(F.to_json(F.sort_array(F.collect_list(entry))).alias("top_features"))


def attribution_document(values: DataFrame, sensors: Sequence[str], labels: DataFrame, label: str = "class", n: int = 10) -> DataFrame:
    """The whole report as one JSON document.

    Per class its name, top features and the share of each sensor; the share of each sensor over all classes; how many
    rows and features the attributions cover.
    """
    by_class = bounded(class_importance(values))
    top = attribution_report(values, sensors, n)
    tops = top.groupBy("class").agg(F.sort_array(F.collect_list(F.struct("rank", "feature", "sensor", "mean_abs"))).alias("top_features"))
    shares = sensor_by_class(by_class, sensors).groupBy("class").agg(_shares())
    named = with_label_text(tops.join(shares, "class", "left").withColumnRenamed("class", label), labels, label)
    by_label = lambda x, y: F.when(x[label] < y[label], -1).when(x[label] > y[label], 1).otherwise(0)
    classes = named.agg(F.array_sort(F.collect_list(F.struct(*named.columns)), by_label).alias("classes"))
    overall = sensor_importance(bounded(global_importance(values)), sensors).agg(_shares())
    counts = values.groupBy("feature", "class").agg(F.count(F.lit(1)).alias("n")).agg(
        F.max("n").alias("rows"), F.count_distinct("feature").alias("features")
    )
    one = classes.crossJoin(overall).crossJoin(counts)  # three one-row tables
    return one.select(F.to_json(F.struct("classes", "sensor_pct", "rows", "features")).alias("document"))


def _shares():
    entry = F.struct(F.col("sensor").alias("key"), F.round("pct", 1).alias("value"))
    return F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("sensor_pct")
