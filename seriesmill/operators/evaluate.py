"""Scores of a classifier, all derived from its confusion counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesmill.functions.columns import share
from seriesmill.operators.slices import attach, bounded


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weights: rows / (classes * rows of the class)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    every = Window.partitionBy()
    weight = F.sum("n").over(every) / (F.count(F.lit(1)).over(every) * F.col("n"))
    return counts.withColumn("weight", weight)


def with_weights(df: DataFrame, label: str, column: str = "weight") -> DataFrame:
    weights = bounded(class_weights(df, label).select(label, F.col("weight").alias(column)))
    return attach(df, weights, [label])


def counts(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """The one pass over the rows: ``by``, ``actual``, ``predicted``, ``n``."""
    return df.groupBy(*by, F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )


def confusion(cells: DataFrame, classes: Sequence, by: Sequence[str] = (), epsilon: float = 0.0) -> DataFrame:
    """Counts and row percentages over the whole grid of ``classes``."""
    kind = cells.schema["actual"].dataType
    grid = F.array(*[F.lit(c).cast(kind) for c in classes])
    frame = (
        cells.select(*by).distinct()
        if by
        else cells.agg(F.count(F.lit(1)).alias("_any")).select()
    )
    full = frame.select("*", F.explode(grid).alias("actual")).select("*", F.explode(grid).alias("predicted"))
    filled = attach(full, cells, [*by, "actual", "predicted"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    row = F.sum("n").over(Window.partitionBy(*by, "actual"))
    return filled.withColumn("pct", share(F.col("n") * 100.0, row + F.lit(epsilon)))


def per_class(cells: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """True positives, support and predicted rows of every label seen on either side."""
    sides = F.array(
        F.struct(F.col("actual").alias("class"), F.lit(True).alias("is_actual")),
        F.struct(F.col("predicted").alias("class"), F.lit(False).alias("is_actual")),
    )
    hit = F.col("is_actual") & F.col("actual").eqNullSafe(F.col("predicted"))
    return (
        cells.select("*", F.inline(sides))
        .groupBy(*by, "class")
        .agg(
            F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("tp"),
            F.sum(F.when(F.col("is_actual"), F.col("n")).otherwise(0)).alias("support"),
            F.sum(F.when(~F.col("is_actual"), F.col("n")).otherwise(0)).alias("n_predicted"),
        )
    )


def _with_scores(table: DataFrame) -> DataFrame:
    return table.withColumns(
        {
            "precision": share(F.col("tp"), F.col("n_predicted")),
            "recall": share(F.col("tp"), F.col("support")),
            # equals the harmonic mean of the two above, and zero when both are
            "f1": share(2 * F.col("tp"), F.col("support") + F.col("n_predicted")),
        }
    )


def class_report(cells: DataFrame, classes: Sequence | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support per class, over ``classes`` if given."""
    table = per_class(cells, by)
    if classes is not None:
        kind = cells.schema["actual"].dataType
        grid = F.array(*[F.lit(c).cast(kind) for c in classes])
        frame = cells.select(*by).distinct() if by else cells.agg(F.count(F.lit(1)).alias("_any")).select()
        full = frame.select("*", F.explode(grid).alias("class"))
        table = attach(full, table, [*by, "class"], "left").na.fill(0, ["tp", "support", "n_predicted"])
    return _with_scores(table)


def f1_summary(cells: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, macro F1 over labels seen on either side, and support-weighted F1."""
    return (
        _with_scores(per_class(cells, by))
        .groupBy(*by)
        .agg(
            share(F.sum("tp"), F.sum("support")).alias("accuracy"),
            F.avg("f1").alias("f1_macro"),
            share(F.sum(F.col("f1") * F.col("support")), F.sum("support")).alias("f1_weighted"),
        )
    )


def compare_decisions(df: DataFrame, actual: str, decisions: Sequence[str]) -> DataFrame:
    """Confusion counts of several decision columns in one pass, told apart by ``decision``."""
    pairs = F.array(*[F.struct(F.lit(d).alias("decision"), F.col(d).alias("chosen")) for d in decisions])
    return counts(df.select(actual, F.inline(pairs)), actual, "chosen", ["decision"])


def evaluate_pair(df: DataFrame, actual: str, baseline: str, tuned: str) -> DataFrame:
    """Scores of the plain and the tuned decision side by side, with the gain in macro F1."""
    scores = f1_summary(compare_decisions(df, actual, [baseline, tuned]), ["decision"])

    def pick(name: str, column: str):
        return F.max(F.when(F.col("decision") == name, F.col(column)))

    made = {
        f"{side}_{column}": pick(name, column)
        for side, name in (("baseline", baseline), ("tuned", tuned))
        for column in ("accuracy", "f1_weighted", "f1_macro")
    }
    return scores.agg(*[c.alias(n) for n, c in made.items()]).withColumn(
        "delta_f1_macro", F.col("tuned_f1_macro") - F.col("baseline_f1_macro")
    )
