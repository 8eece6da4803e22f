"""Per-class decision thresholds.

With the other thresholds fixed, class c wins a row for a prefix of the rising
grid, since its score p/t only falls.  One pass therefore records, per row, the
length of that prefix and the class that wins afterwards; the small table of
their counts holds the confusion counts of every grid point.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesmill.functions.columns import share
from seriesmill.operators.evaluate import f1_summary
from seriesmill.session import materialise

LOWEST = 1e-6
GRID_START, GRID_END = 0.01, 1.0


def grid(steps: int) -> list[float]:
    """Evenly spaced thresholds, both ends included."""
    step = (GRID_END - GRID_START) / (steps - 1)
    return [GRID_START + i * step for i in range(steps - 1)] + [GRID_END]


def clipped(t: float) -> float:
    return min(max(t, LOWEST), 1.0)


def scores(p: Column, thresholds: Sequence[float | None]) -> Column:
    """Probability over threshold per class; a class without threshold keeps its probability."""
    t = F.array(*[F.lit(1.0 if v is None else clipped(v)) for v in thresholds])
    return F.zip_with(p, t, lambda x, y: x / y)


def first_best(values: Column) -> Column:
    """0-based place of the largest entry, the first of equals."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def decide(p: Column, thresholds: Sequence[float | None]) -> Column:
    return first_best(scores(p, thresholds))


def argmax(p: Column) -> Column:
    return first_best(p)


def _prefix_counts(
    df: DataFrame, y: str, p: str, index: int, thresholds: Sequence[float | None], points: Sequence[float]
) -> DataFrame:
    """Rows per (prefix length ``k``, actual ``y``, winner after it ``j``)."""
    rivals = F.transform(
        scores(F.col(p), thresholds),
        lambda x, i: F.when(i == index, F.lit(float("-inf"))).otherwise(x),
    )
    return (
        df.select(F.col(y).alias("y"), F.col(p)[index].alias("_p"), rivals.alias("_r"))
        .select("y", "_p", F.array_max("_r").alias("_s"), first_best(F.col("_r")).alias("j"))
        .withColumn("_at", _near(points))
        .select("y", "j", _prefix_length(index, points).alias("k"))
        .groupBy("k", "y", "j")
        .agg(F.count(F.lit(1)).alias("n"))
    )


_NEAR = 5  # grid points compared exactly around the estimated end of the prefix


def _near(points: Sequence[float]) -> Column:
    """First of the points to compare: the prefix ends near p/s on the even grid."""
    last = max(0, len(points) - _NEAR)
    step = (points[-1] - points[0]) / (len(points) - 1)
    cell = F.floor((F.try_divide("_p", "_s") - F.lit(points[0])) / F.lit(step))
    return F.greatest(F.lit(0), F.least(cell - 1, F.lit(last))).cast("int")


def _prefix_length(index: int, points: Sequence[float]) -> Column:
    """Number of grid points at which the class wins, decided on the scores themselves.

    Against a rival score of zero or less the answer is the same at every point.
    """
    values = F.array(*[F.lit(clipped(t)) for t in points])

    def wins(t: Column) -> Column:
        mine = F.col("_p") / t
        return (mine > F.col("_s")) | ((mine == F.col("_s")) & (F.lit(index) < F.col("j")))

    near = [wins(F.get(values, F.col("_at") + i)) for i in range(min(_NEAR, len(points)))]
    counted = F.col("_at") + sum((w.cast("int") for w in near[1:]), near[0].cast("int"))
    constant = F.when(wins(F.lit(clipped(points[0]))), F.lit(len(points))).otherwise(F.lit(0))
    return F.when(F.col("_s") > 0, counted).otherwise(constant)


def _grid_cells(counts: DataFrame, index: int, points: Sequence[float]) -> DataFrame:
    """Confusion counts per grid point, from the prefix table."""
    steps = F.array(
        *[F.struct(F.lit(i).alias("step"), F.lit(t).alias("threshold")) for i, t in enumerate(points)]
    )
    return (
        counts.select("*", F.inline(steps))
        .groupBy(
            "step",
            "threshold",
            F.col("y").alias("actual"),
            F.when(F.col("step") < F.col("k"), F.lit(index)).otherwise(F.col("j")).alias("predicted"),
        )
        .agg(F.sum("n").alias("n"))
    )


def sweep(
    df: DataFrame, y: str, p: str, index: int, thresholds: Sequence[float | None], steps: int = 50
) -> DataFrame:
    """Macro F1 at every grid point of one class: ``step, threshold, f1_macro``."""
    points = grid(steps)
    cells = _grid_cells(_prefix_counts(df, y, p, index, thresholds, points), index, points)
    return f1_summary(cells, ["step", "threshold"]).select("step", "threshold", "f1_macro")


def curve(
    df: DataFrame, y: str, p: str, index: int, thresholds: Sequence[float | None], steps: int = 80
) -> DataFrame:
    """Precision, recall and F1 of one class at every grid point."""
    points = grid(steps)
    cells = _grid_cells(_prefix_counts(df, y, p, index, thresholds, points), index, points)
    mine, said = F.col("actual") == index, F.col("predicted") == index
    return (
        cells.groupBy("step", "threshold")
        .agg(
            F.sum(F.when(mine & said, F.col("n")).otherwise(0)).alias("tp"),
            F.sum(F.when(mine, F.col("n")).otherwise(0)).alias("support"),
            F.sum(F.when(said, F.col("n")).otherwise(0)).alias("said"),
        )
        .select(
            "step",
            "threshold",
            share(F.col("tp"), F.col("said")).alias("precision"),
            share(F.col("tp"), F.col("support")).alias("recall"),
            share(2 * F.col("tp"), F.col("support") + F.col("said")).alias("f1"),
        )
    )


def priors(df: DataFrame, y: str, classes: int) -> list[float]:
    """Class shares as starting thresholds; uniform for a class without rows."""
    n = {r["y"]: r["n"] for r in df.groupBy(F.col(y).alias("y")).agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(n.values())
    return [n[c] / total if c in n else 1.0 / classes for c in range(classes)]


def tune(df: DataFrame, y: str, p: str, classes: int, steps: int = 50) -> list[float]:
    """Search class by class for the threshold with the best macro F1, first best wins.

    ``y`` is the label index.  The probabilities are written once, each class is
    one pass over them, and only its ``steps`` scores reach the driver.
    """
    rows = materialise(df.select(y, p), "probabilities")
    best = priors(rows, y, classes)
    for index in range(classes):
        found = sweep(rows, y, p, index, best, steps).collect()
        top = min(found, key=lambda r: (-r["f1_macro"], r["step"]), default=None)
        if top is not None:
            best[index] = top["threshold"]
    return best
