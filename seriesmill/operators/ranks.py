"""Cut points of an order, found by counting instead of sorting the rows.

A split needs to know which row is number 0.7 n, not the number of every row.
The order columns are walked one at a time: count the rows per value, find the
value that holds the wanted rank, go on inside it.  The wide rows are then told
apart by comparing them with the cut, without any shuffle.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesmill.functions.columns import before, from_sortable, sortable
from seriesmill.session import SMALL_ROWS, materialise

_DAY_MICROS = 86_400_000_000


def _locate(counts: DataFrame, ranks: Sequence[int]) -> list[tuple[object, int, int]]:
    """For each 0-based rank: the value of column ``v`` that holds it, the rank inside it, its rows."""
    by = F.col("v").asc_nulls_last()
    head = counts.orderBy(by).limit(SMALL_ROWS + 1).collect()
    if len(head) <= SMALL_ROWS:
        return _bisect(head, ranks)
    placed = materialise(
        counts.repartitionByRange(by).withColumn("_part", F.spark_partition_id()), "counts"
    )
    parts = placed.groupBy("_part").agg(F.sum("n").alias("n")).orderBy("_part").collect()
    found = []
    for part, rest, _ in _bisect([(p["_part"], p["n"]) for p in parts], ranks):
        running = F.sum("n").over(Window.orderBy(by).rowsBetween(Window.unboundedPreceding, 0))
        row = (
            placed.where(F.col("_part") == part)
            .withColumn("upto", running)
            .where((F.col("upto") > rest) & (F.col("upto") - F.col("n") <= rest))
            .first()
        )
        found.append((row["v"], rest - (row["upto"] - row["n"]), row["n"]))
    return found


def _bisect(rows: Sequence, ranks: Sequence[int]) -> list[tuple[object, int, int]]:
    ends = list(accumulate(r[1] for r in rows))
    found = []
    for rank in ranks:
        i = bisect_right(ends, rank)
        found.append((rows[i][0], rank - (ends[i] - rows[i][1]), rows[i][1]))
    return found


def _levels(df: DataFrame, names: Sequence[str]) -> list[tuple[int, Column]]:
    """Counting levels: each order column, a time one by day first; with the column's place."""
    levels = []
    for i, name in enumerate(names):
        value = sortable(df, name)
        if isinstance(df.schema[name].dataType, (T.TimestampType, T.TimestampNTZType)):
            levels.append((-1, F.floor(value / F.lit(_DAY_MICROS))))
        levels.append((i, value))
    return levels


def keys_at(df: DataFrame, names: Sequence[str], fractions: Sequence[float]) -> list[list | None]:
    """Order key of row floor(n * f) for every f; None where that is past the end."""
    levels = _levels(df, names)
    narrow = df.select(*names)
    counts = materialise(
        narrow.groupBy(levels[0][1].alias("v")).agg(F.count(F.lit(1)).alias("n")), "counts"
    )
    total = counts.agg(F.sum("n")).first()[0] or 0
    ranks = [int(total * f) for f in fractions]
    if not total:
        return [None] * len(ranks)
    inside = [r for r in ranks if r < total]
    starts = _locate(counts, inside)
    cuts = {r: _descend(narrow, names, levels, start) for r, start in zip(inside, starts, strict=True)}
    return [cuts.get(r) for r in ranks]


def _descend(narrow: DataFrame, names: Sequence[str], levels: list, start: tuple) -> list:
    value, rest, n = start
    known: list = [None] * len(names)
    rows = narrow
    for depth, (place, column) in enumerate(levels):
        if depth:
            value, rest, n = _locate(
                rows.groupBy(column.alias("v")).agg(F.count(F.lit(1)).alias("n")), [rest]
            )[0]
        rows = rows.where(column.eqNullSafe(F.lit(value)))
        if place >= 0:
            known[place] = value
        if n <= SMALL_ROWS:
            left = rows.select(*[sortable(narrow, c).alias(f"k{i}") for i, c in enumerate(names)])
            ordered = sorted(left.collect(), key=lambda r: [(x is None, x) for x in r])
            return list(ordered[rest])
    return known


def rows_before(df: DataFrame, names: Sequence[str], cut: list | None) -> Column:
    """Whether a row sorts before the cut; all do if the cut is past the end.

    As a filter, its first part is simple enough for the scan to skip row groups
    and, on a window key, to pass below the window.
    """
    if cut is None:
        return F.lit(True)
    inside = before([sortable(df, n) for n in names], cut)
    if cut[0] is None:
        return inside
    return (F.col(names[0]) <= from_sortable(df, names[0], cut[0])) & inside


def label_by_cuts(
    df: DataFrame, names: Sequence[str], cuts: Sequence[list | None], labels: Sequence[str]
) -> Column:
    """Name of the stretch of the order that a row falls in; ``labels`` has one more entry than cuts.

    Rows equal in all order columns stay on one side of a cut.
    """
    result = F.lit(labels[-1])
    for cut, label in reversed(list(zip(cuts, labels))):
        result = F.when(rows_before(df, names, cut), F.lit(label)).otherwise(result)
    return result
