"""Ordered per-key work that stays bounded when one key holds most of the rows.

A plain window puts all rows of a key into one task.  Keys above
``max_rows_per_task`` are therefore cut: their rows are range-partitioned by
(key, order), written to the shared folder with their position, and every
partition falls into *slices* of at most that many rows.  A look-back window
needs only the last rows of the slices before it (copied in, and dropped after),
a fill only the last value before it, a row number only the rows counted before
it; so results equal those of the plain window.  All other keys use the plain
window, and when no key is hot that is all that runs.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from seriesmill.session import SMALL_ROWS, materialise

# Most range partitions of one shuffle; more slices than these share partitions.
MOST_PARTITIONS = 50_000
# Rows that a range partition should hold at least, once there are enough partitions for all cores: each sends a sample of keys to the driver.
PARTITION_ROWS = 100_000
_ROW_BITS = 33  # monotonically_increasing_id counts the rows of a partition in these


@dataclass
class Carved:
    """Rows of ordinary keys, and the sliced rows of hot keys if there are any."""

    cold: DataFrame
    hot: DataFrame | None = None
    slices: DataFrame | None = None


def attach(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on null-safe key equality, keeping one copy of the keys."""
    renamed = right.withColumnsRenamed({k: f"__{k}" for k in keys})
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"__{k}"))
    joined = left.join(F.broadcast(renamed) if _is_hinted(right) else renamed, condition, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"__{k}" for k in keys])


def _is_hinted(df: DataFrame) -> bool:
    return getattr(df, "_small_side", False)


def hinted(df: DataFrame) -> DataFrame:
    """Mark a frame of proven small size for a broadcast by :func:`attach`."""
    df._small_side = True
    return df


def bounded(df: DataFrame, cap: int = SMALL_ROWS) -> DataFrame:
    """A frame whose size was checked, marked for broadcast; unchanged above ``cap`` rows."""
    rows = df.limit(cap + 1).collect()
    if len(rows) > cap:
        return df
    return hinted(df.sparkSession.createDataFrame(rows, df.schema))


def carve(df: DataFrame, keys: Sequence[str], order: Sequence[Column], max_rows: int) -> Carved:
    """Part the hot keys from the others, and cut them.

    Hot keys and slices are written tables, joined by broadcast only where they prove small.  A range partition with more
    than ``max_rows`` rows holds several slices, so slices stay small however few the partitions are.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > max_rows)
    found = materialise(counts, "hot-keys")
    total = found.agg(F.sum("_n")).first()[0]
    if not total:
        return Carved(df)
    named = bounded(found.select(*keys))
    cold, rows = attach(df, named, keys, "left_anti"), attach(df, named, keys, "left_semi")
    enough = max(ceil(total / PARTITION_ROWS), df.sparkSession.sparkContext.defaultParallelism)
    parts = min(ceil(total / max_rows), enough, MOST_PARTITIONS)
    by = [*[F.col(k).asc_nulls_last() for k in keys], *order, F.col("_source").asc()]
    placed = (
        # the source partition parts rows that are equal in every ordering column
        rows.withColumn("_source", F.spark_partition_id())
        .repartitionByRange(parts, *by)
        .sortWithinPartitions(*by)
        .drop("_source")
        .withColumn("_pos", F.monotonically_increasing_id())
        # the position of the slice's first row
        .withColumn("_slice", F.col("_pos") - F.col("_pos").bitwiseAND((1 << _ROW_BITS) - 1) % max_rows)
    )
    hot = materialise(placed, "slices")
    across = Window.partitionBy(*keys).orderBy("_slice")
    slices = (
        hot.groupBy(*keys, "_slice")
        .agg(F.count(F.lit(1)).alias("_len"), F.min("_pos").alias("_first"))
        .withColumn("_start", F.sum("_len").over(across.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("_start", F.coalesce("_start", F.lit(0)))
        .withColumn("_n", F.sum("_len").over(Window.partitionBy(*keys)))
    )
    return Carved(cold, hot, materialise(slices, "slice-table"))


def with_halo(carved: Carved, keys: Sequence[str], lookback: int) -> DataFrame:
    """Sliced rows plus, flagged ``_core`` = false, up to ``lookback`` rows before each slice."""
    ahead = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(1, lookback)
    slices = carved.slices.withColumn(
        "_next", F.collect_list(F.struct(F.col("_slice").alias("s"), F.col("_start").alias("at"))).over(ahead)
    ).withColumn("_next", F.expr(f"filter(_next, t -> t.at < _start + _len + {lookback})"))
    slices = bounded(slices.select(*keys, "_slice", "_first", "_start", "_next"))
    index = F.col("_start") + F.col("_pos") - F.col("_first")
    return (
        attach(carved.hot, slices, [*keys, "_slice"])
        .withColumn("_index", index)
        .withColumn(
            "_target",
            F.explode(
                F.concat(
                    F.array("_slice"),
                    F.expr(f"transform(filter(_next, t -> t.at <= _index + {lookback}), t -> t.s)"),
                )
            ),
        )
        .withColumn("_core", F.col("_target") == F.col("_slice"))
        .drop("_first", "_start", "_next", "_index")
    )


def over_lookback(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    lookback: int,
    add: Callable[[DataFrame, WindowSpec], DataFrame],
    max_rows: int,
) -> DataFrame:
    """``add(df, window)``: the rows plus columns that read at most ``lookback`` rows back in the window."""
    carved = carve(df, keys, order, max_rows)
    plain = add(carved.cold, Window.partitionBy(*keys).orderBy(*order))
    if carved.hot is None:
        return plain
    sliced = Window.partitionBy(*keys, "_target").orderBy("_pos")
    cut = (
        add(with_halo(carved, keys, lookback), sliced)
        .where("_core")
        .drop("_pos", "_slice", "_target", "_core")
    )
    return plain.unionByName(cut)


def fill(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    columns: Sequence[str],
    max_rows: int,
    none_hot: bool = False,
) -> DataFrame:
    """Forward fill, then fill the leading gap with the first known value of the key.

    ``none_hot`` skips the count when the caller knows that no key is hot.
    """
    carved = Carved(df) if none_hot else carve(df, keys, order, max_rows)
    up_to = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*keys).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    plain = carved.cold.withColumns(
        {
            c: F.coalesce(F.last(c, ignorenulls=True).over(up_to), F.first(c, ignorenulls=True).over(whole))
            for c in columns
        }
    )
    if carved.hot is None:
        return plain.select(*df.columns)
    known = {c: F.when(F.col(c).isNotNull(), F.col("_pos")) for c in columns}
    edges = carved.hot.groupBy(*keys, "_slice").agg(
        *[F.max_by(c, known[c]).alias(f"_last_{i}") for i, c in enumerate(columns)],
        *[F.min_by(c, known[c]).alias(f"_head_{i}") for i, c in enumerate(columns)],
    )
    across = Window.partitionBy(*keys).orderBy("_slice")
    past = across.rowsBetween(Window.unboundedPreceding, -1)
    every = across.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carry = bounded(
        edges.select(
            *keys,
            "_slice",
            *[
                F.coalesce(
                    F.last(f"_last_{i}", ignorenulls=True).over(past),
                    F.first(f"_head_{i}", ignorenulls=True).over(every),
                ).alias(f"_carry_{i}")
                for i in range(len(columns))
            ],
        )
    )
    inside = Window.partitionBy(*keys, "_slice").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    cut = attach(carved.hot, carry, [*keys, "_slice"]).withColumns(
        {
            c: F.coalesce(F.last(c, ignorenulls=True).over(inside), F.col(f"_carry_{i}"))
            for i, c in enumerate(columns)
        }
    )
    return plain.select(*df.columns).unionByName(cut.select(*df.columns))


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    max_rows: int,
    number: str = "row_no",
    size: str = "key_rows",
) -> DataFrame:
    """Add the 1-based position of each row inside its key and the rows of the key."""
    carved = carve(df, keys, order, max_rows)
    window = Window.partitionBy(*keys)
    plain = carved.cold.withColumns(
        {
            number: F.row_number().over(window.orderBy(*order)).cast("bigint"),
            size: F.count(F.lit(1)).over(window),
        }
    )
    if carved.hot is None:
        return plain
    cut = (
        attach(carved.hot, bounded(carved.slices), [*keys, "_slice"])
        .withColumn(number, F.col("_start") + F.col("_pos") - F.col("_first") + 1)
        .withColumn(size, F.col("_n"))
    )
    return plain.unionByName(cut.select(*df.columns, number, size))
