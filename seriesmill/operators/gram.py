"""Correlations of many columns at once, from blockwise sums of products.

For every pair the rows where both columns are known count.  With X the values (0 where missing) and M the marks of what is known,
the four matrices M'M, X'M, (X*X)'M and X'X hold all that a correlation needs.  Every task adds them up for its rows,
in blocks of BLOCK columns against all; blocks meet in a shuffle and are added up there, one number a pair reaches the driver.
One aggregate a pair would be 9,180 of them for 136 columns.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 32
_SUMS = "block int, sums binary"


def corr_of_many(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``a``, ``b``, ``corr`` for every ordered pair of columns: null where a column does not vary on their common rows.

    Values are taken less their column's mean, so that large values with a small spread keep their digits.
    """
    names = list(names)
    means = df.select(*[F.avg(F.col(n).cast("double")).alias(f"m{i}") for i, n in enumerate(names)]).first()
    center = np.array([0.0 if m is None else m for m in means])
    blocks = range(0, len(names), BLOCK)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {b: np.zeros((4, len(names[b : b + BLOCK]), len(names))) for b in blocks}
        for batch in batches:
            x = np.stack([np.asarray(c.cast(pa.float64()).fill_null(np.nan)) for c in batch.columns], axis=1) - center
            known = ~np.isnan(x)
            x = np.where(known, x, 0.0)
            marks = known.astype(np.float64)
            for b, made in sums.items():
                mine, shown = x[:, b : b + BLOCK].T, marks[:, b : b + BLOCK].T
                made += np.stack((shown @ marks, mine @ marks, (mine * mine) @ marks, mine @ x))
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], names=["block", "sums"])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, raw in zip(batch.column("block").to_pylist(), batch.column("sums").to_pylist()):
                held[block] = held.get(block, 0.0) + np.frombuffer(raw, dtype=np.float64)
        for block, made in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([made.tobytes()], pa.binary())], names=["block", "sums"])

    found = df.select(*[F.col(n).cast("double").alias(f"c{i}") for i, n in enumerate(names)]).mapInArrow(part, _SUMS)
    whole = found.repartition(len(blocks), "block").mapInArrow(total, _SUMS).toArrow().to_pylist()
    return _cells(df, names, {r["block"]: np.frombuffer(r["sums"], dtype=np.float64) for r in whole})


def _cells(df: DataFrame, names: list[str], sums: dict[int, np.ndarray]) -> DataFrame:
    """The correlations as rows; the sums of all columns are as many numbers as there are pairs."""
    size = len(names)
    n, x, xx, xy = np.concatenate([sums[b].reshape(4, -1, size) for b in sorted(sums)], axis=1) if sums else np.zeros((4, size, size))
    with np.errstate(divide="ignore", invalid="ignore"):
        spread = xx - x * x / n
        # what rounding leaves of a constant column is no spread
        spread = np.where(spread > 1e-14 * xx, spread, 0.0)
        corr = (xy - x * x.T / n) / np.sqrt(spread * spread.T)
    np.fill_diagonal(corr, np.where(np.diag(spread) > 0, 1.0, np.nan))
    rows = [(a, b, float(corr[i, j]) if np.isfinite(corr[i, j]) else None) for i, a in enumerate(names) for j, b in enumerate(names)]
    return df.sparkSession.createDataFrame(rows, "a string, b string, corr double")
