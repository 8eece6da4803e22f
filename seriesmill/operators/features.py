"""Rolling, lag and delta features, all in one window pass."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesmill.functions.columns import finite_or_zero, is_finite
from seriesmill.operators.silver import drop_all_null
from seriesmill.operators.slices import over_lookback
from seriesmill.spec import SeriesSpec, safe_name

NULL_POLICIES = ("keep", "drop_any", "zero", "backfill")
STATS = ("mean", "std", "min", "max")
_AGE = "_age"


def rolling_columns(sensor: str, spec: SeriesSpec, w: WindowSpec, stats: Sequence[str]) -> list[Column]:
    c, name = F.col(sensor), safe_name(sensor)
    columns = []
    for size in spec.windows:
        frame = w.rowsBetween(1 - size, 0)
        made = {
            "mean": F.avg(c).over(frame),
            "std": F.coalesce(F.stddev_samp(c).over(frame), F.lit(0.0)),
            "min": F.min(c).over(frame),
            "max": F.max(c).over(frame),
        }
        columns += [made[s].alias(f"{name}_roll_{s}_{size}") for s in stats]
    return columns


def lag_columns(sensor: str, spec: SeriesSpec, w: WindowSpec, backfill: bool = False) -> list[Column]:
    """Values k rows back; with ``backfill`` the first k rows take the first value.

    Back-filling supposes a sensor without inner gaps, as after the fill step.
    """
    c = F.col(sensor)
    columns = []
    for k, name in zip(spec.lags, spec.lag_names(sensor), strict=True):
        steps = [F.lag(c, j).over(w) for j in range(k, 0, -1)]
        columns.append((F.coalesce(*steps, c) if backfill else steps[0]).alias(name))
    return columns


def delta_column(sensor: str, spec: SeriesSpec, w: WindowSpec, backfill: bool = False) -> Column:
    c = F.col(sensor)
    step = c - F.lag(c, 1).over(w)
    return (F.coalesce(step, F.lit(0.0)) if backfill else step).alias(spec.delta_name(sensor))


def _lookback(spec: SeriesSpec) -> int:
    return max([w - 1 for w in spec.windows] + list(spec.lags) + [1])


def _rolled(back: Callable[[int], tuple[np.ndarray, np.ndarray]], size: int, stats: Sequence[str], n: int) -> dict[str, pa.Array]:
    """Statistics of the last ``size`` rows of every row, oldest value first: the steps and the order of Spark's own sums."""
    count, total, mean, m2 = (np.zeros(n) for _ in range(4))
    low, high = np.full(n, np.nan), np.full(n, -np.inf)
    for j in range(size - 1, -1, -1):
        x, known = back(j)
        count += known
        if "mean" in stats:
            total += np.where(known, x, 0.0)
        if "std" in stats:
            gap = x - mean
            step = gap / count
            m2 += np.where(known, gap * (gap - step), 0.0)
            mean += np.where(known, step, 0.0)
        if "min" in stats:
            low = np.fmin(low, np.where(known, x, np.nan))
        if "max" in stats:
            high = np.maximum(high, np.where(known, x, -np.inf))
    none = count == 0
    made = {"mean": total / count, "std": np.where(count > 1, np.sqrt(m2 / (count - 1)), 0.0), "min": low, "max": high}
    return {s: pa.array(made[s], mask=None if s == "std" else none) for s in stats}


def _moving(spec: SeriesSpec, stats: Sequence[str], with_lags: bool, with_delta: bool, backfill: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds the features to batches of rows in window order, whose last column numbers the rows of a key from one.

    All rows of a batch are worked on at once, one step back at a time; the last rows of a batch are kept for the next.
    """
    sensors, windows, lags, reach = spec.sensors, spec.windows, spec.lags if with_lags else (), _lookback(spec)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {s: (np.zeros(reach), np.zeros(reach, dtype=bool)) for s in sensors}
        for batch in batches:
            n = batch.num_rows
            age = batch.column(batch.num_columns - 1).to_numpy() - 1
            inside = [age >= j for j in range(reach + 1)]
            rolled, lagged, deltas = [], [], []
            for s in sensors:
                read = batch.column(batch.schema.get_field_index(s))
                values = np.concatenate((held[s][0], read.to_numpy(zero_copy_only=False)))
                known = np.concatenate((held[s][1], read.is_valid().to_numpy(zero_copy_only=False)))
                held[s] = values[n:].copy(), known[n:].copy()

                def back(j: int) -> tuple[np.ndarray, np.ndarray]:
                    return values[reach - j : reach - j + n], known[reach - j : reach - j + n] & inside[j]

                with np.errstate(all="ignore"):
                    if stats:
                        for size in windows:
                            rolled += _rolled(back, size, stats, n).values()
                    for k in lags:
                        x, there = back(k)
                        for j in range(k - 1, -1, -1) if backfill else ():
                            nearer, known_nearer = back(j)
                            x, there = np.where(there, x, nearer), there | known_nearer
                        lagged.append(pa.array(x, mask=~there))
                    if with_delta:
                        (x, here), (past, there) = back(0), back(1)
                        both = here & there
                        deltas.append(pa.array(np.where(both, x - past, 0.0), mask=None if backfill else ~both))
            columns = [*batch.columns[:-1], *rolled, *lagged, *deltas]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], *map(str, range(len(columns) - batch.num_columns + 1))])

    return run


def _derive(
    df: DataFrame, spec: SeriesSpec, stats: Sequence[str] = (), with_lags: bool = False, with_delta: bool = False, backfill: bool = False
) -> DataFrame:
    """``df`` plus the wanted features.

    One window sorts and numbers the rows of a key.  Frames of the window itself would walk all their rows for every row and
    statistic, so doubles go through numpy, with equal results; sensors of other types keep their type in frames.
    """
    names = [n for s in spec.sensors for n in _rolling_names(s, spec, stats)]
    names += [n for s in spec.sensors for n in spec.lag_names(s)] if with_lags else []
    names += [spec.delta_name(s) for s in spec.sensors] if with_delta else []
    doubles = all(df.schema[s].dataType == T.DoubleType() for s in spec.sensors)

    def add(rows: DataFrame, w: WindowSpec) -> DataFrame:
        if not doubles:
            return rows.select(
                "*",
                *[c for s in spec.sensors for c in rolling_columns(s, spec, w, stats)],
                *[c for s in spec.sensors if with_lags for c in lag_columns(s, spec, w, backfill)],
                *[delta_column(s, spec, w, backfill) for s in spec.sensors if with_delta],
            )
        shape = T.StructType([*rows.schema.fields, *[T.StructField(n, T.DoubleType()) for n in names]])
        numbered = rows.withColumn(_AGE, F.row_number().over(w))
        return numbered.mapInArrow(_moving(spec, stats, with_lags, with_delta, backfill), shape)

    return over_lookback(df, spec.group, spec.order, _lookback(spec), add, spec.max_rows_per_task)


def _rolling_names(sensor: str, spec: SeriesSpec, stats: Sequence[str]) -> list[str]:
    return [f"{safe_name(sensor)}_roll_{s}_{w}" for w in spec.windows for s in stats]


def rolling(df: DataFrame, spec: SeriesSpec, stats: Sequence[str] = STATS) -> DataFrame:
    return _derive(df, spec, stats)


def lags(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    return _derive(df, spec, with_lags=True)


def deltas(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    return _derive(df, spec, with_delta=True)


def with_missing_sensors(df: DataFrame, spec: SeriesSpec, value: float | None = None) -> DataFrame:
    absent = [s for s in spec.sensors if s not in df.columns]
    return df.withColumns({s: F.lit(value).cast("double") for s in absent}) if absent else df


def features(df: DataFrame, spec: SeriesSpec, null_policy: str = "keep") -> DataFrame:
    """Meta columns, raw sensors and every derived feature.

    ``drop_any`` drops rows with any missing feature; ``zero`` first drops rows
    without any reading and then fills with zero; ``backfill`` is the serving
    rule: absent sensors are zero, lags are back-filled, the first delta is zero.
    """
    if null_policy not in NULL_POLICIES:
        raise ValueError(f"null_policy must be one of {NULL_POLICIES}")
    serving = null_policy == "backfill"
    rows = with_missing_sensors(df, spec, 0.0 if serving else None)
    if null_policy == "zero":
        rows = drop_all_null(rows, spec)
    made = _derive(rows, spec, STATS, with_lags=True, with_delta=True, backfill=serving)
    if null_policy == "drop_any":
        return made.na.drop(how="any", subset=spec.features)
    if null_policy == "zero":
        return made.na.fill(0.0, spec.features)
    return made


def finite_features(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.withColumns({n: finite_or_zero(F.col(n)) for n in names})


def non_finite_counts(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Per feature, how many values :func:`finite_features` replaces."""
    return df.agg(*[F.count_if(~is_finite(F.col(n))).alias(n) for n in names]).unpivot(
        [], list(names), "feature", "replaced"
    )


def feature_columns(df: DataFrame, spec: SeriesSpec) -> list[str]:
    """Scaled features if the table has any, else its raw sensors."""
    scaled = [c for c in df.columns if c.endswith("_norm")]
    return scaled or [s for s in spec.sensors if s in df.columns]


def align_features(df: DataFrame, expected: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """The columns a model expects, in its order; those the table lacks are zero."""
    return df.select(
        *keep, *[F.col(c) if c in df.columns else F.lit(0.0).alias(c) for c in expected]
    )
