"""The description of a labelled multivariate series that every operator takes."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Sensor columns of a raw series file, in canonical order, with the
# inclusive physical range of each.
WELL_SENSORS = (
    "P-PDG",
    "P-TPT",
    "T-TPT",
    "P-MON-CKP",
    "T-JUS-CKP",
    "P-JUS-CKGL",
    "T-JUS-CKGL",
    "QGL",
)
WELL_RANGES = {
    "P-PDG": (0.0, 1000.0),
    "P-TPT": (0.0, 1000.0),
    "T-TPT": (-10.0, 200.0),
    "P-MON-CKP": (0.0, 1000.0),
    "T-JUS-CKP": (-10.0, 200.0),
    "P-JUS-CKGL": (0.0, 1000.0),
    "T-JUS-CKGL": (-10.0, 200.0),
    "QGL": (0.0, 5000.0),
}

# Event code, full text and short text.
EVENT_LABELS = (
    (0, "Normal", "Normal"),
    (1, "Abrupt Increase of BSW", "BSW"),
    (2, "Spurious Closure of DHSV", "DHSV"),
    (3, "Severe Slugging", "Slugging"),
    (4, "Flow Instability", "Flow"),
    (5, "Rapid Productivity Loss", "Productivity"),
    (6, "Quick Restriction in PCK", "PCK"),
    (7, "Scaling in PCK", "Scaling"),
    (8, "Hydrate in Production Line", "Hydrate"),
    (9, "Undefined", "Undefined"),
)
UNKNOWN_LABEL = "Desconhecido"
UNKNOWN_ENTITY = "UNKNOWN"
OTHER_SENSOR = "outro"

LABEL_SCHEMA = T.StructType(
    [
        T.StructField("code", T.IntegerType(), False),
        T.StructField("label", T.StringType(), False),
        T.StructField("short_label", T.StringType(), False),
    ]
)


def event_labels(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(EVENT_LABELS), LABEL_SCHEMA)


def safe_name(sensor: str) -> str:
    """Prefix of the derived feature names of a sensor."""
    return sensor.replace("-", "_")


@dataclass(frozen=True)
class SeriesSpec:
    """Which columns play which role.

    ``tiebreak`` completes ``ts`` to a total order inside an entity.  ``keys`` is
    the grouping of fills and feature windows: entity and label by default, the
    entity alone for serving, where the label is not known yet.
    """

    entity: str
    label: str
    ts: str
    sensors: tuple[str, ...]
    ranges: dict[str, tuple[float, float]] = field(default_factory=dict)
    tiebreak: tuple[str, ...] = ()
    keys: tuple[str, ...] | None = None
    windows: tuple[int, ...] = (5, 10, 30)
    lags: tuple[int, ...] = (1, 3, 5)
    max_rows_per_task: int = 2_000_000

    @property
    def group(self) -> tuple[str, ...]:
        return self.keys if self.keys is not None else (self.entity, self.label)

    @property
    def order(self) -> list[Column]:
        return ordered(self.ts, *self.tiebreak)

    @property
    def meta(self) -> tuple[str, ...]:
        return (self.entity, self.label, self.ts, *self.tiebreak)

    def rolling_names(self, sensor: str) -> list[str]:
        name = safe_name(sensor)
        return [f"{name}_roll_{stat}_{w}" for w in self.windows for stat in ("mean", "std", "min", "max")]

    def lag_names(self, sensor: str) -> list[str]:
        return [f"{safe_name(sensor)}_lag_{k}" for k in self.lags]

    def delta_name(self, sensor: str) -> str:
        return f"{safe_name(sensor)}_delta"

    @property
    def derived(self) -> list[str]:
        """Rolling, then lag, then delta features, sensor by sensor."""
        return (
            [n for s in self.sensors for n in self.rolling_names(s)]
            + [n for s in self.sensors for n in self.lag_names(s)]
            + [self.delta_name(s) for s in self.sensors]
        )

    @property
    def features(self) -> list[str]:
        return [*self.sensors, *self.derived]

    def serving(self) -> SeriesSpec:
        return replace(self, keys=(self.entity,))


def ordered(*names: str) -> list[Column]:
    """Ascending, missing values last: the order in which series rows are read."""
    return [F.col(n).asc_nulls_last() for n in names]


# Where a row was read: completes the order of a series, and is gone from Gold.
SOURCE_FILE, SOURCE_ROW = "source_file", "source_row"

WELL_SERIES = SeriesSpec(
    entity="ID_Poco",
    label="class",
    ts="timestamp",
    sensors=WELL_SENSORS,
    ranges=WELL_RANGES,
    tiebreak=(SOURCE_FILE, SOURCE_ROW),
)
