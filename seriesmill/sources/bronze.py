"""Typing rules of the Bronze layer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesmill.functions.columns import numeric
from seriesmill.operators.profile import with_label_text
from seriesmill.spec import SOURCE_FILE, SOURCE_ROW, SeriesSpec

# Accepted names of the time column, first match wins.
TIME_COLUMNS = ("timestamp", "index", "Timestamp")
# Fixed value: the class column that ingestion writes from the directory.
DIRECTORY_CLASS = "classe_evento"
LABEL_TEXT = "nome_evento"
TIEBREAK_TYPES = {SOURCE_FILE: "string", SOURCE_ROW: "bigint"}


def time_column(df: DataFrame) -> Column:
    """The series time as a timestamp, null where it cannot be read."""
    found = next((c for c in TIME_COLUMNS if c in df.columns), None)
    if found is None:
        return F.lit(None).cast("timestamp")
    kind = df.schema[found].dataType
    if isinstance(kind, T.LongType):  # nanoseconds since the epoch
        return F.timestamp_micros(F.floor(F.expr(f"`{found}` div 1000") - F.when(F.col(found) % 1000 < 0, 1).otherwise(0)))
    return F.col(found).try_cast("timestamp")


def resolve_label(df: DataFrame, label: str) -> Column:
    """Class of the directory if the file has one, else of the row, else -1."""
    source = next((c for c in (DIRECTORY_CLASS, label) if c in df.columns), None)
    if source is None:
        return F.lit(-1).cast("tinyint")
    return F.coalesce(F.col(source).try_cast("double").try_cast("tinyint"), F.lit(-1).cast("tinyint"))


def coerce_sensors(df: DataFrame, spec: SeriesSpec) -> dict[str, Column]:
    return {s: numeric(F.col(s)) if s in df.columns else F.lit(None).cast("double") for s in spec.sensors}


def bronze(df: DataFrame, spec: SeriesSpec, labels: DataFrame, audit: bool = True) -> DataFrame:
    """Canonical columns and types; rows without a class are dropped."""
    entity = F.col(spec.entity).cast("string") if spec.entity in df.columns else F.lit(None).cast("string")
    text = [F.col(LABEL_TEXT)] if LABEL_TEXT in df.columns else []
    typed = df.select(
        time_column(df).alias(spec.ts),
        entity.alias(spec.entity),
        resolve_label(df, spec.label).alias(spec.label),
        *[F.col(t) if t in df.columns else F.lit(None).cast(TIEBREAK_TYPES.get(t, "string")).alias(t) for t in spec.tiebreak],
        *text,
        *[c.alias(s) for s, c in coerce_sensors(df, spec).items()],
    ).where(F.col(spec.label) >= 0)
    if not text:
        typed = with_label_text(typed, labels, spec.label, LABEL_TEXT)
    canonical = typed.select(spec.ts, spec.entity, spec.label, *spec.tiebreak, LABEL_TEXT, *spec.sensors)
    return canonical.withColumn("bronze_at", F.current_timestamp()) if audit else canonical


def without_class(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Rows that Bronze drops for want of a class: per entity, and how many there were."""
    entity = F.col(spec.entity).cast("string") if spec.entity in df.columns else F.lit(None).cast("string")
    tagged = df.select(entity.alias(spec.entity), (resolve_label(df, spec.label) < 0).alias("_gone"))
    counts = tagged.groupBy(spec.entity).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if("_gone").alias("n_removed"))
    return counts
