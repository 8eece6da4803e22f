"""File catalog, processed-file manifest and ingestion statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesmill.operators.profile import with_label_text
from seriesmill.spec import UNKNOWN_ENTITY

# Fixed value: name of a series file, entity id and start time.
NAME_PATTERN = r"(?i)^WELL-(\d+)_(\d{14})\.parquet$"


def entity_of(name: Column) -> Column:
    return F.nullif(F.regexp_extract(name, NAME_PATTERN, 1), F.lit(""))


def start_of(name: Column) -> Column:
    return F.nullif(F.regexp_extract(name, NAME_PATTERN, 2), F.lit(""))


def start_time_text(stamp: Column) -> Column:
    """``YYYYMMDDHHMMSS`` with separators; any other length passes through, none is empty."""
    parts = F.regexp_replace(stamp, r"^(.{4})(.{2})(.{2})(.{2})(.{2})(.{2})$", r"$1-$2-$3 $4:$5:$6")
    return F.coalesce(F.when(F.length(stamp) == 14, parts).otherwise(stamp), F.lit(""))


def start_time(stamp: Column) -> Column:
    return F.try_to_timestamp(stamp, F.lit("yyyyMMddHHmmss"))


def filter_catalog(
    files: DataFrame, name: str, entities: Sequence[str] | None = None, per_class: int | None = None, by: str = "class"
) -> DataFrame:
    """Parquet files of the wanted entities, all if none are named; optionally the first N per class."""
    wanted = F.col(name).endswith(".parquet")
    if entities is not None:
        upper = F.upper(name)
        hit = F.lit(False)
        for e in entities:
            hit = hit | upper.startswith(f"WELL-{e}")
        wanted = wanted & hit
    kept = files.where(wanted)
    if per_class is None:
        return kept
    w = Window.partitionBy(by).orderBy(name)
    return kept.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= per_class).drop("_rank")


def not_processed(files: DataFrame, manifest: DataFrame, name: str) -> DataFrame:
    """Files whose name the manifest does not have yet."""
    return files.join(manifest.select(name).distinct(), name, "left_anti")


def enrich(df: DataFrame, name: Column, event_class: Column, labels: DataFrame) -> DataFrame:
    """Add entity id, class, its text and the start time of the series."""
    tagged = df.withColumns(
        {
            "ID_Poco": F.coalesce(entity_of(name), F.lit(UNKNOWN_ENTITY)),
            "classe_evento": event_class,
            "data_medicao": start_time_text(start_of(name)),
        }
    )
    return with_label_text(tagged, labels, "classe_evento", "nome_evento")


def ingest_stats(log: DataFrame, by: str = "class") -> DataFrame:
    """Per class: files found, done and failed, rows and bytes of those done.

    ``log`` has ``name, ok, n_rows, n_bytes``; the failed names are :func:`failures`.
    """
    done = F.col("ok")
    return log.groupBy(by).agg(
        F.count(F.lit(1)).alias("found"),
        F.count_if(done).alias("done"),
        F.sum(F.when(done, F.col("n_rows")).otherwise(0)).alias("rows_total"),
        F.sum(F.when(done, F.col("n_bytes")).otherwise(0)).alias("bytes_total"),
        F.count_if(~done).alias("failed"),
    )


def failures(log: DataFrame, by: str = "class") -> DataFrame:
    """Names of the failed files, one row each, so that no class gathers a list."""
    return log.where(~F.col("ok")).select(by, "name")
