"""From a folder of series files to one table: catalog, new files, checks, enriched rows, statistics, commit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesmill.plans.medallion import CLASS_DIRECTORY, COMBINED_FILES
from seriesmill.session import materialise
from seriesmill.sources import manifest
from seriesmill.sources.catalog import enrich, filter_catalog, ingest_stats, not_processed
from seriesmill.sources.files import check_files, plain_path, read_by_shape, union_missing
from seriesmill.sources.tables import RUN_SCHEMA, upsert_ignore
from seriesmill.spec import SOURCE_FILE, SOURCE_ROW, event_labels

ROW_COLUMNS = "ID_Poco string, classe_evento int, nome_evento string, data_medicao string"


def catalog(spark: SparkSession, raw_dir: str) -> DataFrame:
    """``name``, ``path``, ``class`` (of the directory) and ``n_bytes`` of every Parquet file but the combined ones, from the listing."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(raw_dir)
    path = plain_path(F.col("path"))
    found = listed.select(
        F.element_at(F.split(path, "/"), -1).alias("name"),
        path.alias("path"),
        F.nullif(F.regexp_extract(path, CLASS_DIRECTORY, 1), F.lit("")).try_cast("int").alias("class"),
        F.col("length").alias("n_bytes"),
    )
    return found.where(~F.col("name").isin(*COMBINED_FILES))


def run_ingest(
    spark: SparkSession,
    raw_dir: str,
    table: str,
    entities: Sequence[str] | None = None,
    per_class: int | None = None,
    run_id: str | None = None,
) -> DataFrame:
    """Bring the files that the table does not have yet into it; per class how many were found, done and failed.

    Files are chosen by entity and, within a class, the first ``per_class`` by name.  Of files with one name the first path counts.
    Files that cannot be read in full are listed with their error and tried again by the next run; the others' rows come with entity, class, its text and the
    start of the series.  The batch and the list of its files become visible together, or not at all.
    """
    seen = manifest.latest(spark, table)
    known = manifest.read_files(spark, table, seen)
    chosen = filter_catalog(catalog(spark, raw_dir), "name", entities, per_class)
    none = spark.createDataFrame([], chosen.schema)
    wanted = materialise(upsert_ignore(none, not_processed(chosen, manifest.done_names(known), "name"), ["name"], ["path"]), "wanted")
    if wanted.isEmpty():
        return _stats(spark.createDataFrame([], manifest.FILES_SCHEMA), run_id)
    checked = check_files(spark, raw_dir, exclude=COMBINED_FILES, only=wanted.select("path"))
    files = wanted.join(checked.select("path", "status", "n_rows", "error"), "path").select(
        "name", "class", "path", "status", F.when(F.col("status") == "ok", F.col("n_rows")).alias("n_rows"), "n_bytes", "error"
    )
    files = materialise(files, "files")
    batch = manifest.stage(table, _rows(spark, raw_dir, checked), files)
    manifest.commit(spark, table, seen, batch)
    return _stats(files, run_id or batch)


def _rows(spark: SparkSession, raw_dir: str, checked: DataFrame) -> DataFrame:
    parts = []
    for part in read_by_shape(spark, raw_dir, COMBINED_FILES, checked):
        tagged = part.select(
            "*",
            F.col("_metadata.file_name").alias(SOURCE_FILE),
            F.col("_metadata.row_index").alias(SOURCE_ROW),
            F.nullif(F.regexp_extract(F.col("_metadata.file_path"), CLASS_DIRECTORY, 1), F.lit("")).try_cast("int").alias("_class"),
        )
        parts.append(enrich(tagged, F.col(SOURCE_FILE), F.col("_class"), event_labels(spark)).drop("_class"))
    if not parts:
        return spark.createDataFrame([], f"{ROW_COLUMNS}, {SOURCE_FILE} string, {SOURCE_ROW} bigint")
    return union_missing(parts)


def _stats(files: DataFrame, run_id: str | None) -> DataFrame:
    """One row per class in the form of the table of runs."""
    log = files.select("class", "name", (F.col("status") == "ok").alias("ok"), "n_rows", "n_bytes")
    stats = ingest_stats(log).withColumns({"run_id": F.lit(run_id), "started_at": F.current_timestamp()})
    return stats.select(*[F.col(f.name).cast(f.dataType) for f in RUN_SCHEMA])
