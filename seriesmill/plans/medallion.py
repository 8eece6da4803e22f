"""Bronze, Silver and Gold, each a written table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesmill.functions.columns import from_sortable
from seriesmill.operators import features as feat
from seriesmill.operators import scale
from seriesmill.operators.ranks import keys_at, label_by_cuts, rows_before
from seriesmill.operators.silver import silver
from seriesmill.operators.split import CUTS, SPLITS
from seriesmill.session import fitted_shuffle
from seriesmill.sources.bronze import LABEL_TEXT, bronze, without_class
from seriesmill.sources.catalog import enrich
from seriesmill.sources.files import check_files, read_by_shape, size_of, union_missing, write_json, write_table
from seriesmill.spec import SOURCE_FILE, SOURCE_ROW, WELL_SERIES, SeriesSpec, event_labels

# Combined tables that ingestion leaves beside the series files.
COMBINED_FILES = ("all_classes_combined.parquet", "all_classes_combined.csv")
CLASS_DIRECTORY = r"/classe_(\d+)/"


def run_bronze(
    spark: SparkSession, raw_dir: str, out: str, spec: SeriesSpec = WELL_SERIES, allow_bad: bool = True
) -> DataFrame:
    """Read every series file under ``raw_dir``; entity and class come from its path.

    Beside the table, ``<out>_quarantine`` lists files that cannot be read in full, which are left out whole
    (with ``allow_bad=False`` they stop the run), and ``<out>_removed`` counts rows per entity and those dropped for want of a class.
    """
    labels = event_labels(spark)
    checked = check_files(spark, raw_dir, exclude=COMBINED_FILES)
    bad = write_table(checked.where("status <> 'ok'").drop("columns", "digest"), f"{out}_quarantine")
    if not allow_bad and not bad.isEmpty():
        raise ValueError(f"files that cannot be read in full are listed in {out}_quarantine")
    parts, removed = [], []
    for part in read_by_shape(spark, raw_dir, COMBINED_FILES, checked):
        path_class = F.regexp_extract(F.col("_metadata.file_path"), CLASS_DIRECTORY, 1)
        has_class = "classe_evento" in part.columns
        tagged = part.select(
            "*",
            F.col("_metadata.file_name").alias("_file"),
            F.col("_metadata.file_name").alias(SOURCE_FILE),
            F.col("_metadata.row_index").alias(SOURCE_ROW),
            F.nullif(path_class, F.lit("")).try_cast("int").alias("_dir_class"),
        )
        if spec.entity not in part.columns:
            own = F.col(spec.label).try_cast("double").try_cast("int") if spec.label in part.columns else F.lit(None)
            known = F.col("classe_evento") if has_class else F.coalesce(F.col("_dir_class"), own)
            tagged = enrich(tagged, F.col("_file"), known, labels)
        parts.append(bronze(tagged, spec, labels))
        removed.append(without_class(tagged, spec))
    counted = union_missing(removed).groupBy(spec.entity).agg(F.sum("n_rows").alias("n_rows"), F.sum("n_removed").alias("n_removed"))
    write_table(counted, f"{out}_removed")
    return write_table(union_missing(parts), out)


def run_silver(df: DataFrame, out: str, spec: SeriesSpec = WELL_SERIES, partition_by: Sequence[str] = ()) -> DataFrame:
    cleaned = silver(df, spec).withColumn("silver_at", F.current_timestamp())
    return write_table(cleaned, out, partition_by)


def gold(
    df: DataFrame,
    spec: SeriesSpec,
    null_policy: str = "zero",
    ddof: int = 0,
    by_time: bool = False,
    keep: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """Scaled features with their split, and the scaler fitted on train.

    The features are ten times as wide as the readings, so the fit recomputes
    them from ``df`` rather than writing them; ``df`` should be a written table.
    """
    made = feat.features(df, spec, null_policy)
    order = (spec.ts, spec.entity) if by_time else (spec.entity, spec.ts)
    rows = made.select(spec.entity, spec.ts, *spec.tiebreak) if null_policy == "drop_any" else df
    if null_policy == "zero":
        rows = feat.drop_all_null(df, spec)
    names = (*order, *spec.tiebreak)
    cuts = keys_at(rows, names, CUTS)
    placed = made.withColumn("split", label_by_cuts(rows, names, cuts, SPLITS))
    cut, early = cuts[0], made
    if cut is not None and cut[0] is not None and order[0] == spec.entity and spec.entity in spec.group:
        # keys behind the cut are not worth their features
        early = feat.features(df.where(F.col(spec.entity) <= from_sortable(df, spec.entity, cut[0])), spec, null_policy)
    stats = scale.fit_scaler(early.where(rows_before(rows, names, cut)), spec.features, ddof)
    fitted = scale.stats_map(stats)
    stats = df.sparkSession.createDataFrame([(f, m, s) for f, (m, s) in fitted.items()], scale.STATS_SCHEMA)
    return scale.zscore(placed, fitted, spec.features, [*spec.meta, *keep, "split"]), stats


def run_gold(df: DataFrame, out: str, spec: SeriesSpec = WELL_SERIES, **options) -> DataFrame:
    """Write Gold, one directory per split, and the scaler beside it."""
    keep = [LABEL_TEXT] if LABEL_TEXT in df.columns else []
    rows, stats = gold(df, spec, keep=keep, **options)
    write_json(stats, f"{out}/scaler")
    placed = rows.drop(SOURCE_FILE, SOURCE_ROW).withColumn("gold_at", F.current_timestamp())
    return write_table(placed, f"{out}/rows", ["split"])


def run_all(spark: SparkSession, raw_dir: str, out: str, spec: SeriesSpec = WELL_SERIES, **options) -> DataFrame:
    """Raw files to Gold; while a layer runs, its shuffles are sized to its input."""
    with fitted_shuffle(spark, size_of(spark, raw_dir)):
        bronze_rows = run_bronze(spark, raw_dir, f"{out}/bronze", spec)
    with fitted_shuffle(spark, size_of(spark, f"{out}/bronze")):
        silver_rows = run_silver(bronze_rows, f"{out}/silver", spec)
        return run_gold(silver_rows, f"{out}/gold", spec, **options)
