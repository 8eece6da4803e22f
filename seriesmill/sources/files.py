"""Series files: scanning, footer checks, tolerant reads, sinks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesmill.session import materialise

# Folders that a task writes at the same time; rows of further ones are sorted by folder first.
OPEN_WRITERS = ("spark.sql.maxConcurrentOutputFileWriters", "8")
FOOTER_SCHEMA = "path string, valid boolean, n_rows bigint, n_cols int, columns string, error string"


def scan_parquet(spark: SparkSession, path: str, schema: T.StructType, exclude: Sequence[str] = ()) -> DataFrame:
    """All Parquet files of a directory but the named ones, under one schema.

    The name test works on the file listing: excluded files are not opened.
    """
    rows = spark.read.schema(schema).option("pathGlobFilter", "*.parquet").parquet(path)
    return rows.where(~F.col("_metadata.file_name").isin(*exclude)) if exclude else rows


def list_entities(df: DataFrame, entity: str) -> DataFrame:
    return df.select(entity).where(F.col(entity).isNotNull()).distinct()


def scan_entity(df: DataFrame, entity: str, value: object) -> DataFrame:
    return df.where(F.col(entity) == F.lit(value))


def split_rows(df: DataFrame, split: str = "split") -> DataFrame:
    return df.groupBy(split).agg(F.count(F.lit(1)).alias("n_rows"))


def plain_path(column: Column) -> Column:
    """Local paths come with one or three slashes, depending on who lists them."""
    return F.regexp_replace(column, "^file:/+", "file:///")


def _footer(path: str) -> tuple:
    """What the footer says; only contents that are no Parquet make a file invalid.

    Errors of the store (credentials, network, unknown schemes) are raised: they say nothing about the file.
    """
    import pyarrow as pa
    import pyarrow.fs as pafs
    import pyarrow.parquet as pq

    fs, inner = pafs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    with fs.open_input_file(inner) as f:
        size = f.size()
        try:
            meta = pq.ParquetFile(f)
        except (pa.ArrowInvalid, OSError) as error:
            if isinstance(error, OSError) and not isinstance(error, pa.ArrowInvalid) and size and not _thrift(error):
                raise
            return path, False, None, None, None, f"{type(error).__name__}: {error}"
        shape = ", ".join(f"{c.name} {c.type}" for c in meta.schema_arrow)
        return path, True, meta.metadata.num_rows, meta.metadata.num_columns, shape, None


def _thrift(error: OSError) -> bool:
    """Whether a footer could be fetched but not understood."""
    return "thrift" in str(error).lower() or "deserialize" in str(error).lower()


def validate_files(spark: SparkSession, path: str, glob: str = "*.parquet", only: DataFrame | None = None) -> DataFrame:
    """One row per file with what its footer says; footers are read by the executors."""
    listed = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(plain_path(F.col("path")).alias("path"))
    )
    if only is not None:
        listed = listed.join(only.select("path").distinct(), "path", "left_semi")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [f.split()[0] for f in FOOTER_SCHEMA.split(", ")]
        for batch in batches:
            yield pd.DataFrame([_footer(p) for p in batch["path"]], columns=names)

    return listed.mapInPandas(read, FOOTER_SCHEMA)


def check_files(
    spark: SparkSession, path: str, glob: str = "*.parquet", exclude: Sequence[str] = (), only: DataFrame | None = None
) -> DataFrame:
    """Footers and contents of every file, a written table: path, status, n_rows, n_read, columns, digest, error.

    ``status`` is ``unreadable`` where the footer is no Parquet, ``damaged`` where fewer rows can be decoded
    than the footer counts, else ``ok``.  Every page of every file is decoded once, by Spark, on its own
    settings for the store; footers are read once.  With ``only`` (a column ``path``) no other file is opened.  ``digest`` is over the decoded rows in any order.
    """
    checked = validate_files(spark, path, glob, only)
    if exclude:
        checked = checked.where(~F.element_at(F.split("path", "/"), -1).isin(*exclude))
    checked = materialise(checked, "footers")
    counted = None
    for part in _by_shape(spark, checked.where("valid"), {"ignoreCorruptFiles": "true"}):
        whole = F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in part.columns])
        decoded = part.select(plain_path(F.col("_metadata.file_path")).alias("path"), whole.alias("h"))
        counts = decoded.groupBy("path").agg(F.count("h").alias("n_read"), F.bit_xor("h").alias("digest"))
        counted = counts if counted is None else counted.unionByName(counts)
    if counted is None:
        counted = spark.createDataFrame([], "path string, n_read long, digest long")
    n_read = F.when(F.col("valid"), F.coalesce("n_read", F.lit(0)))
    status = F.when(~F.col("valid"), "unreadable").when(F.col("n_rows") > n_read, "damaged").otherwise("ok")
    error = F.coalesce("error", F.when(status == "damaged", F.lit("fewer rows than its footer counts")))
    joined = checked.join(counted, "path", "left")
    return materialise(
        joined.select("path", status.alias("status"), "n_rows", n_read.alias("n_read"), "columns", "digest", error.alias("error")), "files"
    )


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of the Parquet files under ``path``, from the listing."""
    listed = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .load(path)
    )
    return listed.agg(F.sum("length")).first()[0] or 0


def corrupt_report(spark: SparkSession, path: str, glob: str = "*.parquet") -> DataFrame:
    """Files that cannot be read in full, with the reason."""
    return check_files(spark, path, glob).where("status <> 'ok'").select("path", "status", "n_rows", "n_read", "error")


def read_by_shape(
    spark: SparkSession, path: str, exclude: Sequence[str] = (), checked: DataFrame | None = None
) -> list[DataFrame]:
    """One frame per distinct footer schema of the files that ``check_files`` finds whole.

    A file that fails later all the same stops the job.  Nanosecond timestamps, which Spark does not read,
    arrive as long counts.
    """
    checked = checked if checked is not None else check_files(spark, path, exclude=exclude)
    return list(_by_shape(spark, checked.where("status = 'ok'"), {}))


def _by_shape(spark: SparkSession, files: DataFrame, options: dict[str, str]) -> Iterator[DataFrame]:
    """Scans of the files, shape by shape; the driver lists files for every scan and here keeps their names."""
    legacy = "spark.sql.legacy.parquet.nanosAsLong"
    before = spark.conf.get(legacy, None)
    spark.conf.set(legacy, "true")
    try:
        scans = []
        for shape in files.select("columns").distinct().orderBy("columns").toLocalIterator():
            paths = [r["path"] for r in files.where(F.col("columns") == shape["columns"]).select("path").toLocalIterator()]
            scans.append(spark.read.options(**options).parquet(*paths))
    finally:
        spark.conf.unset(legacy) if before is None else spark.conf.set(legacy, before)
    yield from scans


def union_missing(parts: Sequence[DataFrame]) -> DataFrame:
    """Union by name; columns that a part lacks are null."""
    if not parts:
        raise ValueError("no part to unite: no readable file was found")
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part, allowMissingColumns=True)
    return result


def read_csv_required(spark: SparkSession, path: str, required: Sequence[str], numbers: Sequence[str]) -> DataFrame:
    """CSV with a header; fails when a required column is absent. ``numbers`` become doubles."""
    rows = spark.read.option("header", "true").csv(path)
    missing = [c for c in required if c not in rows.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return rows.withColumns({c: F.col(c).try_cast("double") for c in numbers if c in rows.columns})


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> DataFrame:
    """The written table; with few values of ``partition_by`` no task sorts its rows by them."""
    spark, writer = df.sparkSession, df.write.mode(mode).option("compression", "snappy")
    if not partition_by:
        writer.parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    before = spark.conf.get(OPEN_WRITERS[0])
    spark.conf.set(*OPEN_WRITERS)
    try:
        writer.partitionBy(*partition_by).parquet(path)
    finally:
        spark.conf.set(OPEN_WRITERS[0], before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def consolidate(df: DataFrame, path: str) -> None:
    """The whole table as Parquet and as CSV."""
    df.write.mode("overwrite").option("compression", "snappy").parquet(f"{path}/parquet")
    df.write.mode("overwrite").option("header", "true").csv(f"{path}/csv")


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def scaler_json(stats: DataFrame) -> DataFrame:
    """The fitted scaler as one nested document: feature to mean and deviation."""
    entry = F.struct(F.col("feature").alias("key"), F.struct("mean", "std").alias("value"))
    return stats.agg(F.to_json(F.map_from_entries(F.sort_array(F.collect_list(entry)))).alias("document"))


def scaler_from_json(document: DataFrame) -> DataFrame:
    parsed = F.from_json("document", "map<string, struct<mean: double, std: double>>")
    return document.select(F.explode(parsed).alias("feature", "s")).select("feature", "s.mean", "s.std")
