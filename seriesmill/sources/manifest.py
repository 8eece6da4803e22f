"""A table whose batches become visible by one commit: data first, then a version that lists it.

Layout under the table's folder:

* ``data/batch=<id>``: the rows of a batch;
* ``files/batch=<id>``: the source files of the batch, one row each;
* ``versions/<n>.json``: the batches that version n consists of.

A batch is written whole before a version names it, and a version is renamed, complete, to a number that must not exist yet.  A run that
fails in between leaves folders that no version names: readers do not see them, and the next run takes the same files again.
Of two runs at once the second finds its number taken and fails, so no file is committed twice.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FILES_SCHEMA = "name string, class int, path string, status string, n_rows bigint, n_bytes bigint, error string"


class Taken(RuntimeError):
    """Another run has committed the version that this one was to become."""


@dataclass(frozen=True)
class Version:
    number: int
    batches: tuple[str, ...]


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def latest(spark: SparkSession, table: str) -> Version:
    """The batches of the newest version that can be read, and the highest number in use; number 0 has no batches."""
    folder, fs = _folder(spark, f"{table}/versions")
    names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    numbers = sorted((int(n.removesuffix(".json")) for n in names if n.endswith(".json")), reverse=True)
    for number in numbers:
        text = "".join(r["value"] for r in spark.read.text(f"{table}/versions/{number:012d}.json", wholetext=True).collect())
        try:
            return Version(numbers[0], tuple(json.loads(text)["batches"]))
        except (ValueError, KeyError):
            continue  # damaged: the one before it holds
    return Version(0, ())


def stage(table: str, rows: DataFrame, files: DataFrame) -> str:
    """Write a batch that no version names yet; its id."""
    batch = uuid.uuid4().hex
    rows.write.option("compression", "snappy").parquet(f"{table}/data/batch={batch}")
    files.write.parquet(f"{table}/files/batch={batch}")
    return batch


def commit(spark: SparkSession, table: str, seen: Version, batch: str) -> Version:
    """Make a batch part of the table, if nothing was committed since ``seen``."""
    new = Version(seen.number + 1, (*seen.batches, batch))
    target, fs = _folder(spark, f"{table}/versions/{new.number:012d}.json")
    draft, _ = _folder(spark, f"{table}/versions/_{batch}")
    out = fs.create(draft, True)
    out.write(bytearray(json.dumps({"batches": list(new.batches)}).encode()))
    out.close()
    fs_package, gateway = spark._jvm.org.apache.hadoop.fs, spark.sparkContext._gateway
    kind = getattr(fs_package, "Options$Rename")
    options = gateway.new_array(kind, 1)
    options[0] = kind.NONE  # fails where the target exists
    try:
        fs_package.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(draft, target, options)
    except Exception as error:
        if not fs.exists(target):
            raise
        fs.delete(draft, False)
        raise Taken(f"version {new.number} of {table} was committed by another run") from error
    return new


def _read(spark: SparkSession, table: str, part: str, version: Version | None, schema) -> DataFrame:
    version = version or latest(spark, table)
    if not version.batches:
        return spark.createDataFrame([], schema)
    paths = [f"{table}/{part}/batch={b}" for b in version.batches]
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.option("mergeSchema", "true").parquet(*paths)


def read_rows(spark: SparkSession, table: str, version: Version | None = None, schema=None) -> DataFrame:
    """The rows of a version, of the newest one by default; columns that a batch lacks are null."""
    version = version or latest(spark, table)
    if not version.batches and schema is None:
        raise ValueError(f"{table} has no batch yet")
    return _read(spark, table, "data", version, schema)


def read_files(spark: SparkSession, table: str, version: Version | None = None) -> DataFrame:
    """The source files of a version's batches, one row per file and batch that looked at it."""
    return _read(spark, table, "files", version, FILES_SCHEMA)


def done_names(files: DataFrame) -> DataFrame:
    """Names of the files whose rows are in the table; those that could not be read are to be tried again."""
    return files.where(F.col("status") == "ok").select("name").distinct()
