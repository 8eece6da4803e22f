"""Session settings and the reliable store that long jobs cut their lineage with."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Rows a driver may hold, or a broadcast may carry, after the count was checked.
SMALL_ROWS = 10_000
# HotSpot compiles no method above this size; Spark's default lets wide projections run interpreted instead of in split projections.
METHOD_LIMIT = ("spark.sql.codegen.hugeMethodLimit", "8000")
_SPARKS_METHOD_LIMIT = "65535"
# Bytes of rows in one Arrow batch. By Spark's default one often holds all texts of a task, in the JVM and in Python.
BATCH_LIMIT = ("spark.sql.execution.arrow.maxBytesPerBatch", "4m")
_SPARKS_BATCH_LIMIT = "67108864b"


def build_session(app: str = "seriesmill", master: str | None = None, partitions: int | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.parquet.compression.codec", "snappy")
        .config(*METHOD_LIMIT)
    )
    if master:
        builder = builder.master(master)
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    return builder.getOrCreate()


def limit_methods(spark: SparkSession) -> None:
    """Give a session that others have built the limit on generated methods, unless they have set another."""
    if spark.conf.get(METHOD_LIMIT[0], _SPARKS_METHOD_LIMIT) == _SPARKS_METHOD_LIMIT:
        spark.conf.set(*METHOD_LIMIT)


def limit_batches(spark: SparkSession) -> None:
    """Give a session the limit on Arrow batches, unless it has another: the same rows, in more batches."""
    if spark.conf.get(BATCH_LIMIT[0], _SPARKS_BATCH_LIMIT) == _SPARKS_BATCH_LIMIT:
        spark.conf.set(*BATCH_LIMIT)


@contextmanager
def fitted_shuffle(
    spark: SparkSession, input_bytes: int, task_bytes: int = 128 << 20, growth: int = 3
) -> Iterator[int]:
    """Raise the shuffle partitions to the size of the input while the block runs.

    Adaptive execution joins partitions that turn out small but splits none of a
    window, so the number must be large enough from the start.  ``growth`` is how
    much larger rows are in a shuffle than in Parquet.  The caller's setting comes
    back afterwards, so only work that runs inside the block sees the larger one.
    """
    current = spark.conf.get("spark.sql.shuffle.partitions")
    wanted = max(int(current), -(-input_bytes * growth // task_bytes))
    spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    try:
        yield wanted
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", current)


def shared_dir(spark: SparkSession) -> str:
    """This application's folder in ``spark.checkpoint.dir``, else in the warehouse.

    Both are shared by driver and executors.  Executors on other machines do not see a warehouse on this one's disk, so
    that is refused on a cluster.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not root:
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
        if root.startswith("file:") and not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors share; the warehouse is on this machine: {root}")
    return f"{root.rstrip('/')}/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    A written table survives lost executors, gives later passes the very same
    rows, and still lets each of them prune columns.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    made = df.sparkSession.read.schema(df.schema).parquet(path)
    made._scratch = path
    return made


def forget(df: DataFrame) -> None:
    """Delete a table that ``materialise`` wrote and that nothing reads any more; other frames are left alone."""
    path = getattr(df, "_scratch", None)
    if path:
        _delete(df.sparkSession, path)


def drop_scratch(spark: SparkSession) -> bool:
    """Delete all that this application has written with ``materialise``.

    Call it when the results are written: frames that read scratch tables fail afterwards.
    """
    return _delete(spark, shared_dir(spark))


def _delete(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
