"""Reference tables: insert if absent, and referential checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesmill.operators.slices import attach, bounded

RUN_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("class", T.IntegerType()),
        T.StructField("found", T.LongType()),
        T.StructField("done", T.LongType()),
        T.StructField("rows_total", T.LongType()),
        T.StructField("bytes_total", T.LongType()),
        T.StructField("failed", T.LongType()),
        T.StructField("started_at", T.TimestampType()),
    ]
)
METRIC_SCHEMA = T.StructType(
    [
        T.StructField("model", T.StringType()),
        T.StructField("split", T.StringType()),
        T.StructField("accuracy", T.DecimalType(6, 4)),
        T.StructField("f1_weighted", T.DecimalType(6, 4)),
        T.StructField("f1_macro", T.DecimalType(6, 4)),
        T.StructField("params", T.StringType()),
    ]
)
PREDICTION_SCHEMA = T.StructType(
    [
        T.StructField("ID_Poco", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("predicted", T.IntegerType()),
        T.StructField("actual", T.IntegerType()),
        T.StructField("confidence", T.DecimalType(6, 4)),
        T.StructField("model", T.StringType()),
    ]
)


def upsert_ignore(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], first_by: Sequence[str]) -> DataFrame:
    """Existing rows plus the incoming ones whose key is new; of equal new keys the first stays."""
    w = Window.partitionBy(*keys).orderBy(*first_by)
    firsts = incoming.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")
    fresh = firsts.join(existing.select(*keys).distinct(), list(keys), "left_anti")
    return existing.unionByName(fresh.select(*existing.columns))


def fk_violations(rows: DataFrame, column: str, dimension: DataFrame, key: str) -> DataFrame:
    """Rows whose non-null ``column`` is no ``key`` of the dimension."""
    known = bounded(dimension.select(F.col(key).alias(column)).distinct())
    return attach(rows.where(F.col(column).isNotNull()), known, [column], "left_anti")
