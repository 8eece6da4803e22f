"""Few large partitions for many small slices, many small ones for the rows a forest keeps."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesmill.operators import model, slices


def test_small_slices_share_range_partitions(spark):
    rows = spark.range(5_000).select(F.lit(1).alias("k"), "id", (F.col("id") % 7).alias("v"))
    carved = slices.carve(rows, ["k"], [F.col("id")], 10)
    assert carved.hot.select(F.shiftright("_pos", 33)).distinct().count() <= spark.sparkContext.defaultParallelism
    assert carved.hot.groupBy("_slice").count().agg(F.max("count")).first()[0] <= 10
    numbered = slices.number_rows(rows, ["k"], [F.col("id")], 10)
    assert numbered.where("row_no <> id + 1 OR key_rows <> 5000").isEmpty() and numbered.count() == 5_000


def test_kept_rows_come_in_small_partitions(spark):
    rows = spark.range(4_000).coalesce(1)
    made = model.in_parts(rows, 100, 10, most=640 * 500)
    assert made.rdd.getNumPartitions() == 8 and max(made.rdd.glom().map(len).collect()) <= 600
    assert model.in_parts(rows, 100, 10).rdd.getNumPartitions() == 1
