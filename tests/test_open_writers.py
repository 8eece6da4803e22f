"""A partitioned table is written without sorting rows by folder."""

from __future__ import annotations

from pyspark.sql import DataFrameWriter

from seriesmill.sources.files import OPEN_WRITERS, write_table


def test_folders_are_written_side_by_side(spark, tmp_path, monkeypatch):
    seen, kept = [], DataFrameWriter.parquet

    def noted(writer, *args, **options):
        seen.append(spark.conf.get(OPEN_WRITERS[0]))
        return kept(writer, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", noted)
    before = spark.conf.get(OPEN_WRITERS[0])
    rows = spark.range(600, numPartitions=3).selectExpr("id", "id % 12 AS split", "id % 7 AS x")
    made = write_table(rows, str(tmp_path / "t"), ["split"])
    assert sorted(made.select(*rows.columns).collect()) == sorted(rows.collect())
    assert len(list((tmp_path / "t").glob("split=*"))) == 12
    assert seen == [OPEN_WRITERS[1]] and spark.conf.get(OPEN_WRITERS[0]) == before
