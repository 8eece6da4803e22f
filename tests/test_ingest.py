"""Ingestion: what is taken, what waits, and what a failure leaves behind."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from seriesmill.plans import ingest
from seriesmill.sources import manifest


@pytest.fixture
def raw(spark, tmp_path):
    """A folder per class with one file per well, two of them not readable."""
    folder = tmp_path / "raw"

    def put(name: str, classe: int, rows: int, columns: str = "`T-TPT` double"):
        made = folder / f"classe_{classe}"
        made.mkdir(parents=True, exist_ok=True)
        part = tmp_path / f"one-{name}"
        spark.range(rows).select(F.col("id").cast("double").alias("T-TPT"), *([F.lit(1.0).alias("QGL")] if "QGL" in columns else [])).coalesce(1).write.parquet(str(part))
        (file,) = part.glob("*.parquet")
        (made / name).write_bytes(file.read_bytes())
        return made / name

    put("WELL-00001_20170201020207.parquet", 0, 10)
    put("WELL-00001_20180201020207.parquet", 4, 20, "QGL")
    put("WELL-00002_20170201020207.parquet", 4, 30)
    (folder / "classe_4" / "WELL-00003_20170201020207.parquet").write_bytes(b"PAR1 not at all")
    (folder / "classe_4" / "notes.txt").write_text("no series")
    put("all_classes_combined.parquet", 0, 99)
    return folder, put


def stats(df):
    return {r["class"]: (r["found"], r["done"], r["rows_total"], r["failed"]) for r in df.collect()}


def counts(spark, table):
    return {tuple(r) for r in manifest.read_rows(spark, table).groupBy("ID_Poco", "classe_evento").count().collect()}


def test_ingest_runs_add_up(spark, raw, tmp_path):
    folder, put = raw
    table = str(tmp_path / "table")
    assert stats(ingest.run_ingest(spark, str(folder), table, entities=["00001"])) == {0: (1, 1, 10, 0), 4: (1, 1, 20, 0)}
    assert counts(spark, table) == {("00001", 0, 10), ("00001", 4, 20)}
    # the next run takes the others; the broken one is listed and waits
    assert stats(ingest.run_ingest(spark, str(folder), table)) == {4: (2, 1, 30, 1)}
    assert counts(spark, table) == {("00001", 0, 10), ("00001", 4, 20), ("00002", 4, 30)}
    bad = manifest.read_files(spark, table).where("status <> 'ok'").collect()
    assert [r["name"] for r in bad] == ["WELL-00003_20170201020207.parquet"] and bad[0]["error"]
    # nothing new but the broken one, again and again
    assert stats(ingest.run_ingest(spark, str(folder), table)) == {4: (1, 0, 0, 1)}
    put("WELL-00003_20170201020207.parquet", 4, 5)
    assert stats(ingest.run_ingest(spark, str(folder), table)) == {4: (1, 1, 5, 0)}
    assert stats(ingest.run_ingest(spark, str(folder), table)) == {}
    assert counts(spark, table) == {("00001", 0, 10), ("00001", 4, 20), ("00002", 4, 30), ("00003", 4, 5)}
    row = manifest.read_rows(spark, table).where("ID_Poco = '00002'").first()
    assert (row["data_medicao"], row["QGL"]) == ("2017-02-01 02:02:07", None) and row["nome_evento"]


@pytest.mark.parametrize("lost", ["stage", "commit"])
def test_a_failed_run_neither_loses_nor_doubles(spark, raw, tmp_path, monkeypatch, lost):
    folder, _ = raw
    table = str(tmp_path / "table")
    ingest.run_ingest(spark, str(folder), table, entities=["00001"])
    before = counts(spark, table)

    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as patched:
        if lost == "stage":  # rows are written, the list of files is not
            whole = manifest.stage
            patched.setattr(manifest, "stage", lambda table, rows, files: (whole(table, rows, files), fail()))
        else:
            patched.setattr(manifest, "commit", fail)
        with pytest.raises(OSError, match="lost"):
            ingest.run_ingest(spark, str(folder), table)
    assert counts(spark, table) == before
    ingest.run_ingest(spark, str(folder), table)
    assert counts(spark, table) == {*before, ("00002", 4, 30)}


def test_two_runs_at_once(spark, raw, tmp_path):
    folder, _ = raw
    table = str(tmp_path / "table")
    seen = manifest.latest(spark, table)
    ingest.run_ingest(spark, str(folder), table, entities=["00001"])
    with pytest.raises(manifest.Taken):
        manifest.commit(spark, table, seen, "another")
    assert manifest.latest(spark, table).number == 1


def test_a_damaged_version(spark, raw, tmp_path):
    folder, _ = raw
    table = str(tmp_path / "table")
    ingest.run_ingest(spark, str(folder), table, entities=["00001"])
    (tmp_path / "table" / "versions" / "000000000002.json").write_text('{"batches": ["a')
    assert counts(spark, table) == {("00001", 0, 10), ("00001", 4, 20)}
    ingest.run_ingest(spark, str(folder), table)
    assert manifest.latest(spark, table).number == 3
    assert counts(spark, table) == {("00001", 0, 10), ("00001", 4, 20), ("00002", 4, 30)}


def test_an_empty_folder(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    assert ingest.run_ingest(spark, str(tmp_path / "raw"), str(tmp_path / "table")).collect() == []
