"""Files written here: nanosecond times, NaN, absent sensors, odd time columns, broken files."""

from __future__ import annotations

from dataclasses import replace

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from seriesmill.operators import features as feat
from seriesmill.plans import medallion
from seriesmill.session import fitted_shuffle
from seriesmill.sources import catalog, files, tables
from seriesmill.sources.connectors import JdbcTarget, object_store_conf
from seriesmill.spec import WELL_SENSORS, WELL_SERIES, event_labels


def write(path, frame, **options):
    path.parent.mkdir(parents=True, exist_ok=True)
    pq.write_table(pa.Table.from_pandas(frame, preserve_index=False), path, **options)


@pytest.fixture
def raw(tmp_path):
    """Five series files of different shapes in class directories, and one broken file."""
    root = tmp_path / "raw"
    times = pd.date_range("2024-01-01", periods=6, freq="1s")
    value = np.array([1.0, np.nan, 3.0, 2000.0, 5.0, 6.0])
    write(
        root / "classe_0" / "WELL-00001_20240101000000.parquet",
        pd.DataFrame({"timestamp": times.astype("datetime64[ns]"), "P-PDG": value, "T-TPT": value}),
    )
    write(
        root / "classe_0" / "WELL-00002_20240101000000.parquet",
        pd.DataFrame({"index": times.astype("datetime64[us]"), "P-PDG": value.astype(str), "class": [0.0] * 6}),
    )
    write(
        root / "classe_4" / "well-00001_20240101000100.parquet",
        pd.DataFrame({"Timestamp": (times + pd.Timedelta("3s")).astype("datetime64[us]"), "QGL": value, "class": [8.0] * 6}),
    )
    write(
        root / "loose" / "WELL-00003_20240101000000.parquet",
        pd.DataFrame({"timestamp": ["soon", *times[1:].astype(str)], "QGL": value, "class": [None, 1, 1, 1, 1, 1]}),
    )
    write(root / "all_classes_combined.parquet", pd.DataFrame({"timestamp": times.astype("datetime64[us]")}))
    (root / "classe_4" / "WELL-00009_20240101000000.parquet").write_bytes(b"PAR1 not really")
    return root


def test_validate_reports_broken_files(spark, raw):
    got = {r["path"].rsplit("/", 1)[1]: r for r in files.validate_files(spark, str(raw)).collect()}
    assert len(got) == 6
    assert not got["WELL-00009_20240101000000.parquet"]["valid"]
    assert got["WELL-00001_20240101000000.parquet"]["n_rows"] == 6
    assert files.corrupt_report(spark, str(raw)).count() == 1


def test_damaged_pages_are_reported_and_left_out(spark, raw, tmp_path):
    path = raw / "classe_0" / "WELL-00007_20240101000000.parquet"
    times = pd.date_range("2024-01-01", periods=20_000, freq="1s").astype("datetime64[us]")
    write(path, pd.DataFrame({"timestamp": times, "P-PDG": np.random.default_rng(0).normal(size=20_000)}), row_group_size=5_000)
    content = bytearray(path.read_bytes())
    half, end = len(content) // 2, len(content) * 9 // 10  # the footer stays whole
    content[half:end] = b"\xff" * (end - half)
    path.write_bytes(bytes(content))
    bad = {r["path"].rsplit("/", 1)[1]: r for r in files.corrupt_report(spark, str(raw)).collect()}
    assert bad["WELL-00009_20240101000000.parquet"]["status"] == "unreadable"
    damaged = bad["WELL-00007_20240101000000.parquet"]
    assert damaged["status"] == "damaged" and damaged["n_rows"] == 20_000 > damaged["n_read"]
    bronze = medallion.run_bronze(spark, str(raw), str(tmp_path / "bronze"))
    assert bronze.where("ID_Poco = '00007'").isEmpty() and bronze.count() == 23
    assert spark.read.parquet(str(tmp_path / "bronze_quarantine")).count() == 2
    removed = {r["ID_Poco"]: (r["n_rows"], r["n_removed"]) for r in spark.read.parquet(str(tmp_path / "bronze_removed")).collect()}
    assert removed == {"00001": (12, 0), "00002": (6, 0), "00003": (6, 1)}
    with pytest.raises(ValueError, match="quarantine"):
        medallion.run_bronze(spark, str(raw), str(tmp_path / "strict"), allow_bad=False)


def test_nanoseconds_keep_every_microsecond(spark):
    from seriesmill.sources.bronze import time_column

    micros = [1_700_000_000_000_001 + 7 * i for i in range(1000)] + [-1, 0]
    frame = spark.createDataFrame([(m * 1000 + (1 if m >= 0 else 0),) for m in micros], "timestamp long")
    got = [r[0] for r in frame.select(F.unix_micros(time_column(frame))).collect()]
    assert got == micros


def test_layers_do_not_depend_on_the_order_of_input(spark):
    rng = np.random.default_rng(3)
    rows = [
        ((pd.Timestamp("2024-01-01") + pd.Timedelta(int(t), "s")).to_pydatetime(), str(w), int(c), f"f{f}", i, "x", *[None if rng.random() < 0.3 else float(v) for v in rng.normal(size=8)])
        for i, (t, w, c, f) in enumerate(zip(rng.integers(0, 40, 400), rng.choice(["a", "b"], 400), rng.integers(0, 2, 400), rng.integers(0, 3, 400)))
    ]
    kinds = "timestamp timestamp, ID_Poco string, class tinyint, source_file string, source_row long, nome_evento string, "
    kinds += ", ".join(f"`{s}` double" for s in WELL_SENSORS)
    made = []
    for seed in range(3):
        order = np.random.default_rng(seed).permutation(len(rows))
        frame = spark.createDataFrame([rows[i] for i in order], kinds).repartition(seed + 1)
        made.append(sorted(map(str, medallion.silver(frame, WELL_SERIES).select(*WELL_SERIES.meta, *WELL_SENSORS).collect())))
    assert made[0] == made[1] == made[2]


def test_bronze_types_every_shape(spark, raw, tmp_path):
    bronze = medallion.run_bronze(spark, str(raw), str(tmp_path / "bronze"))
    assert bronze.columns == ["timestamp", "ID_Poco", "class", "source_file", "source_row", "nome_evento", *WELL_SENSORS, "bronze_at"]
    got = {(r["ID_Poco"], r["class"]): r["n"] for r in bronze.groupBy("ID_Poco", "class").agg(F.count(F.lit(1)).alias("n")).collect()}
    # the directory class wins over the row class; the row without any class is gone
    assert got == {("00001", 0): 6, ("00002", 0): 6, ("00001", 4): 6, ("00003", 1): 5}
    one = bronze.where("ID_Poco = '00001' AND class = 0").orderBy("timestamp").collect()
    assert [r["P-PDG"] for r in one] == [1.0, None, 3.0, 2000.0, 5.0, 6.0]
    assert one[1]["timestamp"].second == 1
    assert one[0]["P-JUS-CKGL"] is None
    assert {r[0] for r in bronze.where("class = 4").select("nome_evento").collect()} == {"Flow Instability"}
    assert bronze.where("ID_Poco = '00003' AND timestamp IS NULL").count() == 0


def test_layers_end_to_end(spark, raw, tmp_path):
    bronze = medallion.run_bronze(spark, str(raw), str(tmp_path / "bronze"))
    silver = medallion.run_silver(bronze, str(tmp_path / "silver"))
    # seconds 3 to 5 of well 1 exist in both classes: the lower one stays
    assert silver.where("ID_Poco = '00001' AND class = 4").count() == 3
    assert silver.groupBy("ID_Poco", "timestamp").count().where("count > 1").isEmpty()
    assert silver.agg(F.max("P-PDG")).first()[0] <= 1000.0
    gold = medallion.run_gold(silver, str(tmp_path / "gold"))
    assert len(gold.columns) == 142  # 4 meta, 136 features, split, time of writing
    assert {r[0] for r in gold.select("split").distinct().collect()} == {"train", "val", "test"}
    assert gold.count() == silver.count()
    stats = files.read_json(spark, str(tmp_path / "gold" / "scaler"), "feature string, mean double, std double")
    assert stats.count() == 136
    parts = sorted(p.name for p in (tmp_path / "gold" / "rows").glob("split=*"))
    assert parts == ["split=test", "split=train", "split=val"]


def test_run_all_sizes_the_shuffles(spark, raw, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    gold = medallion.run_all(spark, str(raw), str(tmp_path / "out"))
    assert gold.count() > 0
    assert spark.conf.get("spark.sql.shuffle.partitions") == before  # a few kilobytes need no more
    with fitted_shuffle(spark, 10 << 30) as wanted:
        assert wanted == 240 == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_gold_by_time_and_drop_any(spark, raw, tmp_path):
    times = pd.date_range("2024-01-01", periods=40, freq="1s")
    rows = [(t.to_pydatetime(), w, 0, "Normal", *([float(i)] * 8)) for w in ("a", "b") for i, t in enumerate(times)]
    kinds = "timestamp timestamp, ID_Poco string, class tinyint, nome_evento string, " + ", ".join(f"`{s}` double" for s in WELL_SENSORS)
    silver = spark.createDataFrame(rows, kinds)
    gold, _ = medallion.gold(silver, replace(WELL_SERIES, tiebreak=()), "drop_any", by_time=True)
    assert gold.count() == 70  # five rows of each well have no lag 5
    last = gold.groupBy("split").agg(F.max("timestamp").alias("t"), F.count(F.lit(1)).alias("n")).collect()
    got = {r["split"]: r for r in last}
    assert [got[s]["n"] for s in ("train", "val", "test")] == [49, 10, 11]
    assert got["train"]["t"] < got["test"]["t"]


def test_csv_needs_its_columns(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_text("timestamp,T-TPT\n2024-01-01 00:00:00,1.5\n2024-01-01 00:00:01,bad\n")
    with pytest.raises(ValueError, match="T-JUS-CKP"):
        files.read_csv_required(spark, str(path), ["T-JUS-CKP", "T-TPT"], ["T-TPT"])
    got = files.read_csv_required(spark, str(path), ["T-TPT"], ["T-TPT"])
    assert [r["T-TPT"] for r in got.collect()] == [1.5, None]


def test_file_names(spark):
    names = ["WELL-00002_20170401120000.parquet", "well-7_20170401120000.PARQUET", "WELL-x_20170401120000.parquet", "WELL-00002_2017.parquet"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    made = df.select("name", catalog.entity_of(F.col("name")).alias("e"), catalog.start_of(F.col("name")).alias("s"))
    got = {r["name"]: (r["e"], r["s"]) for r in made.collect()}
    assert got[names[0]] == ("00002", "20170401120000") and got[names[1]] == ("7", "20170401120000")
    assert got[names[2]] == got[names[3]] == (None, None)
    text = spark.createDataFrame([("20170401120000",), ("2017",), (None,)], "s string")
    assert [r[0] for r in text.select(catalog.start_time_text(F.col("s"))).collect()] == ["2017-04-01 12:00:00", "2017", ""]
    assert text.select(catalog.start_time(F.col("s"))).first()[0].hour == 12
    assert catalog.filter_catalog(df, "name").count() == 3  # the suffix test is case-sensitive
    assert catalog.filter_catalog(df, "name", ["00002", "7"]).count() == 2


def test_insert_ignores_known_keys(spark):
    old = spark.createDataFrame([(1, "a")], "k int, v string")
    new = spark.createDataFrame([(1, "z"), (2, "c"), (2, "b")], "k int, v string")
    got = sorted(tuple(r) for r in tables.upsert_ignore(old, new, ["k"], ["v"]).collect())
    assert got == [(1, "a"), (2, "b")]
    assert [r["k"] for r in tables.fk_violations(new, "k", old, "k").collect()] == [2, 2]


def test_scaler_document_round_trip(spark, tmp_path):
    stats = spark.createDataFrame([("x", 1.25, 2.0), ("y", -3.0, 1.0)], "feature string, mean double, std double")
    files.write_json(files.scaler_json(stats), str(tmp_path / "doc"))
    back = files.scaler_from_json(files.read_json(spark, str(tmp_path / "doc"), "document string"))
    assert sorted(tuple(r) for r in back.collect()) == [("x", 1.25, 2.0), ("y", -3.0, 1.0)]


def test_scan_prunes_and_pushes(spark, tmp_path):
    spark.range(10).selectExpr("id", "id % 2 AS e", "id AS v").write.parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t"))
    plan = files.scan_entity(rows, "e", 1).select("e", "v")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(e,1)" in plan and "ReadSchema: struct<e:bigint,v:bigint>" in plan


def test_connector_options():
    target = JdbcTarget("jdbc:postgresql://db/x", "u", "p")
    assert target.options("t")["dbtable"] == "t"
    assert object_store_conf("http://s", "a", "b")["spark.hadoop.fs.s3a.path.style.access"] == "true"


def test_missing_sensor_is_aligned(spark):
    df = spark.createDataFrame([(1.0,)], "a double")
    assert feat.align_features(df, ["b", "a"]).first().asDict() == {"b": 0.0, "a": 1.0}
    assert feat.feature_columns(df, WELL_SERIES) == []
    assert event_labels(spark).count() == 10
