"""All layers as written tables, with eight sensors and 136 features."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesmill.plans import ingest, medallion
from seriesmill.registry.book import query, r6, read, tidy
from seriesmill.session import scratch_path
from seriesmill.sources import manifest
from seriesmill.sources.bronze import bronze
from seriesmill.sources.files import split_rows, write_table
from seriesmill.spec import WELL_SERIES, event_labels


def well_rows(spark, d):
    """The lines as rows of a well series, scaled so that each sensor has some readings out of range."""
    q, price, discount, tax = (F.col(c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax"))
    readings = {
        "P-PDG": q * 21,
        "P-TPT": price / 100,
        "T-TPT": discount * 2_100,
        "P-MON-CKP": tax * 13_000,
        "T-JUS-CKP": q * 4 - 15,
        "P-JUS-CKGL": price * discount / 10,
        "T-JUS-CKGL": price * tax / 40,
        "QGL": price * (1 - discount) / 20,
    }
    label = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 4).otherwise(7)
    return read(spark, d, "lineitem").select(
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        F.lpad(F.col("l_suppkey").cast("string"), 5, "0").alias("ID_Poco"),
        label.alias("class"),
        *[c.alias(s) for s, c in readings.items()],
    )


@query(
    "etl_layers",
    """WITH n AS (SELECT count(*) AS n FROM (SELECT DISTINCT l_suppkey, l_shipdate FROM lineitem)),
      c AS (SELECT n, floor(n * 0.7::DOUBLE)::BIGINT AS a, floor(n * 0.85::DOUBLE)::BIGINT AS b FROM n)
      SELECT 'train' AS split, a AS n_rows FROM c UNION ALL SELECT 'val', b - a FROM c UNION ALL SELECT 'test', n - b FROM c""",
)
def etl_layers(spark, d):
    out = scratch_path(spark, "layers")
    typed = write_table(bronze(well_rows(spark, d), WELL_SERIES, event_labels(spark)), f"{out}/bronze")
    cleaned = medallion.run_silver(typed, f"{out}/silver")
    return split_rows(medallion.run_gold(cleaned, f"{out}/gold"))


def lay_out(spark, d) -> str:
    """All lines as series files, one per well and class, and one that is no Parquet; the folder they are in."""
    folder = scratch_path(spark, "raw")
    rows = well_rows(spark, d).select("timestamp", "T-TPT", "QGL", F.substring("ID_Poco", -1, 1).alias("_well"), F.col("class").alias("_class"))
    rows.repartition("_class", "_well").write.partitionBy("_class", "_well").parquet(f"{folder}/parts")
    jvm = spark._jvm.org.apache.hadoop.fs
    root = jvm.Path(folder)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.globStatus(jvm.Path(f"{folder}/parts/*/*/*.parquet")):
        part = status.getPath()
        well, label = (p.getName().partition("=")[2] for p in (part.getParent(), part.getParent().getParent()))
        home = jvm.Path(f"{folder}/files/classe_{label}")
        fs.mkdirs(home)
        fs.rename(part, jvm.Path(home, f"WELL-0000{well}_2017020102020{label}.parquet"))
    out = fs.create(jvm.Path(f"{folder}/files/classe_4/WELL-00000_20180201020207.parquet"), True)
    out.write(bytearray(b"no series"))
    out.close()
    return f"{folder}/files"


@query(
    "ingest_run",
    f"""SELECT '0000' || right(l_suppkey::VARCHAR, 1) AS ID_Poco, CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 4 ELSE 7 END::INTEGER AS classe_evento,
               '2017-02-01 02:02:0' || CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 4 ELSE 7 END AS data_medicao, count(*) AS n_rows, {r6("sum(l_discount * 2100)", "sum_t_tpt")}, 1::BIGINT AS broken
        FROM lineitem GROUP BY ALL""",
)
def ingest_run(spark, d):
    """Three runs over one folder: some wells, all wells, nothing new; the table has each row once and lists the broken file."""
    raw, table = lay_out(spark, d), scratch_path(spark, "ingested")
    for wells in (["00001", "00002"], None, None):
        ingest.run_ingest(spark, raw, table, wells)
    broken = manifest.read_files(spark, table).where("status <> 'ok'").select("name").distinct().count()
    rows = manifest.read_rows(spark, table).groupBy("ID_Poco", "classe_evento", "data_medicao").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("T-TPT").alias("sum_t_tpt"))
    return tidy(rows.withColumn("broken", F.lit(broken).cast("long")))
