"""Queries on sources, catalogs and reference tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesmill.operators.scale import fit_scaler
from seriesmill.operators.split import ordinal_split
from seriesmill.registry.book import query, r6, read, tidy
from seriesmill.registry.fixtures import LINE_SPLIT, LINES, case_label, labels_without, lines, rounded_stats
from seriesmill.session import scratch_path
from seriesmill.sources import catalog, files, tables

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

NAME_SQL = (
    "(CASE WHEN o_orderkey % 7 = 0 THEN 'well-' ELSE 'WELL-' END || lpad(o_custkey::VARCHAR, 5, '0') || '_' || "
    "CASE WHEN o_orderkey % 13 = 0 THEN strftime(o_orderdate, '%Y%m%d') ELSE strftime(o_orderdate, '%Y%m%d%H%M%S') END || "
    "CASE WHEN o_orderkey % 11 = 0 THEN '.csv' ELSE '.parquet' END)"
)
CATALOG_SQL = f"SELECT *, {NAME_SQL} AS name FROM orders"
ENTITY_SQL = "nullif(regexp_extract(name, '(?i)^WELL-(\\d+)_(\\d{14})\\.parquet$', 1), '')"
STAMP_SQL = "nullif(regexp_extract(name, '(?i)^WELL-(\\d+)_(\\d{14})\\.parquet$', 2), '')"


def order_files(spark, d):
    """A file catalog made of the orders, some of them misnamed."""
    k = F.col("o_orderkey")
    stamp = F.when(k % 13 == 0, F.date_format("o_orderdate", "yyyyMMdd")).otherwise(
        F.date_format("o_orderdate", "yyyyMMddHHmmss")
    )
    name = F.concat(
        F.when(k % 7 == 0, "well-").otherwise("WELL-"),
        F.lpad(F.col("o_custkey").cast("string"), 5, "0"),
        F.lit("_"),
        stamp,
        F.when(k % 11 == 0, ".csv").otherwise(".parquet"),
    )
    return read(spark, d, "orders").withColumn("name", name)


@query("scan_exclude", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def scan_exclude(spark, d):
    schema = read(spark, d, "orders").schema
    others = [f"{t}.parquet" for t in TABLES if t != "orders"]
    rows = files.scan_parquet(spark, d, schema, others)
    return rows.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


def _good_and_bad(spark, d):
    """A folder with the orders as Parquet and, under it, the same rows as plain text."""
    orders = read(spark, d, "orders")
    path = scratch_path(spark, "mixed")
    orders.write.parquet(f"{path}/good")
    orders.select(F.to_json(F.struct("*")).alias("value")).write.text(f"{path}/bad")
    return path, orders.schema


@query("corrupt_report", "SELECT 'unreadable' AS status, 0::BIGINT AS n_rows UNION ALL SELECT 'ok', count(*) FROM orders")
def corrupt_report(spark, d):
    """Files by what can be read of them; the text files hold no Parquet."""
    path, _ = _good_and_bad(spark, d)
    checked = files.check_files(spark, path, "part-*")
    return checked.groupBy("status").agg(F.coalesce(F.sum("n_read"), F.lit(0)).alias("n_rows")).where("status <> 'ok' OR n_rows > 0")


@query(
    "validate_files",
    "SELECT true AS valid, count(*) AS n_rows, 6 AS n_cols FROM orders UNION ALL SELECT false, NULL, NULL",
)
def validate_files(spark, d):
    path, _ = _good_and_bad(spark, d)
    checked = files.validate_files(spark, path, "part-*")
    return checked.groupBy("valid").agg(F.sum("n_rows").alias("n_rows"), F.max("n_cols").alias("n_cols"))


@query(
    "union_missing",
    """SELECT l_orderkey, l_quantity, l_tax, NULL::DOUBLE AS l_discount FROM lineitem
       UNION ALL SELECT l_orderkey, l_quantity, NULL, l_discount FROM lineitem""",
)
def union_missing(spark, d):
    rows = read(spark, d, "lineitem")
    return files.union_missing(
        [rows.select("l_orderkey", "l_quantity", "l_tax"), rows.select("l_discount", "l_quantity", "l_orderkey")]
    )


@query("list_entities", "SELECT DISTINCT l_suppkey FROM lineitem WHERE l_suppkey IS NOT NULL")
def list_entities(spark, d):
    return files.list_entities(read(spark, d, "lineitem"), "l_suppkey")


@query("scan_entity", "SELECT l_suppkey, l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_suppkey = 7")
def scan_entity(spark, d):
    rows = files.scan_entity(read(spark, d, "lineitem"), "l_suppkey", 7)
    return rows.select("l_suppkey", "l_orderkey", "l_linenumber", "l_quantity")


@query("split_rows", f"SELECT split, count(*) AS n_rows FROM ({LINE_SPLIT}) GROUP BY split")
def split_rows(spark, d):
    return files.split_rows(ordinal_split(lines(spark, d), LINES))


@query("parse_name", f"SELECT name, {ENTITY_SQL} AS entity, {STAMP_SQL} AS stamp FROM ({CATALOG_SQL})")
def parse_name(spark, d):
    name = F.col("name")
    return order_files(spark, d).select(
        "name", catalog.entity_of(name).alias("entity"), catalog.start_of(name).alias("stamp")
    )


@query(
    "parse_ts14",
    f"""SELECT name, CASE WHEN length(s) = 14 THEN strftime(strptime(s, '%Y%m%d%H%M%S'), '%Y-%m-%d %H:%M:%S')
               ELSE coalesce(s, '') END AS start_text,
               CASE WHEN length(s) = 14 THEN strftime(strptime(s, '%Y%m%d%H%M%S'), '%Y/%m/%d %H:%M:%S') END AS start_ts
        FROM (SELECT name, regexp_extract(name, '_(\\d+)\\.', 1) AS s FROM ({CATALOG_SQL}))""",
)
def parse_ts14(spark, d):
    stamp = F.regexp_extract("name", r"_(\d+)\.", 1)
    return order_files(spark, d).select(
        "name",
        catalog.start_time_text(stamp).alias("start_text"),
        F.date_format(catalog.start_time(F.when(F.length(stamp) == 14, stamp)), "yyyy/MM/dd HH:mm:ss").alias("start_ts"),
    )


@query(
    "catalog_filter",
    f"""SELECT o_orderpriority, name FROM ({CATALOG_SQL})
        WHERE name LIKE '%.parquet' AND (upper(name) LIKE 'WELL-0001%' OR upper(name) LIKE 'WELL-0010%')
        QUALIFY row_number() OVER (PARTITION BY o_orderpriority ORDER BY name) <= 20""",
)
def catalog_filter(spark, d):
    kept = catalog.filter_catalog(order_files(spark, d), "name", ["0001", "0010"], 20, "o_orderpriority")
    return kept.select("o_orderpriority", "name")


@query(
    "incremental_new",
    f"""WITH c AS ({CATALOG_SQL}) SELECT name, o_orderkey FROM c
        WHERE name NOT IN (SELECT name FROM c WHERE o_orderstatus = 'F')""",
)
def incremental_new(spark, d):
    found = order_files(spark, d)
    return catalog.not_processed(found, found.where("o_orderstatus = 'F'"), "name").select("name", "o_orderkey")


@query(
    "enrich",
    f"""SELECT o_orderkey, coalesce({ENTITY_SQL}, 'UNKNOWN') AS "ID_Poco", (o_custkey % 11)::INT AS classe_evento,
               {case_label('(o_custkey % 11)', -1)} AS nome_evento,
               CASE WHEN {STAMP_SQL} IS NULL THEN ''
                    ELSE strftime(strptime({STAMP_SQL}, '%Y%m%d%H%M%S'), '%Y-%m-%d %H:%M:%S') END AS data_medicao
        FROM ({CATALOG_SQL})""",
)
def enrich(spark, d):
    event_class = (F.col("o_custkey") % 11).cast("int")
    made = catalog.enrich(order_files(spark, d), F.col("name"), event_class, labels_without(spark, -1))
    return made.select("o_orderkey", "ID_Poco", "classe_evento", "nome_evento", "data_medicao")


@query(
    "ingest_stats",
    """SELECT class, count(*) AS found, count(*) FILTER (ok) AS done,
              coalesce(sum(n_rows) FILTER (ok), 0)::BIGINT AS rows_total, coalesce(sum(n_bytes) FILTER (ok), 0)::BIGINT AS bytes_total,
              count(*) FILTER (NOT ok) AS failed
       FROM (SELECT o_orderpriority AS class, o_orderstatus <> 'P' AS ok, o_orderkey % 1000 AS n_rows,
                    floor(o_totalprice)::BIGINT AS n_bytes FROM orders) GROUP BY class""",
)
def ingest_stats(spark, d):
    log = read(spark, d, "orders").select(
        F.col("o_orderpriority").alias("class"),
        (F.col("o_orderstatus") != "P").alias("ok"),
        (F.col("o_orderkey") % 1000).alias("n_rows"),
        F.floor("o_totalprice").alias("n_bytes"),
    )
    return catalog.ingest_stats(log)


@query(
    "ingest_failures",
    f"SELECT o_orderpriority AS class, name FROM ({CATALOG_SQL}) WHERE o_orderstatus = 'P'",
)
def ingest_failures(spark, d):
    log = order_files(spark, d).select(
        F.col("o_orderpriority").alias("class"), "name", (F.col("o_orderstatus") != "P").alias("ok")
    )
    return catalog.failures(log)


@query(
    "consolidate",
    f"""SELECT f.format, count(*) AS n_rows, {r6('sum(o_totalprice)', 'total')}
        FROM orders, (VALUES ('parquet'), ('csv')) AS f(format) GROUP BY f.format""",
)
def consolidate(spark, d):
    orders = read(spark, d, "orders")
    path = scratch_path(spark, "consolidated")
    files.consolidate(orders, path)
    both = {
        "parquet": spark.read.parquet(f"{path}/parquet"),
        "csv": spark.read.schema(orders.schema).option("header", "true").csv(f"{path}/csv"),
    }
    sums = [
        rows.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("o_totalprice").alias("total")).select(
            F.lit(kind).alias("format"), "n_rows", "total"
        )
        for kind, rows in both.items()
    ]
    return tidy(sums[0].unionByName(sums[1]))


@query(
    "read_csv_required",
    f"SELECT o_orderkey::VARCHAR AS o_orderkey, o_orderstatus, {r6('o_totalprice', 'o_totalprice')} FROM orders",
)
def read_csv_required(spark, d):
    path = scratch_path(spark, "csv")
    read(spark, d, "orders").write.option("header", "true").csv(path)
    rows = files.read_csv_required(spark, path, ["o_orderkey", "o_totalprice"], ["o_totalprice"])
    return tidy(rows.select("o_orderkey", "o_orderstatus", "o_totalprice"))


@query("scaler_json", rounded_stats(LINES.sensors, "lineitem"))
def scaler_json(spark, d):
    return tidy(files.scaler_from_json(files.scaler_json(fit_scaler(lines(spark, d), LINES.sensors))))


@query(
    "upsert_ignore",
    """WITH old AS (SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING')
       SELECT * FROM old UNION ALL
       SELECT o_custkey, 'order ' || min(o_orderkey)::VARCHAR FROM orders
       WHERE o_custkey NOT IN (SELECT c_custkey FROM old) GROUP BY o_custkey""",
)
def upsert_ignore(spark, d):
    old = read(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select("c_custkey", "c_name")
    new = read(spark, d, "orders").select(
        F.col("o_custkey").alias("c_custkey"),
        F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("c_name"),
        "o_orderkey",
    )
    return tables.upsert_ignore(old, new, ["c_custkey"], ["o_orderkey"])


@query(
    "fk_violations",
    """SELECT o_orderkey, o_custkey FROM orders
       WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""",
)
def fk_violations(spark, d):
    known = read(spark, d, "customer").where("c_acctbal > 0")
    return tables.fk_violations(read(spark, d, "orders"), "o_custkey", known, "c_custkey").select(
        "o_orderkey", "o_custkey"
    )
