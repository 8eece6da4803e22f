"""Queries on Bronze and Silver rules."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from seriesmill.functions.columns import numeric, sensor_of
from seriesmill.operators import features as feat
from seriesmill.operators import silver
from seriesmill.operators.profile import with_label_text
from seriesmill.operators.report import quality_gates
from seriesmill.plans.medallion import gold
from seriesmill.registry.book import query, r6, read, tidy
from seriesmill.registry.fixtures import (
    AT_CTE,
    EVENT_SOURCE,
    EVENTS,
    LINE_KEY,
    LINE_SILVER,
    LINES,
    SENSOR_CASE,
    attributions,
    case_label,
    events,
    filled_sql,
    first_sql,
    labels_without,
    lines,
    ranged_sql,
    rounded_list,
    silver_ctes,
    some_reading,
)
from seriesmill.session import materialise
from seriesmill.sources.bronze import bronze as to_bronze

META = ", ".join(LINES.meta)

RAW = replace(LINES, entity="ID_Poco", label="class", ts="timestamp", tiebreak=("l_orderkey", "l_partkey"))


def raw_lines(spark, d):
    """The lines as an untyped raw file: everything text, some of it unreadable."""
    text = {s: F.col(s).cast("string") for s in LINES.sensors}
    text["l_quantity"] = F.when(F.col("l_linenumber") == 2, "n/a").otherwise(text["l_quantity"])
    text["l_tax"] = F.when(F.col("l_linenumber") == 3, "NaN").otherwise(text["l_tax"])
    stamp = F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")
    return read(spark, d, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        F.lpad(F.col("l_suppkey").cast("string"), 5, "0").alias("ID_Poco"),
        F.when(F.col("l_linenumber") == 4, "soon").otherwise(stamp).alias("index"),
        (F.col("l_linenumber") - 2).alias("class"),
        F.when(F.col("l_linenumber") != 5, F.col("l_linenumber") - 2).alias("classe_evento"),
        *[c.alias(s) for s, c in text.items()],
    )


RAW_QUANTITY = "CASE WHEN l_linenumber <> 2 THEN l_quantity END"
RAW_TAX = "CASE WHEN l_linenumber <> 3 THEN l_tax END"


@query(
    "bronze",
    f"""SELECT l_orderkey, l_partkey, lpad(l_suppkey::VARCHAR, 5, '0') AS "ID_Poco", (l_linenumber - 2)::TINYINT AS class,
               CASE WHEN l_linenumber <> 4 THEN strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') END AS ts_text,
               {case_label('(l_linenumber - 2)', 4)} AS nome_evento, {r6(RAW_QUANTITY, 'l_quantity')},
               {r6('l_extendedprice', 'l_extendedprice')}, {r6('l_discount', 'l_discount')}, {r6(RAW_TAX, 'l_tax')}
        FROM lineitem WHERE l_linenumber >= 2 AND l_linenumber <> 5""",
)
def bronze(spark, d):
    made = to_bronze(raw_lines(spark, d), RAW, labels_without(spark, 4), audit=False)
    text = F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("ts_text")
    return tidy(made.select("*", text).drop("timestamp"))


@query(
    "coerce_numeric",
    f"SELECT l_orderkey, l_partkey, {r6(RAW_QUANTITY, 'l_quantity')}, {r6(RAW_TAX, 'l_tax')} FROM lineitem",
)
def coerce_numeric(spark, d):
    return tidy(
        raw_lines(spark, d).select(
            "l_orderkey",
            "l_partkey",
            numeric(F.col("l_quantity")).alias("l_quantity"),
            numeric(F.col("l_tax")).alias("l_tax"),
        )
    )


@query("label_text", f"SELECT l_orderkey, l_linenumber, {case_label('l_linenumber', 3)} AS event FROM lineitem")
def label_text(spark, d):
    rows = read(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    return with_label_text(rows, labels_without(spark, 3), "l_linenumber")


@query("range_null", f"SELECT {META}, {rounded_list(LINES.sensors)} FROM ({ranged_sql(LINES, 'lineitem')})")
def range_null(spark, d):
    return tidy(silver.null_out_of_range(lines(spark, d), LINES))


@query(
    "range_counts",
    " UNION ALL ".join(
        f"SELECT '{s}' AS sensor, count(*) FILTER ({s} < {lo} OR {s} > {hi}) AS out_of_range FROM lineitem"
        for s, (lo, hi) in LINES.ranges.items()
    ),
)
def range_counts(spark, d):
    return silver.range_counts(lines(spark, d), LINES)


@query(
    "drop_all_null",
    f"SELECT {META}, {rounded_list(LINES.sensors)} FROM ({ranged_sql(LINES, 'lineitem')}) WHERE {some_reading(LINES)}",
)
def drop_all_null(spark, d):
    return tidy(silver.drop_all_null(silver.null_out_of_range(lines(spark, d), LINES), LINES))


@query(
    "fill_series",
    f"WITH ranged AS ({ranged_sql(LINES, 'lineitem')}) "
    f"SELECT {META}, {rounded_list(LINES.sensors)} FROM ({filled_sql(LINES, 'ranged')})",
)
def fill_series(spark, d):
    return tidy(silver.fill_series(silver.null_out_of_range(lines(spark, d), LINES), LINES))


@query(
    "fill_series_irregular",
    f"WITH ranged AS ({ranged_sql(EVENTS, EVENT_SOURCE)}) "
    f"SELECT {', '.join(EVENTS.meta)}, {rounded_list(EVENTS.sensors)} FROM ({filled_sql(EVENTS, 'ranged')})",
)
def fill_series_irregular(spark, d):
    return tidy(silver.fill_series(silver.null_out_of_range(events(spark, d), EVENTS), EVENTS))


@query("dedup_first", f"SELECT {META}, {rounded_list(LINES.sensors)} FROM ({first_sql(LINES, 'lineitem')})")
def dedup_first(spark, d):
    return tidy(silver.keep_first(lines(spark, d), LINES))


MEDIANS = f"""{silver_ctes(EVENTS, EVENT_SOURCE)},
  by_class AS (SELECT event_type, median(value) AS mv, median(k) AS mk FROM silver GROUP BY event_type),
  filled_class AS (SELECT s.user_id, s.event_type, s.ts, s.event_id, coalesce(s.value, mv) AS value, coalesce(s.k, mk) AS k
                   FROM silver s JOIN by_class USING (event_type)),
  overall AS (SELECT median(value) AS mv, median(k) AS mk FROM filled_class)
  SELECT user_id, event_type, ts, event_id, {r6('coalesce(value, mv)', 'value')}, {r6('coalesce(k, mk)', 'k')}
  FROM filled_class, overall"""


@query("median_fallback", MEDIANS)
def median_fallback(spark, d):
    return tidy(silver.silver(events(spark, d), EVENTS))


@query("silver", f"{LINE_SILVER} SELECT {META}, {rounded_list(LINES.sensors)} FROM silver")
def silver_layer(spark, d):
    return tidy(silver.silver(lines(spark, d), LINES))


RATIO = "CASE WHEN l_discount = 0 THEN 'Infinity'::DOUBLE WHEN l_tax = 0 THEN 'NaN'::DOUBLE ELSE l_tax / l_discount END"


@query(
    "finite_clean",
    f"""SELECT {', '.join(LINE_KEY)}, {r6('CASE WHEN isfinite(ratio) THEN ratio ELSE 0 END', 'ratio')}
        FROM (SELECT *, {RATIO} AS ratio FROM lineitem)""",
)
def finite_clean(spark, d):
    return tidy(feat.finite_features(_ratios(spark, d), ["ratio"]))


@query(
    "finite_counts",
    f"SELECT 'ratio' AS feature, count(*) FILTER (NOT isfinite(ratio)) AS replaced FROM (SELECT {RATIO} AS ratio FROM lineitem)",
)
def finite_counts(spark, d):
    return feat.non_finite_counts(_ratios(spark, d), ["ratio"])


def _ratios(spark, d):
    ratio = (
        F.when(F.col("l_discount") == 0, float("inf"))
        .when(F.col("l_tax") == 0, float("nan"))
        .otherwise(F.try_divide("l_tax", "l_discount"))
    )
    return read(spark, d, "lineitem").select(*LINE_KEY, ratio.alias("ratio"))


@query(
    "feature_to_sensor",
    f"WITH {AT_CTE} SELECT {SENSOR_CASE} AS sensor, feature, count(*) AS n FROM att GROUP BY 1, 2",
)
def feature_to_sensor(spark, d):
    mapped = attributions(spark, d).withColumn("sensor", sensor_of(F.col("feature"), LINES.sensors))
    return mapped.groupBy("sensor", "feature").agg(F.count(F.lit(1)).alias("n"))


@query(
    "align_features",
    f"SELECT {', '.join(LINE_KEY)}, {r6('l_tax', 'l_tax')}, 0.0::DOUBLE AS l_lost, {r6('l_quantity', 'l_quantity')} FROM lineitem",
)
def align_features(spark, d):
    return tidy(feat.align_features(read(spark, d, "lineitem"), ["l_tax", "l_lost", "l_quantity"], LINE_KEY))


@query(
    "quality_gates",
    f"""{LINE_SILVER}
        SELECT * FROM (SELECT 'splits_present' AS "check", true AS passed, 3 AS value
          UNION ALL SELECT 'rows', count(*) > 0, count(*) FROM silver
          UNION ALL SELECT 'norm_features', true, {len(LINES.features)}
          UNION ALL SELECT 'train_rows', count(*) > 0, floor(count(*) * 0.7::DOUBLE)::BIGINT FROM silver)""",
)
def gates(spark, d):
    rows = materialise(silver.silver(lines(spark, d), LINES), "silver")
    return quality_gates(gold(rows, LINES)[0])


