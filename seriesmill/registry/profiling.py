"""Queries on profiles and summaries."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from seriesmill.operators import profile, report, scale, silver, split
from seriesmill.registry.book import query, r6, tidy
from seriesmill.registry.fixtures import (
    ENTITY_ORDER,
    EVENT_SOURCE,
    EVENTS,
    LINES,
    columns,
    decisions,
    decisions_sql,
    events,
    labels_without,
    case_label,
    lines,
    PLAIN_SQL,
    ranged_sql,
    split_case,
)
from seriesmill.operators.threshold import argmax

RANGED = f"({ranged_sql(LINES, 'lineitem')})"
SPLIT = f"(SELECT {columns(LINES)}, {split_case(ENTITY_ORDER)} FROM lineitem)"


def ranged(spark, d):
    return silver.null_out_of_range(lines(spark, d), LINES)


def each(template: str, source: str, sensors=LINES.sensors) -> str:
    return " UNION ALL ".join(template.replace("{s}", s).replace("{src}", source) for s in sensors)


def long_sql(source: str, spec=LINES) -> str:
    return each(f"SELECT {spec.label}, '{{s}}' AS sensor, {{s}} AS value FROM {{src}}", source, spec.sensors)


@query(
    "class_dist",
    f"SELECT event_type, count(*) AS n, {r6('count(*) * 100.0::DOUBLE / sum(count(*)) OVER ()', 'pct')} FROM events GROUP BY event_type",
)
def class_dist(spark, d):
    return tidy(profile.class_dist(events(spark, d), "event_type"))


@query(
    "imbalance",
    f"""SELECT count(*) AS classes, max(n) AS largest, min(n) AS smallest, {r6('max(n)::DOUBLE / min(n)', 'ratio')},
               (SELECT event_type FROM events GROUP BY 1 ORDER BY count(*) DESC, 1 DESC LIMIT 1) AS largest_class
        FROM (SELECT event_type, count(*) AS n FROM events GROUP BY event_type)""",
)
def imbalance(spark, d):
    return tidy(profile.imbalance(events(spark, d), "event_type"))


@query(
    "sensor_profile",
    " UNION ALL ".join(
        f"""SELECT '{s}' AS sensor, count({s}) AS n, {r6(f'avg(CASE WHEN {s} IS NULL THEN 100.0::DOUBLE ELSE 0 END)', 'null_pct')},
        count(*) FILTER ({s} < {lo} OR {s} > {hi}) AS out_of_range, {r6(f'min({s})', 'min')}, {r6(f'avg({s})', 'mean')}, {r6(f'max({s})', 'max')},
        {r6(f'stddev_samp({s})', 'std')}, {r6(f'quantile_cont({s}, 0.25)', 'p25')}, {r6(f'median({s})', 'median')},
        {r6(f'quantile_cont({s}, 0.75)', 'p75')}, {r6(f'quantile_cont({s}, 0.99)', 'p99')} FROM lineitem"""
        for s, (lo, hi) in LINES.ranges.items()
    ),
)
def sensor_profile(spark, d):
    return tidy(profile.sensor_profile(lines(spark, d), LINES))


@query(
    "class_sensor_stats",
    f"SELECT l_returnflag, sensor, {r6('avg(value)', 'mean')}, {r6('stddev_samp(value)', 'std')} FROM ({long_sql(RANGED)}) GROUP BY 1, 2",
)
def class_sensor_stats(spark, d):
    return tidy(profile.class_sensor_stats(ranged(spark, d), LINES))


@query(
    "discriminative",
    f"""WITH m AS (SELECT l_returnflag, sensor, avg(value) AS mean FROM ({long_sql(RANGED)}) GROUP BY 1, 2),
             p AS (SELECT sensor, stddev_samp(mean) AS power FROM m GROUP BY sensor)
        SELECT sensor, {r6('power', 'power')}, row_number() OVER (ORDER BY power DESC NULLS LAST, sensor)::INT AS rank,
               power >= median(power) OVER () AS above_median, power = max(power) OVER () AS best, power = min(power) OVER () AS worst
        FROM p""",
)
def discriminative(spark, d):
    return tidy(profile.discriminative(ranged(spark, d), LINES))


@query(
    "null_pct",
    each(
        "SELECT '{s}' AS sensor, round(avg(CASE WHEN {s} IS NULL THEN 100.0::DOUBLE ELSE 0 END), 6) + 0.0 AS null_pct, "
        "avg(CASE WHEN {s} IS NULL THEN 100.0::DOUBLE ELSE 0 END) > 5 AS alert FROM {src}",
        RANGED,
    ),
)
def null_pct(spark, d):
    return tidy(profile.null_pct(ranged(spark, d), LINES.sensors))


def corr_sql(source: str) -> str:
    cells = []
    for a, b in combinations(LINES.sensors, 2):
        for x, y in ((a, b), (b, a)):
            cells.append(f"SELECT '{x}' AS a, '{y}' AS b, {r6(f'corr({a}, {b})', 'corr')} FROM {source}")
    cells += [f"SELECT '{s}' AS a, '{s}' AS b, 1.0::DOUBLE AS corr FROM (SELECT 1)" for s in LINES.sensors]
    return " UNION ALL ".join(cells)


COMPLETE = f"(SELECT * FROM {RANGED} WHERE {' AND '.join(f'{s} IS NOT NULL' for s in LINES.sensors)})"


@query("corr_matrix", corr_sql(RANGED))
def corr_matrix(spark, d):
    return tidy(profile.corr_matrix(ranged(spark, d), LINES.sensors))


@query("corr_listwise", corr_sql(COMPLETE))
def corr_listwise(spark, d):
    return tidy(profile.corr_matrix(ranged(spark, d), LINES.sensors, complete_rows=True))


NET = "l_extendedprice * (1 - l_discount)"


@query(
    "corr_pairs",
    f"""SELECT * FROM (SELECT 'l_extendedprice' AS a, 'net' AS b, {r6(f'corr(l_extendedprice, {NET})', 'corr')} FROM lineitem
        UNION ALL SELECT 'l_extendedprice', 'l_discount', {r6('corr(l_extendedprice, l_discount)', 'corr')} FROM lineitem
        UNION ALL SELECT 'net', 'l_discount', {r6(f'corr({NET}, l_discount)', 'corr')} FROM lineitem) WHERE abs(corr) > 0.7""",
)
def corr_pairs(spark, d):
    rows = lines(spark, d).withColumn("net", F.col("l_extendedprice") * (1 - F.col("l_discount")))
    names = ["l_extendedprice", "net", "l_discount"]
    return tidy(profile.corr_pairs(profile.corr_matrix(rows, names), names))


@query(
    "box_stats",
    f"""WITH v AS (SELECT * FROM ({long_sql(RANGED)}) WHERE value IS NOT NULL),
      q AS (SELECT l_returnflag, sensor, quantile_cont(value, 0.25) AS q1, median(value) AS q2, quantile_cont(value, 0.75) AS q3 FROM v GROUP BY 1, 2),
      f AS (SELECT v.*, q1, q2, q3, value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside FROM v JOIN q USING (l_returnflag, sensor))
      SELECT l_returnflag, sensor, {r6('q1', 'q1')}, {r6('q2', 'q2')}, {r6('q3', 'q3')}, count(*) AS n,
             {r6('min(value) FILTER (inside)', 'whisker_low')}, {r6('max(value) FILTER (inside)', 'whisker_high')}, count(*) FILTER (NOT inside) AS outliers
      FROM f GROUP BY l_returnflag, sensor, f.q1, f.q2, f.q3 HAVING count(*) >= 5""",
)
def box_stats(spark, d):
    return tidy(profile.box_stats(ranged(spark, d), LINES))


Z = "(l_extendedprice - (SELECT avg(l_extendedprice) FROM lineitem)) / (SELECT stddev_pop(l_extendedprice) FROM lineitem)"


def histogram_sql(value: str, low: str, width: str, bins: int) -> str:
    return f"""WITH v AS (SELECT {value} AS x FROM lineitem), e AS (SELECT {low} AS lo, {width} AS w),
      b AS (SELECT least(floor((x - lo) / w), {bins - 1})::INT AS bin, count(*) AS n FROM v, e WHERE x BETWEEN lo AND lo + w * {bins} + 1e-9 GROUP BY 1),
      a AS (SELECT range::INT AS bin, coalesce(n, 0) AS n FROM range({bins}) LEFT JOIN b ON b.bin = range::INT)
      SELECT bin, {r6('lo + bin * w', 'left_edge')}, n, {r6('n / (sum(n) OVER () * w)', 'density')} FROM a, e"""


@query("histogram", histogram_sql(Z, "-4.0::DOUBLE", "8.0::DOUBLE / 39", 39))
def histogram(spark, d):
    rows = lines(spark, d)
    stats = rows.agg(F.avg("l_extendedprice").alias("m"), F.stddev_pop("l_extendedprice").alias("s")).first()
    scaled = rows.select(((F.col("l_extendedprice") - F.lit(stats["m"])) / F.lit(stats["s"])).alias("z"))
    return tidy(profile.histogram(scaled, "z", -4.0, 4.0, 39))


@query(
    "histogram_range",
    histogram_sql(
        "l_extendedprice",
        "(SELECT min(l_extendedprice) FROM lineitem)",
        "(SELECT (max(l_extendedprice) - min(l_extendedprice)) / 50 FROM lineitem)",
        50,
    ),
)
def histogram_range(spark, d):
    return tidy(profile.histogram_of_range(lines(spark, d), "l_extendedprice", 50))


@query(
    "busiest_entity",
    "SELECT user_id, count(DISTINCT event_type) AS classes, count(*) AS n_rows FROM events GROUP BY user_id "
    "ORDER BY classes DESC, user_id LIMIT 1",
)
def busiest_entity(spark, d):
    return profile.busiest_entity(events(spark, d), EVENTS)


@query(
    "split_class_share",
    f"""WITH c AS (SELECT l_returnflag, split, count(*) * 100.0::DOUBLE / sum(count(*)) OVER (PARTITION BY split) AS pct FROM {SPLIT} GROUP BY 1, 2)
        SELECT l_returnflag, {', '.join(r6(f"max(pct) FILTER (split = '{s}')", s) for s in split.SPLITS)} FROM c GROUP BY 1""",
)
def split_class_share(spark, d):
    rows = split.ordinal_split(lines(spark, d), LINES)
    return tidy(profile.split_class_share(rows, LINES.label, split.SPLITS))


@query(
    "split_summary",
    f"SELECT split, count(*) AS n_rows, string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS classes FROM {SPLIT} GROUP BY split",
)
def split_summary(spark, d):
    return profile.split_summary(split.ordinal_split(lines(spark, d), LINES), LINES.label)


def skews(source: str, spec) -> str:
    return each(
        "SELECT '{s}' AS sensor, round(avg({s}), 6) + 0.0 AS mean, round(stddev_samp({s}), 6) + 0.0 AS std, "
        "round(skewness({s}), 6) + 0.0 AS skew FROM {src}",
        source,
        spec.sensors,
    )


@query("skew_compare", skews("lineitem", LINES))
def skew_compare(spark, d):
    return tidy(profile.skew_compare(lines(spark, d), LINES.sensors))


@query("skew_compare_irregular", skews(EVENT_SOURCE, EVENTS))
def skew_compare_irregular(spark, d):
    return tidy(profile.skew_compare(events(spark, d), EVENTS.sensors))


@query(
    "pred_summary",
    f"""SELECT predicted, count(*) AS n, {r6('count(*) * 100.0::DOUBLE / sum(count(*)) OVER ()', 'pct_time')}, {case_label('predicted', 2)} AS event
        FROM (SELECT {PLAIN_SQL} AS predicted FROM ({decisions_sql()})) GROUP BY predicted""",
)
def pred_summary(spark, d):
    rows = decisions(spark, d).withColumn("predicted", argmax(F.col("p")))
    return tidy(profile.pred_summary(rows, "predicted", labels_without(spark, 2)))


@query(
    "exec_summary",
    f"""WITH s AS (SELECT *, {split_case(ENTITY_ORDER)} FROM {RANGED}),
      c AS (SELECT l_returnflag, count(*) AS n FROM s GROUP BY 1),
      m AS (SELECT l_returnflag, sensor, avg(value) AS mean FROM ({long_sql('s')}) GROUP BY 1, 2)
      SELECT (SELECT count(*) FROM s) AS n_rows,
             {', '.join(f"(SELECT count(*) FROM s WHERE split = '{x}') AS n_{x}" for x in split.SPLITS)},
             (SELECT count(*) FROM c) AS classes, (SELECT round(max(n)::DOUBLE / min(n), 6) + 0.0 FROM c) AS ratio,
             (SELECT round(max(x), 6) + 0.0 FROM ({each("SELECT avg(CASE WHEN {s} IS NULL THEN 100.0::DOUBLE ELSE 0 END) AS x FROM {src}", "s")})) AS worst_null_pct,
             (SELECT sensor FROM m GROUP BY sensor ORDER BY stddev_samp(mean) DESC, sensor LIMIT 1) AS best_sensor,
             {len(LINES.features)} AS features""",
)
def exec_summary(spark, d):
    rows = split.ordinal_split(ranged(spark, d), LINES)
    return tidy(report.exec_summary(rows, LINES, len(LINES.features)))


SCALED = "(SELECT " + ", ".join(
    f"({s} - (SELECT avg({s}) FROM lineitem)) / (SELECT stddev_pop({s}) FROM lineitem) AS {s}_norm" for s in LINES.sensors
) + " FROM lineitem)"


@query(
    "skew_scaled",
    " UNION ALL ".join(
        f"SELECT '{s}_norm' AS sensor, {r6(f'avg({s}_norm)', 'mean')}, {r6(f'stddev_samp({s}_norm)', 'std')}, "
        f"{r6(f'skewness({s}_norm)', 'skew')} FROM {SCALED}"
        for s in LINES.sensors
    ),
)
def skew_scaled(spark, d):
    rows = lines(spark, d)
    stats = scale.stats_map(scale.fit_scaler(rows, LINES.sensors, round_to=15))
    scaled = scale.zscore(rows, stats, LINES.sensors, [])
    return tidy(profile.skew_compare(scaled, [f"{s}_norm" for s in LINES.sensors]))
