"""The given tables seen as labelled sensor series, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesmill.registry.book import r6, read
from seriesmill.spec import EVENT_LABELS, LABEL_SCHEMA, UNKNOWN_LABEL, SeriesSpec, safe_name

LINES = SeriesSpec(
    entity="l_suppkey",
    label="l_returnflag",
    ts="l_shipdate",
    tiebreak=("l_orderkey", "l_partkey", "l_linenumber"),
    sensors=("l_quantity", "l_extendedprice", "l_discount", "l_tax"),
    ranges={
        "l_quantity": (10.0, 35.0),
        "l_extendedprice": (5000.0, 90000.0),
        "l_discount": (0.01, 0.08),
        "l_tax": (0.01, 0.07),
    },
)
# Six keys over the whole table, the case of a key that holds a large share of the rows.
HEAVY = SeriesSpec(
    entity="l_linestatus",
    label="l_returnflag",
    ts="l_shipdate",
    tiebreak=("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"),
    sensors=LINES.sensors,
    ranges=LINES.ranges,
    max_rows_per_task=3_000,
)
LINE_KEY = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
CLASSES = ("A", "N", "R")

EVENTS = SeriesSpec(
    entity="user_id",
    label="event_type",
    ts="ts",
    tiebreak=("event_id",),
    sensors=("value", "k"),
    ranges={"value": (60.0, 120.0), "k": (10.0, 90.0)},
)


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").select(*LINES.meta, *LINES.sensors)


def heavy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").select(*HEAVY.meta, *HEAVY.sensors)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("double").alias("k")
    return read(spark, sf_dir, "events").select("user_id", "event_type", "ts", "event_id", "value", k)


def labels_without(spark: SparkSession, code: int) -> DataFrame:
    """The label dimension with one code left out, to show the default text."""
    return spark.createDataFrame([row for row in EVENT_LABELS if row[0] != code], LABEL_SCHEMA)


# --- the same in SQL ---------------------------------------------------------


def case_label(column: str, left_out: int) -> str:
    arms = " ".join(f"WHEN {c} THEN '{text}'" for c, text, _ in EVENT_LABELS if c != left_out)
    return f"CASE {column} {arms} ELSE '{UNKNOWN_LABEL}' END"


def columns(spec: SeriesSpec) -> str:
    return ", ".join([*spec.meta, *spec.sensors])


def order_sql(spec: SeriesSpec) -> str:
    return ", ".join([spec.ts, *spec.tiebreak])


def ranged_sql(spec: SeriesSpec, source: str) -> str:
    readings = ", ".join(
        f"CASE WHEN {s} BETWEEN {lo} AND {hi} THEN {s} END AS {s}" for s, (lo, hi) in spec.ranges.items()
    )
    return f"SELECT {', '.join(spec.meta)}, {readings} FROM {source}"


def filled_sql(spec: SeriesSpec, source: str) -> str:
    over = f"PARTITION BY {', '.join(spec.group)} ORDER BY {order_sql(spec)} ROWS BETWEEN UNBOUNDED PRECEDING AND"
    readings = ", ".join(
        f"coalesce(last_value({s} IGNORE NULLS) OVER ({over} CURRENT ROW), "
        f"first_value({s} IGNORE NULLS) OVER ({over} UNBOUNDED FOLLOWING)) AS {s}"
        for s in spec.sensors
    )
    return f"SELECT {', '.join(spec.meta)}, {readings} FROM {source}"


def first_sql(spec: SeriesSpec, source: str) -> str:
    by = ", ".join([spec.label, *spec.tiebreak])
    return (
        f"SELECT {columns(spec)} FROM {source} "
        f"QUALIFY row_number() OVER (PARTITION BY {spec.entity}, {spec.ts} ORDER BY {by}) = 1"
    )


def some_reading(spec: SeriesSpec) -> str:
    return f"coalesce({', '.join(spec.sensors)}) IS NOT NULL"


EVENT_SOURCE = (
    "(SELECT user_id, event_type, ts, event_id, value, "
    "regexp_extract(props, '\"k\": *([0-9.]+)', 1)::DOUBLE AS k FROM events)"
)


def silver_ctes(spec: SeriesSpec, source: str) -> str:
    """CTEs up to ``silver``, before the median fallback."""
    return (
        f"WITH ranged AS ({ranged_sql(spec, source)}), filled AS ({filled_sql(spec, 'ranged')}), "
        f"firsts AS ({first_sql(spec, 'filled')}), "
        f"silver AS (SELECT * FROM firsts WHERE {some_reading(spec)})"
    )


LINE_SILVER = silver_ctes(LINES, "lineitem")


def feature_exprs(spec: SeriesSpec, stats=("mean", "std", "min", "max"), parts=("roll", "lag", "delta"), serving=False):
    """Feature name to SQL expression over a window named ``w``-less, spelled out."""
    over = f"PARTITION BY {', '.join(spec.group)} ORDER BY {order_sql(spec)}"
    made: dict[str, str] = {}
    if "roll" in parts:
        for s in spec.sensors:
            for size in spec.windows:
                frame = f"OVER ({over} ROWS BETWEEN {size - 1} PRECEDING AND CURRENT ROW)"
                one = {
                    "mean": f"avg({s}) {frame}",
                    "std": f"coalesce(stddev_samp({s}) {frame}, 0)",
                    "min": f"min({s}) {frame}",
                    "max": f"max({s}) {frame}",
                }
                made |= {f"{safe_name(s)}_roll_{st}_{size}": one[st] for st in stats}
    if "lag" in parts:
        for s in spec.sensors:
            for k in spec.lags:
                steps = [f"lag({s}, {j}) OVER ({over})" for j in range(k, 0, -1)]
                made[f"{safe_name(s)}_lag_{k}"] = f"coalesce({', '.join([*steps, s])})" if serving else steps[0]
    if "delta" in parts:
        for s in spec.sensors:
            step = f"{s} - lag({s}, 1) OVER ({over})"
            made[f"{safe_name(s)}_delta"] = f"coalesce({step}, 0)" if serving else step
    return made


def features_cte(spec: SeriesSpec, source: str, **options) -> str:
    made = ", ".join(f"{e} AS {n}" for n, e in feature_exprs(spec, **options).items())
    return f"SELECT {columns(spec)}, {made} FROM {source}"


def rounded_list(names) -> str:
    return ", ".join(r6(n, n) for n in names)


# The deviation of prices, of the order of 1e5, is compared to four places: nine digits.
COARSE = tuple(f"l_extendedprice_roll_std_{w}" for w in LINES.windows)


def rounded_features(names) -> str:
    return ", ".join(f"(round({n}, 4) + 0.0) AS {n}" if n in COARSE else r6(n, n) for n in names)


def split_case(order: str, source_count: str = "count(*) OVER ()") -> str:
    """Split by position in ``order``; cuts as floors of doubles."""
    position = f"(row_number() OVER (ORDER BY {order}) - 1)"
    n = source_count
    return (
        f"CASE WHEN {position} < floor({n} * 0.7::DOUBLE) THEN 'train' "
        f"WHEN {position} < floor({n} * 0.85::DOUBLE) THEN 'val' ELSE 'test' END AS split"
    )


ENTITY_ORDER = f"{LINES.entity}, {order_sql(LINES)}"
TIME_ORDER = f"{LINES.ts}, {LINES.entity}, {', '.join(LINES.tiebreak)}"
LINE_SPLIT = f"SELECT {columns(LINES)}, {split_case(ENTITY_ORDER)} FROM lineitem"


def stats_sql(names, source: str, spread: str = "stddev_pop", digits: int = 8) -> str:
    """``feature, mean, std`` as fitted by the scaler."""
    return " UNION ALL ".join(
        f"SELECT '{n}' AS feature, round(avg({n}), {digits}) + 0.0 AS mean, "
        f"CASE WHEN coalesce(round({spread}({n}), {digits}), 0) = 0 THEN 1.0::DOUBLE "
        f"ELSE round({spread}({n}), {digits}) END AS std FROM {source}"
        for n in names
    )


def rounded_stats(names, source: str, **options) -> str:
    return f"SELECT feature, {r6('mean', 'mean')}, {r6('std', 'std')} FROM ({stats_sql(names, source, **options)})"


def digest(seed: int = 42) -> str:
    return f"md5(concat_ws('|', {', '.join(LINE_KEY)}, '{seed}'))"


# --- decision fixture: three scores per line, three rotations of them ---------

SCORES = ("l_quantity / 50", "l_extendedprice / 105000", "l_discount * 10")
THRESHOLDS = (0.5, 0.25, 0.3)
ROTATIONS = {"rf": (0, 1, 2), "xgb": (1, 2, 0), "lgb": (2, 0, 1)}


def decisions(spark: SparkSession, sf_dir: str, model: str = "rf") -> DataFrame:
    raw = (F.col("l_quantity") / 50, F.col("l_extendedprice") / 105000, F.col("l_discount") * 10)
    parts = [raw[i] + F.lit(1e-3) for i in ROTATIONS[model]]
    total = parts[0] + parts[1] + parts[2]
    y = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2)
    split = F.when(F.col("l_linestatus") == "O", "val").otherwise("test")
    return read(spark, sf_dir, "lineitem").select(
        *LINE_KEY, y.alias("y"), F.array(*[p / total for p in parts]).alias("p"), split.alias("split")
    )


def decisions_sql(model: str = "rf") -> str:
    parts = [f"({SCORES[i]} + 1e-3)" for i in ROTATIONS[model]]
    total = f"({' + '.join(parts)})"
    p = ", ".join(f"{x} / {total} AS p{i}" for i, x in enumerate(parts))
    return (
        f"SELECT {', '.join(LINE_KEY)}, CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS y, {p}, "
        "CASE WHEN l_linestatus = 'O' THEN 'val' ELSE 'test' END AS split FROM lineitem"
    )


def choose_sql(s0: str, s1: str, s2: str) -> str:
    return f"CASE WHEN {s0} >= {s1} AND {s0} >= {s2} THEN 0 WHEN {s1} >= {s2} THEN 1 ELSE 2 END"


PLAIN_SQL = choose_sql("p0", "p1", "p2")
TUNED_SQL = choose_sql(*[f"p{i} / {t}::DOUBLE" for i, t in enumerate(THRESHOLDS)])


def scores_sql(source: str, decision: str, by: str = "") -> str:
    """accuracy, f1_macro, f1_weighted of column ``decision`` against ``y``."""
    lead = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""
      SELECT {lead}sum(tp) / sum(support) AS accuracy, avg(f1) AS f1_macro, sum(f1 * support) / sum(support) AS f1_weighted
      FROM (SELECT {lead}tp, support, CASE WHEN support + said = 0 THEN 0 ELSE 2.0::DOUBLE * tp / (support + said) END AS f1
            FROM (SELECT {lead}c, sum(tp)::DOUBLE AS tp, sum(a)::DOUBLE AS support, sum(s)::DOUBLE AS said
                  FROM (SELECT {lead}y AS c, (y = {decision})::INT AS tp, 1 AS a, 0 AS s FROM {source}
                        UNION ALL SELECT {lead}{decision} AS c, 0, 0, 1 FROM {source})
                  GROUP BY {lead}c))
      {group}"""


# --- attribution fixture: signed distances of the readings to their means -----

ATTRIBUTED = tuple(f for s in LINES.sensors for f in (f"{s}_norm", f"{s}_roll_mean_5_norm"))


def attributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lines(spark, sf_dir)
    means = rows.agg(*[F.avg(s).alias(s) for s in LINES.sensors]).first()
    made = []
    for s in LINES.sensors:
        distance = F.col(s) - F.lit(means[s])
        made += [distance.alias(f"{s}_norm"), (distance * 0.5).alias(f"{s}_roll_mean_5_norm")]
    keep = [*LINE_KEY, "l_returnflag"]
    long = rows.select(*keep, *made).unpivot(keep, list(ATTRIBUTED), "feature", "value")
    return long.withColumnRenamed("l_returnflag", "class")


def _at_arms() -> str:
    arms = []
    for s in LINES.sensors:
        for name, factor in ((f"{s}_norm", "1"), (f"{s}_roll_mean_5_norm", "0.5::DOUBLE")):
            arms.append(
                f"SELECT l_returnflag AS class, '{name}' AS feature, "
                f"({s} - (SELECT avg({s}) FROM lineitem)) * {factor} AS value FROM lineitem"
            )
    return " UNION ALL ".join(arms)


AT_CTE = f"att AS ({_at_arms()})"
SENSOR_CASE = "CASE " + " ".join(f"WHEN feature LIKE '{s}%' THEN '{s}'" for s in LINES.sensors) + " ELSE 'outro' END"
