"""Queries on features, scalers, splits and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesmill.operators import features as feat
from seriesmill.operators import gram, ranks, sample, scale, silver, split
from seriesmill.plans.medallion import gold as to_gold
from seriesmill.registry.book import query, r6, read, tidy
from seriesmill.registry.fixtures import (
    COARSE,
    ENTITY_ORDER,
    LINE_KEY,
    LINE_SILVER,
    LINE_SPLIT,
    LINES,
    TIME_ORDER,
    digest,
    features_cte,
    lines,
    order_sql,
    rounded_features,
    rounded_stats,
    split_case,
    stats_sql,
)
from seriesmill.session import materialise

META = ", ".join(LINES.meta)
KEY = ", ".join(LINE_KEY)
SERVING = LINES.serving()
ZEROED = ", ".join(f"coalesce({n}, 0) AS {n}" for n in LINES.features)


def feature_sql(spec=LINES, tail: str = "", **options) -> str:
    names = [n for n in spec.features if n in spec.sensors or _wanted(n, options)]
    return f"{LINE_SILVER} SELECT {META}, {rounded_features(names)} FROM ({features_cte(spec, 'silver', **options)}) {tail}"


def _wanted(name: str, options: dict) -> bool:
    stats, parts = options.get("stats", ("mean", "std", "min", "max")), options.get("parts", ("roll", "lag", "delta"))
    if "_roll_" in name:
        return "roll" in parts and name.split("_roll_")[1].split("_")[0] in stats
    return ("lag" in parts and "_lag_" in name) or ("delta" in parts and name.endswith("_delta"))


def clean(spark, d):
    """The Silver layer, written as a table as its readers expect."""
    return materialise(silver.silver(lines(spark, d), LINES), "silver")


@query("rolling_mean", feature_sql(stats=("mean",), parts=("roll",)))
def rolling_mean(spark, d):
    return tidy(feat.rolling(clean(spark, d), LINES, ("mean",)), COARSE)


@query("rolling_std", feature_sql(stats=("std",), parts=("roll",)))
def rolling_std(spark, d):
    return tidy(feat.rolling(clean(spark, d), LINES, ("std",)), COARSE)


@query("rolling_minmax", feature_sql(stats=("min", "max"), parts=("roll",)))
def rolling_minmax(spark, d):
    return tidy(feat.rolling(clean(spark, d), LINES, ("min", "max")), COARSE)


@query("lag_features", feature_sql(parts=("lag",)))
def lag_features(spark, d):
    return tidy(feat.lags(clean(spark, d), LINES))


@query("delta", feature_sql(parts=("delta",)))
def delta(spark, d):
    return tidy(feat.deltas(clean(spark, d), LINES))


@query("features", feature_sql())
def features(spark, d):
    return tidy(feat.features(clean(spark, d), LINES), COARSE)


@query(
    "features_drop_any",
    feature_sql(tail=f"WHERE NOT ({' OR '.join(f'{n} IS NULL' for n in LINES.features)})"),
)
def features_drop_any(spark, d):
    return tidy(feat.features(clean(spark, d), LINES, "drop_any"), COARSE)


@query(
    "features_zero",
    f"{LINE_SILVER} SELECT {META}, {rounded_features(LINES.features)} "
    f"FROM (SELECT {META}, {ZEROED} FROM ({features_cte(LINES, 'silver')}))",
)
def features_zero(spark, d):
    return tidy(feat.features(clean(spark, d), LINES, "zero"), COARSE)


def _pairs_sql() -> str:
    """One aggregate per pair of features, then a row for either order of it; a column that does not vary has no correlation."""
    names = LINES.features
    pairs = ", ".join(f'corr({a}, {b}) AS "{a} {b}"' for i, a in enumerate(names) for b in names[i:])
    found = f"SELECT split_part(pair, ' ', 1) AS x, split_part(pair, ' ', 2) AS y, {r6('CASE WHEN isfinite(c) THEN c END', 'corr')} FROM (SELECT {pairs} FROM feats) UNPIVOT INCLUDE NULLS (c FOR pair IN (*))"
    return f"pairs AS ({found}) SELECT x AS a, y AS b, corr FROM pairs UNION ALL SELECT y, x, corr FROM pairs WHERE x <> y"


@query(
    "corr_features",
    f"{LINE_SILVER}, feats AS ({features_cte(LINES, 'silver')}), {_pairs_sql()} UNION ALL SELECT 'pairs', 'pairs', {len(LINES.features) ** 2}::DOUBLE",
)
def corr_features(spark, d):
    """Correlations of all features, lags included, for every ordered pair, and the number of pairs."""
    whole = materialise(gram.corr_of_many(feat.features(clean(spark, d), LINES), LINES.features), "correlations")
    number = whole.agg(F.lit("pairs").alias("a"), F.lit("pairs").alias("b"), F.count(F.lit(1)).cast("double").alias("corr"))
    return tidy(whole.unionByName(number))


@query("features_serving", feature_sql(SERVING, serving=True))
def features_serving(spark, d):
    return tidy(feat.features(clean(spark, d), SERVING, "backfill"), COARSE)


def gold_sql() -> str:
    names = LINES.features
    zeroed = ", ".join(f"coalesce({n}, 0) AS {n}" for n in names)
    means = ", ".join(f"round(avg({n}), 8) AS m{i}, round(stddev_pop({n}), 8) AS s{i}" for i, n in enumerate(names))
    scaled = ", ".join(
        r6(f"({n} - m{i}) / (CASE WHEN coalesce(s{i}, 0) = 0 THEN 1 ELSE s{i} END)", f"{n}_norm")
        for i, n in enumerate(names)
    )
    return f"""{LINE_SILVER}, feats AS ({features_cte(LINES, 'silver')}),
      placed AS (SELECT {META}, {split_case(ENTITY_ORDER)}, {zeroed} FROM feats),
      stats AS (SELECT {means} FROM placed WHERE split = 'train')
      SELECT {META}, split, {scaled} FROM placed, stats"""


@query("gold", gold_sql())
def gold(spark, d):
    return tidy(to_gold(clean(spark, d), LINES)[0])


TRAIN = f"(SELECT * FROM ({LINE_SPLIT}) WHERE split = 'train')"


def train_rows(spark, d):
    rows, names = lines(spark, d), (LINES.entity, LINES.ts, *LINES.tiebreak)
    return rows.where(ranks.rows_before(rows, names, ranks.keys_at(rows, names, split.CUTS)[0]))


@query("fit_scaler", rounded_stats(LINES.sensors, TRAIN))
def fit_scaler(spark, d):
    return tidy(scale.fit_scaler(train_rows(spark, d), LINES.sensors))


@query("fit_scaler_ddof1", rounded_stats(LINES.sensors, TRAIN, spread="stddev_samp", digits=6))
def fit_scaler_ddof1(spark, d):
    return tidy(scale.fit_scaler(train_rows(spark, d), LINES.sensors, ddof=1, round_to=6))


def _scaled_sql(floor: float) -> str:
    scaled = ", ".join(
        r6(
            f"CASE WHEN (SELECT std FROM stats WHERE feature = '{n}') > {floor} THEN ({n} - (SELECT mean FROM stats WHERE feature = '{n}'))"
            f" / (SELECT std FROM stats WHERE feature = '{n}') ELSE 0 END",
            f"{n}_norm",
        )
        for n in LINES.sensors
    )
    return f"WITH stats AS ({stats_sql(LINES.sensors, TRAIN)}) SELECT {META}, split, {scaled} FROM ({LINE_SPLIT})"


@query("zscore", _scaled_sql(0))
def zscore(spark, d):
    rows = split.ordinal_split(lines(spark, d), LINES)
    stats = scale.stats_map(scale.fit_scaler(rows.where("split = 'train'"), LINES.sensors))
    return tidy(scale.zscore(rows, stats, LINES.sensors, [*LINES.meta, "split"]))


@query("zscore_serving", _scaled_sql(1e-9))
def zscore_serving(spark, d):
    rows = split.ordinal_split(lines(spark, d), LINES)
    stats = scale.stats_map(scale.fit_scaler(rows.where("split = 'train'"), LINES.sensors))
    stats = {f"{n}_norm": v for n, v in stats.items()}
    return tidy(scale.zscore_serving(rows, stats, LINES.sensors, [*LINES.meta, "split"]))


@query(
    "minmax",
    f"SELECT {META}, "
    + ", ".join(r6(f"({n} - min({n}) OVER ()) / (max({n}) OVER () - min({n}) OVER () + 1e-8)", f"{n}_minmax") for n in LINES.sensors)
    + " FROM lineitem",
)
def minmax(spark, d):
    return tidy(scale.minmax(lines(spark, d), LINES.sensors, LINES.meta))


@query(
    "robust",
    "WITH q AS (SELECT "
    + ", ".join(f"quantile_cont({n}, [0.25, 0.5, 0.75]) AS q_{n}" for n in LINES.sensors)
    + f" FROM lineitem) SELECT {META}, "
    + ", ".join(r6(f"({n} - q_{n}[2]) / (q_{n}[3] - q_{n}[1] + 1e-8)", f"{n}_robust") for n in LINES.sensors)
    + " FROM lineitem, q",
)
def robust(spark, d):
    return tidy(scale.robust(lines(spark, d), LINES.sensors, LINES.meta))


X = "l_extendedprice"
METHODS = {
    "original": X,
    "zscore": f"({X} - (SELECT avg({X}) FROM lineitem)) / (SELECT stddev_pop({X}) FROM lineitem)",
    "minmax": f"({X} - (SELECT min({X}) FROM lineitem)) / ((SELECT max({X}) FROM lineitem) - (SELECT min({X}) FROM lineitem) + 1e-8)",
    "robust": f"({X} - (SELECT median({X}) FROM lineitem)) / ((SELECT quantile_cont({X}, 0.75) FROM lineitem)"
    f" - (SELECT quantile_cont({X}, 0.25) FROM lineitem) + 1e-8)",
}


@query(
    "scaler_compare",
    " UNION ALL ".join(
        f"SELECT '{m}' AS method, {r6('min(v)', 'min')}, {r6('max(v)', 'max')}, {r6('avg(v)', 'mean')}, "
        f"{r6('stddev_pop(v)', 'std')}, {r6('skewness(v)', 'skew')} FROM (SELECT {e} AS v FROM lineitem)"
        for m, e in METHODS.items()
    ),
)
def scaler_compare(spark, d):
    return tidy(scale.compare_scalers(lines(spark, d), X))


@query("ordinal_split", f"SELECT {META}, split FROM ({LINE_SPLIT})")
def ordinal_split(spark, d):
    return split.ordinal_split(lines(spark, d), LINES).select(*LINES.meta, "split")


@query("time_split", f"SELECT {META}, {split_case(TIME_ORDER)} FROM lineitem")
def time_split(spark, d):
    return split.time_split(lines(spark, d), LINES).select(*LINES.meta, "split")


RANKED = (
    f"SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY h) AS r, count(*) OVER (PARTITION BY l_returnflag) AS n "
    f"FROM (SELECT *, {digest()} AS h FROM lineitem)"
)
PART = "round_even(n * 0.15::DOUBLE, 0)"


@query(
    "stratified_split",
    f"SELECT {KEY}, l_returnflag, CASE WHEN r <= {PART} THEN 'test' WHEN r <= 2 * {PART} THEN 'val' ELSE 'train' END AS split FROM ({RANKED})",
)
def stratified_split(spark, d):
    rows = split.stratified_split(lines(spark, d), LINES.label, LINE_KEY)
    return rows.select(*LINE_KEY, "l_returnflag", "split")


@query(
    "stratified_sample",
    f"SELECT {KEY}, l_returnflag FROM ({RANKED}) "
    "WHERE r <= greatest(1, round_even(n * (10000::DOUBLE / (SELECT count(*) FROM lineitem)), 0))",
)
def stratified_sample(spark, d):
    rows = sample.stratified_sample(lines(spark, d), LINES.label, LINE_KEY, 10_000)
    return rows.select(*LINE_KEY, "l_returnflag")


@query("equal_sample", f"SELECT {KEY}, l_returnflag FROM ({RANKED}) WHERE r <= 500")
def equal_sample(spark, d):
    return sample.equal_sample(lines(spark, d), LINES.label, LINE_KEY, 500).select(*LINE_KEY, "l_returnflag")


@query("sample_cap", f"SELECT {KEY} FROM lineitem ORDER BY {digest()} LIMIT 10000")
def sample_cap(spark, d):
    return sample.sample_cap(lines(spark, d), LINE_KEY, 10_000).select(*LINE_KEY)


@query(
    "downsample",
    f"""SELECT {META} FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY {order_sql(LINES)}) AS r,
        count(*) OVER (PARTITION BY l_suppkey) AS n FROM lineitem) WHERE (r - 1) % (n // 200 + 1) = 0""",
)
def downsample(spark, d):
    return sample.downsample(lines(spark, d), LINES, 200).select(*LINES.meta)


@query(
    "head_per_class",
    f"SELECT {META} FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_returnflag ORDER BY {ENTITY_ORDER}) <= 500",
)
def head_per_class(spark, d):
    return sample.head_per_class(lines(spark, d), LINES, 500).select(*LINES.meta)


@query(
    "union_splits",
    f"WITH s AS ({LINE_SPLIT}) SELECT {META}, split FROM s",
)
def union_splits(spark, d):
    from seriesmill.sources.files import union_missing

    rows = split.ordinal_split(lines(spark, d), LINES).select(*LINES.meta, "split")
    return union_missing([rows.where(F.col("split") == s) for s in split.SPLITS])


@query(
    "missing_classes",
    f"""WITH s AS (SELECT l_partkey, {split_case(ENTITY_ORDER)} FROM lineitem)
        SELECT c.l_partkey, x.split FROM (SELECT DISTINCT l_partkey FROM s) c, (VALUES ('train'), ('val'), ('test')) AS x(split)
        WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.l_partkey = c.l_partkey AND s.split = x.split)""",
)
def missing_classes(spark, d):
    rows = split.ordinal_split(read(spark, d, "lineitem"), LINES)
    return split.missing_classes(rows, "l_partkey")


