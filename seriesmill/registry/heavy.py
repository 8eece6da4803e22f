"""The skew paths: few keys over all rows, so that every key is cut into slices."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesmill.operators import features as feat
from seriesmill.operators import sample, silver
from seriesmill.operators.quantiles import exact_quantiles, long_form
from seriesmill.registry.book import query, r6, tidy
from seriesmill.registry.fixtures import (
    COARSE,
    HEAVY,
    feature_exprs,
    features_cte,
    filled_sql,
    heavy_lines,
    order_sql,
    ranged_sql,
    rounded_features,
    rounded_list,
)

META = ", ".join(HEAVY.meta)
RANGED = f"WITH ranged AS ({ranged_sql(HEAVY, 'lineitem')})"


def ranged(spark, d):
    return silver.null_out_of_range(heavy_lines(spark, d), HEAVY)


@query("heavy_fill", f"{RANGED} SELECT {META}, {rounded_list(HEAVY.sensors)} FROM ({filled_sql(HEAVY, 'ranged')})")
def heavy_fill(spark, d):
    return tidy(silver.fill_series(ranged(spark, d), HEAVY))


NAMES = [*HEAVY.sensors, *feature_exprs(HEAVY)]


@query("heavy_features", f"{RANGED} SELECT {META}, {rounded_features(NAMES)} FROM ({features_cte(HEAVY, 'ranged')})")
def heavy_features(spark, d):
    return tidy(feat.features(ranged(spark, d), HEAVY), COARSE)


@query(
    "heavy_downsample",
    f"""SELECT {META} FROM (SELECT *, row_number() OVER (PARTITION BY l_linestatus ORDER BY {order_sql(HEAVY)}) AS r,
        count(*) OVER (PARTITION BY l_linestatus) AS n FROM lineitem) WHERE (r - 1) % (n // 2000 + 1) = 0""",
)
def heavy_downsample(spark, d):
    return sample.downsample(heavy_lines(spark, d), HEAVY, 2_000).select(*HEAVY.meta)


@query(
    "heavy_quantiles",
    " UNION ALL ".join(
        f"SELECT l_returnflag, '{s}' AS sensor, {r6(f'quantile_cont({s}, 0.25)', 'p25')}, {r6(f'median({s})', 'median')}, "
        f"{r6(f'quantile_cont({s}, 0.99)', 'p99')} FROM lineitem GROUP BY l_returnflag"
        for s in HEAVY.sensors
    ),
)
def heavy_quantiles(spark, d):
    values = long_form(heavy_lines(spark, d), ["l_returnflag"], HEAVY.sensors).where(F.col("value").isNotNull())
    probs = {"p25": 0.25, "median": 0.5, "p99": 0.99}
    return tidy(exact_quantiles(values, ["l_returnflag", "sensor"], probs, few=1_000))
