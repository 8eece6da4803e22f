"""Queries on evaluation, thresholds and attribution summaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from seriesmill.operators import attribution, evaluate, report, threshold
from seriesmill.operators.model import label_index as to_label_index
from seriesmill.registry.book import query, r6, read, tidy
from seriesmill.registry.fixtures import (
    AT_CTE,
    CLASSES,
    LINE_KEY,
    LINES,
    PLAIN_SQL,
    ROTATIONS,
    SENSOR_CASE,
    THRESHOLDS,
    TUNED_SQL,
    attributions,
    choose_sql,
    decisions,
    decisions_sql,
    lines,
    scores_sql,
)

KEY = ", ".join(LINE_KEY)
DECIDED = f"(SELECT *, {PLAIN_SQL} AS plain, {TUNED_SQL} AS tuned FROM ({decisions_sql()}))"
INDEXES = (0, 1, 2)


def decided(spark, d, model="rf"):
    return decisions(spark, d, model).withColumns(
        {"plain": threshold.argmax(F.col("p")), "tuned": threshold.decide(F.col("p"), THRESHOLDS)}
    )


@query(
    "class_weights",
    f"""SELECT l_returnflag, count(*) AS n, {r6('sum(count(*)) OVER ()::DOUBLE / (count(*) OVER () * count(*))', 'weight')}
        FROM lineitem GROUP BY l_returnflag""",
)
def class_weights(spark, d):
    return tidy(evaluate.class_weights(lines(spark, d), "l_returnflag"))


@query(
    "weighted_rows",
    f"""SELECT {KEY}, {r6("(SELECT count(*) FROM lineitem)::DOUBLE / ((SELECT count(DISTINCT l_returnflag) FROM lineitem) * n)", 'weight')}
        FROM lineitem JOIN (SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY 1) USING (l_returnflag)""",
)
def weighted_rows(spark, d):
    return tidy(evaluate.with_weights(lines(spark, d), "l_returnflag").select(*LINE_KEY, "weight"))


def confusion_sql(cells: str, by: str = "") -> str:
    lead = f"{by}, " if by else ""
    values = ", ".join(f"({i})" for i in INDEXES)
    frame = f"(SELECT DISTINCT {by} FROM {cells})," if by else ""
    match = f"AND c.{by} = g.{by}" if by else ""
    return f"""WITH cells AS (SELECT {lead}y, chosen, count(*) AS n FROM {cells} GROUP BY ALL),
      grid AS (SELECT {lead}a.v AS actual, b.v AS predicted FROM {frame} (VALUES {values}) AS a(v), (VALUES {values}) AS b(v)),
      f AS (SELECT g.*, coalesce(c.n, 0) AS n FROM grid g LEFT JOIN cells c ON c.y = g.actual AND c.chosen = g.predicted {match})
      SELECT {lead}actual, predicted, n, {r6(f'coalesce(n * 100.0::DOUBLE / nullif(sum(n) OVER (PARTITION BY {lead}actual), 0), 0)', 'pct')} FROM f"""


@query("confusion", confusion_sql(f"(SELECT y, plain AS chosen FROM {DECIDED})"))
def confusion(spark, d):
    cells = evaluate.counts(decided(spark, d), "y", "plain")
    return tidy(evaluate.confusion(cells, INDEXES))


@query(
    "confusion_pair",
    confusion_sql(
        f"(SELECT 'plain' AS decision, y, plain AS chosen FROM {DECIDED} UNION ALL SELECT 'tuned', y, tuned FROM {DECIDED})",
        "decision",
    ),
)
def confusion_pair(spark, d):
    cells = evaluate.compare_decisions(decided(spark, d), "y", ["plain", "tuned"])
    return tidy(evaluate.confusion(cells, INDEXES, ["decision"]))


def report_sql(source: str, y: str, said: str, classes) -> str:
    values = ", ".join(f"({c})" for c in classes)
    return f"""WITH r AS (SELECT c.v AS class, sum((({y}) = c.v AND ({said}) = c.v)::INT)::BIGINT AS tp, sum((({y}) = c.v)::INT)::BIGINT AS support,
        sum((({said}) = c.v)::INT)::BIGINT AS n_predicted FROM {source}, (VALUES {values}) AS c(v) GROUP BY 1)
      SELECT class, tp, support, n_predicted, {r6('coalesce(tp::DOUBLE / nullif(n_predicted, 0), 0)', 'precision')},
        {r6('coalesce(tp::DOUBLE / nullif(support, 0), 0)', 'recall')}, {r6('coalesce(2.0::DOUBLE * tp / nullif(support + n_predicted, 0), 0)', 'f1')} FROM r"""


@query("class_report", report_sql(DECIDED, "y", "tuned", (0, 1, 2, 3)))
def class_report(spark, d):
    cells = evaluate.counts(decided(spark, d), "y", "tuned")
    return tidy(evaluate.class_report(cells, (0, 1, 2, 3)))


@query("class_report_binary", report_sql("labels", "quality", "1 - toxic", (0, 1)))
def class_report_binary(spark, d):
    rows = read(spark, d, "labels").select("quality", (1 - F.col("toxic")).alias("said"))
    return tidy(evaluate.class_report(evaluate.counts(rows, "quality", "said")))


@query(
    "f1_summary",
    f"SELECT {', '.join(r6(c, c) for c in ('accuracy', 'f1_macro', 'f1_weighted'))} FROM ({scores_sql(DECIDED, 'plain')})",
)
def f1_summary(spark, d):
    return tidy(evaluate.f1_summary(evaluate.counts(decided(spark, d), "y", "plain")))


@query(
    "evaluate_pair",
    f"""SELECT {', '.join(r6(f'{s}.{c}', f'{n}_{c}') for s, n in (('b', 'baseline'), ('t', 'tuned')) for c in ('accuracy', 'f1_weighted', 'f1_macro'))},
        {r6('t.f1_macro - b.f1_macro', 'delta_f1_macro')} FROM ({scores_sql(DECIDED, 'plain')}) b, ({scores_sql(DECIDED, 'tuned')}) t""",
)
def evaluate_pair(spark, d):
    return tidy(evaluate.evaluate_pair(decided(spark, d), "y", "plain", "tuned"))


SENSOR_SUMS = f"""WITH {AT_CTE}, g AS (SELECT feature, avg(abs(value)) AS mean_abs FROM att GROUP BY 1),
  s AS (SELECT {SENSOR_CASE} AS sensor, sum(mean_abs) AS importance FROM g GROUP BY 1)"""


def _model_sql() -> str:
    base, tuned = [], []
    for m in ROTATIONS:
        rows = f"(SELECT *, {PLAIN_SQL} AS plain, {TUNED_SQL} AS tuned FROM ({decisions_sql(m)}))"
        base.append(f"SELECT '{m}' AS model, * FROM ({scores_sql(rows, 'plain', 'split')})")
        if m != "lgb":
            test = f"(SELECT * FROM {rows} WHERE split = 'test')"
            tuned.append(f"SELECT '{m}' AS model, f1_macro AS f1_tuned FROM ({scores_sql(test, 'tuned')})")
    return f"""WITH b AS ({' UNION ALL '.join(base)}), t AS ({' UNION ALL '.join(tuned)}),
      w AS (SELECT model, max(f1_macro) FILTER (split = 'val') AS f1_val, max(f1_macro) FILTER (split = 'test') AS f1_test,
                   max(accuracy) FILTER (split = 'test') AS accuracy_test FROM b GROUP BY model)
      SELECT model, top_sensor, {r6('top_sensor_pct', 'top_sensor_pct')}, {r6('f1_val', 'f1_val')}, {r6('f1_test', 'f1_test')}, {r6('accuracy_test', 'accuracy_test')},
             {r6('coalesce(f1_tuned, f1_test)', 'f1_tuned')}, {r6('greatest((coalesce(f1_tuned, f1_test) - f1_test) * 100, 0)', 'gain_points')}
      FROM w LEFT JOIN t USING (model) LEFT JOIN (
        {SENSOR_SUMS}, p AS (SELECT sensor, importance * 100 / sum(importance) OVER () AS pct FROM s)
        SELECT 'lgb' AS model, max(pct) AS top_sensor_pct, arg_max(sensor, pct) AS top_sensor FROM p) USING (model)"""


@query("model_report", _model_sql())
def model_report(spark, d):
    base, tuned = [], []
    for m in ROTATIONS:
        rows = decided(spark, d, m)
        scores = evaluate.f1_summary(evaluate.counts(rows, "y", "plain", ["split"]), ["split"])
        base.append(scores.withColumn("model", F.lit(m)))
        if m != "lgb":
            best = evaluate.f1_summary(evaluate.counts(rows.where("split = 'test'"), "y", "tuned"))
            tuned.append(best.select(F.lit(m).alias("model"), F.col("f1_macro").alias("f1_tuned")))

    def union(parts):
        return reduce(lambda a, b: a.unionByName(b), parts)

    shares = attribution.sensor_importance(attribution.global_importance(attributions(spark, d)), LINES.sensors)
    return tidy(report.model_report(union(base), union(tuned), shares.withColumn("model", F.lit("lgb"))))


def _metrics_sql() -> str:
    sides = " UNION ALL ".join(
        f"SELECT '{m}' AS model, * FROM ({scores_sql(f'(SELECT *, {PLAIN_SQL} AS plain FROM ({decisions_sql(m)}))', 'plain', 'split')})"
        for m in ROTATIONS
    )
    return f"""WITH {AT_CTE}, b AS ({sides}),
      t AS (SELECT feature FROM att GROUP BY feature ORDER BY avg(abs(value)) DESC, feature LIMIT 5)
      SELECT model, split, {r6('accuracy', 'accuracy')}, {r6('f1_weighted', 'f1_weighted')}, {r6('f1_macro', 'f1_macro')},
             (SELECT string_agg(feature, ',' ORDER BY feature) FROM t) AS features FROM b"""


@query("metrics_json", _metrics_sql())
def metrics_json(spark, d):
    base = [
        evaluate.f1_summary(evaluate.counts(decided(spark, d, m), "y", "plain", ["split"]), ["split"]).withColumn(
            "model", F.lit(m)
        )
        for m in ROTATIONS
    ]
    overall = attribution.global_importance(attributions(spark, d)).withColumnRenamed("mean_abs", "importance")
    models = F.explode(F.array(*[F.lit(m) for m in ROTATIONS])).alias("model")
    documents = report.metrics_documents(reduce(lambda a, b: a.unionByName(b), base), overall.select("*", models))
    back = report.metrics_from_documents(documents)
    named = F.concat_ws(",", F.sort_array("top5_features")).alias("features")
    return tidy(back.select("model", "split", "accuracy", "f1_weighted", "f1_macro", named))


@query(
    "label_index",
    "SELECT l_returnflag, (row_number() OVER (ORDER BY l_returnflag) - 1)::INT AS idx FROM (SELECT DISTINCT l_returnflag FROM lineitem)",
)
def label_index(spark, d):
    return to_label_index(lines(spark, d), "l_returnflag")


@query("threshold_decide", f"SELECT {KEY}, tuned FROM {DECIDED}")
def threshold_decide(spark, d):
    return decided(spark, d).select(*LINE_KEY, "tuned")


def grid_sql(steps: int) -> str:
    return ", ".join(f"({i}, {t!r}::DOUBLE)" for i, t in enumerate(threshold.grid(steps)))


def at_grid(index: int) -> str:
    t = [f"{v}::DOUBLE" for v in THRESHOLDS]
    t[index] = "threshold"
    return choose_sql(*[f"p{i} / {x}" for i, x in enumerate(t)])


def swept(index: int, steps: int) -> str:
    return f"(SELECT step, threshold, y, {at_grid(index)} AS said FROM ({decisions_sql()}), (VALUES {grid_sql(steps)}) AS g(step, threshold))"


@query(
    "threshold_sweep",
    f"WITH swept AS MATERIALIZED (SELECT * FROM {swept(1, 50)}) "
    f"SELECT step, {r6('threshold', 'threshold')}, {r6('f1_macro', 'f1_macro')} FROM ({scores_sql('swept', 'said', 'step, threshold')})",
)
def threshold_sweep(spark, d):
    return tidy(threshold.sweep(decisions(spark, d), "y", "p", 1, THRESHOLDS, 50))


@query(
    "threshold_curve",
    f"""WITH c AS (SELECT step, threshold, count(*) FILTER (y = 2 AND said = 2)::DOUBLE AS tp, count(*) FILTER (y = 2) AS support,
                  count(*) FILTER (said = 2) AS n FROM {swept(2, 80)} GROUP BY 1, 2)
        SELECT step, {r6('threshold', 'threshold')}, {r6('coalesce(tp / nullif(n, 0), 0)', 'precision')},
               {r6('coalesce(tp / nullif(support, 0), 0)', 'recall')}, {r6('coalesce(2 * tp / nullif(support + n, 0), 0)', 'f1')} FROM c""",
)
def threshold_curve(spark, d):
    return tidy(threshold.curve(decisions(spark, d), "y", "p", 2, THRESHOLDS, 80))


@query("tune")
def tune(spark, d):
    best = threshold.tune(decisions(spark, d), "y", "p", 3)
    return spark.createDataFrame(list(zip(CLASSES, best)), "class string, threshold double")


@query("top_features", f"WITH {AT_CTE} SELECT feature, {r6('avg(abs(value))', 'mean_abs')} FROM att GROUP BY 1 ORDER BY avg(abs(value)) DESC, feature LIMIT 5")
def top_features(spark, d):
    overall = attribution.global_importance(attributions(spark, d))
    return tidy(attribution.top_features(overall, "mean_abs", 5))


BY_CLASS = f"WITH {AT_CTE}, c AS (SELECT class, feature, avg(abs(value)) AS mean_abs FROM att GROUP BY 1, 2)"
TOP = "row_number() OVER (PARTITION BY class ORDER BY mean_abs DESC, feature)::INT"


@query(
    "top_per_class",
    f"{BY_CLASS} SELECT class, feature, {r6('mean_abs', 'mean_abs')}, {TOP} AS rank FROM c QUALIFY {TOP} <= 3",
)
def top_per_class(spark, d):
    return tidy(attribution.top_per_class(attribution.class_importance(attributions(spark, d)), 3))


@query("attr_global", f"WITH {AT_CTE} SELECT feature, {r6('avg(abs(value))', 'mean_abs')} FROM att GROUP BY feature")
def attr_global(spark, d):
    return tidy(attribution.global_importance(attributions(spark, d)))


@query(
    "attr_sensor",
    f"{SENSOR_SUMS} SELECT sensor, {r6('importance', 'importance')}, {r6('importance * 100 / sum(importance) OVER ()', 'pct')} FROM s",
)
def attr_sensor(spark, d):
    overall = attribution.global_importance(attributions(spark, d))
    return tidy(attribution.sensor_importance(overall, LINES.sensors))


CLASS_SENSOR = f"""{BY_CLASS}, s AS (SELECT class, {SENSOR_CASE} AS sensor, sum(mean_abs) AS importance FROM c GROUP BY 1, 2),
  p AS (SELECT class, sensor, importance * 100 / sum(importance) OVER (PARTITION BY class) AS pct FROM s)"""


@query(
    "attr_sensor_class",
    f"""{CLASS_SENSOR} SELECT sensor, {', '.join(r6(f"coalesce(max(pct) FILTER (class = '{c}'), 0)", f'"{c}"') for c in CLASSES)}
        FROM p GROUP BY sensor""",
)
def attr_sensor_class(spark, d):
    shares = attribution.sensor_by_class(attribution.class_importance(attributions(spark, d)), LINES.sensors)
    return tidy(attribution.sensor_class_matrix(shares, LINES.sensors, CLASSES))


@query(
    "attr_report",
    f"""{CLASS_SENSOR}, t AS (SELECT class, feature, {SENSOR_CASE} AS sensor, mean_abs, {TOP} AS rank FROM c QUALIFY {TOP} <= 10)
        SELECT class, sensor, rank, replace(feature, '_norm', '') AS name, feature, {r6('mean_abs', 'mean_abs')}, round(pct, 1) AS sensor_pct
        FROM t JOIN p USING (class, sensor)""",
)
def attr_report(spark, d):
    return tidy(attribution.attribution_report(attributions(spark, d), LINES.sensors))
