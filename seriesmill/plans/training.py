"""From Gold to tuned, explained models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill.operators import attribution, boosting, evaluate, model, sample, threshold
from seriesmill.operators.report import metrics_documents, model_report, require_gates, thresholds_document
from seriesmill.operators.split import resplit_if_needed
from seriesmill.session import materialise
from seriesmill.sources.files import union_missing, write_json
from seriesmill.spec import SeriesSpec

TRAINERS = {
    "rf": lambda df, label, names, **p: model.train_forest(df, label, names, **p),
    "xgb": lambda df, label, names, **p: model.train_boosted(df, label, names, **p),
    "lgb": lambda df, label, names, **p: model.train_boosted(df, label, names, defaults=boosting.BY_LEAF, **p),
}


def train_and_tune(
    gold: DataFrame,
    spec: SeriesSpec,
    features: Sequence[str],
    key: Sequence[str],
    models: Sequence[str] = ("rf", "xgb", "lgb"),
    max_train_rows: int | None = 500_000,
    min_features: int = 10,
    steps: int = 50,
    params: dict[str, dict] | None = None,
) -> dict:
    """Gate, split, fit, tune on validation, score on validation and test.

    Models are fitted on at most ``max_train_rows`` rows of the train split, in the proportions of its classes.
    Every validation row counts for the thresholds (and for the rounds of boosting) and every validation and test
    row for the scores.
    """
    require_gates(gold, min_features=min_features)
    rows = resplit_if_needed(gold, spec, key)
    if max_train_rows:
        train = sample.stratified_sample(rows.where("split = 'train'"), spec.label, key, max_train_rows)
        rows = train.unionByName(rows.where("split <> 'train'"))
    rows = materialise(rows, "training-rows")
    fitted, base, tuned, thresholds = {}, None, None, {}
    both: dict[str, DataFrame] = {}
    confusions: dict[str, DataFrame] = {}
    for name in models:
        one = TRAINERS[name](rows, spec.label, features, **(params or {}).get(name, {}))
        fitted[name] = one
        scored = materialise(score_index(one, rows.where("split <> 'train'"), spec.label), "scored")
        best = threshold.tune(scored.where("split = 'val'"), "y", "p", len(one.labels), steps)
        thresholds[name] = dict(zip(one.labels, best, strict=True))
        decided = scored.withColumns(
            {"plain": threshold.argmax(F.col("p")), "tuned": threshold.decide(F.col("p"), best)}
        )
        scores = evaluate.f1_summary(evaluate.counts(decided, "y", "plain", ["split"]), ["split"])
        scores = scores.withColumn("model", F.lit(name))
        after = evaluate.f1_summary(evaluate.counts(decided, "y", "tuned", ["split"]), ["split"])
        both[name] = materialise(tuning_scores(scores.drop("model"), after), "tuning")
        confusions[name] = materialise(
            decided.groupBy("split", F.col("y").alias("actual"), "plain", "tuned").agg(F.count(F.lit(1)).alias("n")), "confusion"
        )
        gained = after.where("split = 'test'").select(F.lit(name).alias("model"), F.col("f1_macro").alias("f1_tuned"))
        base = scores if base is None else base.unionByName(scores)
        tuned = gained if tuned is None else tuned.unionByName(gained)
    return {
        "models": fitted,
        "thresholds": thresholds,
        "scores": base,
        "report": model_report(base, tuned),
        "tuning": both,
        "confusions": confusions,
        "rows": rows,
    }


def tuning_scores(before: DataFrame, after: DataFrame) -> DataFrame:
    """Per split: each score with plain and with tuned decisions, and the difference."""
    names = [c for c in before.columns if c != "split"]
    joined = before.alias("b").join(after.alias("a"), "split")
    made = [F.struct(F.col(f"b.{c}").alias("baseline"), F.col(f"a.{c}").alias("tuned"), (F.col(f"a.{c}") - F.col(f"b.{c}")).alias("delta")).alias(c) for c in names]
    return joined.select("split", *made)


def write_reports(done: dict, out: str) -> None:
    """Save the models, and their metrics, thresholds and comparison as JSON."""
    spark = done["rows"].sparkSession
    for name, fitted in done["models"].items():
        fitted.save(spark, f"{out}/models/{name}")
    tables = [m.importance(spark).withColumn("model", F.lit(n)) for n, m in done["models"].items()]
    write_json(metrics_documents(done["scores"], union_missing(tables)), f"{out}/metrics")
    write_json(thresholds_document(done["thresholds"], spark), f"{out}/thresholds")
    write_json(done["report"], f"{out}/report")
    for name, table in done["tuning"].items():
        write_json(table, f"{out}/tuning/{name}")
        cells = done["confusions"][name]
        write_json(cells, f"{out}/confusion/{name}")
        for side in ("plain", "tuned"):
            one = cells.groupBy("split", "actual", F.col(side).alias("predicted")).agg(F.sum("n").alias("n"))
            write_json(evaluate.class_report(one, by=["split"]), f"{out}/class_report/{name}/{side}")


def score_index(fitted: model.EventModel, rows: DataFrame, label: str) -> DataFrame:
    """``y``, the label index, and ``p`` for every row, with its split."""
    index = F.array_position(F.array(*[F.lit(x) for x in fitted.labels]), F.col(label)) - 1
    return fitted.probabilities(rows).select(index.cast("int").alias("y"), "p", "split")


def explain(
    rows: DataFrame, fitted: model.EventModel, label: str, key: Sequence[str], per_class: int | None = None
) -> DataFrame:
    """Attributions of all rows, written once for their summaries; of ``per_class`` rows of each class if asked for."""
    chosen = sample.equal_sample(rows, label, key, per_class) if per_class else rows
    return materialise(attribution.attribute(chosen, fitted, list(key)), "attributions")
