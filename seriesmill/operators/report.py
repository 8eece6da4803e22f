"""Gates and summaries that join the results of other operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seriesmill.operators.profile import discriminative, imbalance, null_pct
from seriesmill.operators.split import SPLITS
from seriesmill.spec import SeriesSpec


def quality_gates(df: DataFrame, split: str = "split", min_features: int = 10) -> DataFrame:
    """Checks of a Gold table from one aggregate: ``check, passed, value``."""
    n_features = sum(c.endswith("_norm") for c in df.columns)
    seen = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(split) == s).alias(s) for s in SPLITS],
    )
    splits_present = sum(((F.col(s) > 0).cast("int") for s in SPLITS), F.lit(0))
    checks = [
        ("splits_present", splits_present, F.lit(len(SPLITS))),
        ("rows", F.col("rows"), F.lit(1)),
        ("norm_features", F.lit(n_features), F.lit(min_features)),
        ("train_rows", F.col("train"), F.lit(1)),
    ]
    made = [
        F.struct(
            F.lit(name).alias("check"),
            (value.cast("bigint") >= least.cast("bigint")).alias("passed"),
            value.cast("bigint").alias("value"),
        )
        for name, value, least in checks
    ]
    return seen.select(F.inline(F.array(*made)))


def require_gates(df: DataFrame, **kwargs) -> None:
    failed = [r["check"] for r in quality_gates(df, **kwargs).where("NOT passed").collect()]
    if failed:
        raise ValueError(f"quality gates failed: {', '.join(failed)}")


def model_report(base: DataFrame, tuned: DataFrame, sensors: DataFrame | None = None) -> DataFrame:
    """Validation and test scores per model, the tuned score and the gain in points.

    ``base`` has ``model, split, accuracy, f1_weighted, f1_macro``; ``tuned`` has
    ``model, f1_tuned``; ``sensors``, if given, ``model, sensor, pct``, of which the
    strongest sensor is shown.  A model that was not tuned keeps its score.
    """

    def pick(split: str, column: str):
        return F.max(F.when(F.col("split") == split, F.col(column)))

    wide = base.groupBy("model").agg(
        pick("val", "f1_macro").alias("f1_val"),
        pick("test", "f1_macro").alias("f1_test"),
        pick("test", "accuracy").alias("accuracy_test"),
    )
    joined = wide.join(tuned.select("model", "f1_tuned"), "model", "left")
    if sensors is not None:
        top = sensors.groupBy("model").agg(
            F.max_by("sensor", F.struct("pct", "sensor")).alias("top_sensor"), F.max("pct").alias("top_sensor_pct")
        )
        joined = joined.join(top, "model", "left")
    best = F.coalesce("f1_tuned", "f1_test")
    return joined.withColumns(
        {"f1_tuned": best, "gain_points": F.greatest((best - F.col("f1_test")) * 100.0, F.lit(0.0))}
    )


_SCORES = "struct<accuracy: double, f1_weighted: double, f1_macro: double>"
METRICS_SCHEMA = f"model string, val {_SCORES}, test {_SCORES}, top5_features array<string>"


def metrics_documents(base: DataFrame, importance: DataFrame, top: int = 5) -> DataFrame:
    """One JSON document per model: its scores on both splits and its strongest features.

    ``importance`` has ``model, feature, importance``.
    """

    def scores(split: str):
        return F.max(F.when(F.col("split") == split, F.struct("accuracy", "f1_weighted", "f1_macro")))

    wide = base.groupBy("model").agg(scores("val").alias("val"), scores("test").alias("test"))
    w = Window.partitionBy("model").orderBy(F.col("importance").desc(), "feature")
    ranked = importance.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= top)
    named = ranked.groupBy("model").agg(F.sort_array(F.collect_list(F.struct("_rank", "feature"))).alias("_top"))
    joined = wide.join(named, "model", "left").withColumn("top5_features", F.col("_top.feature"))
    return joined.select(F.to_json(F.struct("model", "val", "test", "top5_features")).alias("document"))


def metrics_from_documents(documents: DataFrame) -> DataFrame:
    """Back to ``model, split, accuracy, f1_weighted, f1_macro, top5_features``."""
    read = documents.select(F.from_json("document", METRICS_SCHEMA).alias("m")).select("m.*")
    sides = F.array(
        *[F.struct(F.lit(s).alias("split"), F.col(s).alias("s")) for s in ("val", "test")]
    )
    return read.select("model", "top5_features", F.inline(sides)).select("model", "split", "s.*", "top5_features")


def thresholds_document(thresholds: dict[str, dict], spark: SparkSession) -> DataFrame:
    """``model`` and a JSON map of class to threshold."""
    rows = [(m, {str(c): float(t) for c, t in by_class.items()}) for m, by_class in thresholds.items()]
    table = spark.createDataFrame(rows, "model string, thresholds map<string, double>")
    return table.select("model", F.to_json("thresholds").alias("document"))


def thresholds_from_document(documents: DataFrame) -> DataFrame:
    parsed = F.from_json("document", "map<string, double>")
    return documents.select("model", F.explode(parsed).alias("class", "threshold"))


def exec_summary(df: DataFrame, spec: SeriesSpec, feature_count: int, split: str = "split") -> DataFrame:
    """One row: size, balance, worst missing share, best sensor, features, split sizes."""
    balance = imbalance(df, spec.label).select("classes", "ratio")
    gaps = null_pct(df, spec.sensors).agg(F.max("null_pct").alias("worst_null_pct"))
    best = discriminative(df, spec).where("rank = 1").select(F.col("sensor").alias("best_sensor"))
    sizes = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(F.col(split) == s).alias(f"n_{s}") for s in SPLITS],
    )
    one = F.lit(1).alias("_one")
    result = sizes.select("*", one)
    for part in (balance, gaps, best):
        result = result.join(part.select("*", one), "_one")
    return result.drop("_one").withColumn("features", F.lit(feature_count))
