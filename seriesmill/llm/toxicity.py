"""Toxicity by a classifier chain of linear models.

Categories are predicted one after the other: the model of each takes the features of the text and the probabilities
of the categories before it.  For training, those probabilities are out of fold: each row's comes from a model
that has not seen the row, so later models learn how far earlier ones can be trusted.

Features are the presence of words and of word beginnings, by their hash in a space of fixed width.  The models are logistic
regressions on features scaled by how much more often they come with the category than without it (log of the
ratio), rows weighted so that both kinds count alike, with an L2 penalty.  They are fitted, each by one task, on a bounded
sample of labelled rows: the ``max_rows`` with the smallest hash of their id.  Every document is scored, whole.

Edge cases: null and blank texts are not toxic.  Labels that are null or whose document is missing are left out; repeated
labels count each for itself.  A category without labels of both kinds gets their share (0 without labels) for
every text.  Repeated rows are scored each for itself, very long texts as a whole; an empty table gives an empty one.
Further columns are ignored by ``score``, kept by ``reject``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesmill.llm.common import PER_CALL, broadcast_checked, give_back
from seriesmill.session import materialise

CHAIN = ("low_quality", "toxic")
MAX_ROWS = 10_000  # labelled rows that the models are fitted on
FOLDS = 3
WIDTH = 1 << 20  # of the space of features
LEAST_DOCS = 5  # labelled texts that hold a feature
LEAST_RATIO = 0.1  # log of how much more often a feature comes with the category, or without it
BEGINNING = 4  # characters
PENALTY = 1.0  # on the squared weights, against the sum over rows
STEPS = 80
NEAR = 0.5


@dataclass
class Linear:
    """Weights of the features that have one, of the categories before, and what is added to them."""

    features: np.ndarray
    weights: np.ndarray
    before: np.ndarray
    bias: float
    _dense: np.ndarray | None = None

    def dense(self) -> np.ndarray:
        """The weights of the whole space, made once a worker."""
        if self._dense is None:
            self._dense = np.zeros(WIDTH)
            self._dense[self.features] = self.weights
        return self._dense


@dataclass
class Chain:
    """Fitted models, in order; a category without a model has a fixed share."""

    models: dict[str, Linear | float] = field(default_factory=dict)

    def predict(self, df: DataFrame) -> DataFrame:
        """The columns of ``df``, ``_terms`` replaced by ``_p_<category>`` for every category.

        Rows wait in memory for what Python makes of their terms, so ``df`` should not have the text twice.
        """
        models = list(self.models.values())

        @F.arrow_udf("array<double>")
        def chances(terms: pa.Array) -> pa.Array:
            give_back()  # what earlier work of this worker has freed
            made = [np.empty((0, len(models)))]
            for first in range(0, len(terms), PER_CALL):
                part = terms.slice(first, PER_CALL)
                ends = np.asarray(part.offsets)
                made.append(_chances(models, np.asarray(part.flatten()), ends - ends[0]))
            return pa.ListArray.from_arrays(np.arange(len(terms) + 1, dtype=np.int32) * len(models), np.concatenate(made).ravel())

        made = df.withColumn("_p", chances("_terms")).drop("_terms")
        return made.select("*", *[F.get("_p", F.lit(i)).alias(f"_p_{c}") for i, c in enumerate(self.models)]).drop("_p")


def _chances(models: Sequence[Linear | float], terms: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Probabilities (row, category) of rows whose features follow one another in ``terms``, up to ``ends``."""
    made = np.zeros((len(ends) - 1, len(models)))
    for i, model in enumerate(models):
        made[:, i] = _alone(model, terms, ends, made[:, :i])
    return made


def _chance(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500.0, 500.0)))


def terms(text: Column) -> Column:
    """Distinct words and word beginnings of a text."""
    words = F.array_distinct(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"))
    words = F.filter(words, lambda w: w != "")
    return F.concat(words, F.array_distinct(F.transform(words, lambda w: F.concat(F.lit("^"), F.substring(w, 1, BEGINNING)))))


def hashed(text: Column) -> Column:
    """The terms of a text as numbers below WIDTH."""
    return F.array_distinct(F.transform(terms(text), lambda t: F.pmod(F.xxhash64(t), F.lit(WIDTH)).cast("int")))


def fit_linear(terms: np.ndarray, ends: np.ndarray, before: np.ndarray, y: np.ndarray, penalty: float = PENALTY) -> Linear | float:
    """One model: accelerated gradient steps on the weighted logistic loss; the share of the category where there is nothing to tell."""
    n, positive = len(y), float(y.sum())
    if not 0 < positive < n:
        return positive / n if n else 0.0
    sizes = np.diff(ends)
    counts = np.bincount(terms, minlength=WIDTH)
    hits = np.bincount(terms, np.repeat(y, sizes), WIDTH)
    ratio = np.log((hits + 1.0) / (positive + 2.0)) - np.log((counts - hits + 1.0) / (n - positive + 2.0))
    # features that tell nothing go; entries by row, and the same entries by feature, as stretches to be added up
    used = np.flatnonzero((counts >= LEAST_DOCS) & (np.abs(ratio) >= LEAST_RATIO))
    place = np.full(WIDTH, -1, dtype=np.int32)
    place[used] = np.arange(len(used))
    ratio, at = ratio[used], place[terms]
    row = np.repeat(np.arange(n, dtype=np.int32), sizes)[at >= 0]
    at = at[at >= 0]
    by_feature = np.argsort(at, kind="stable")
    feature_starts = np.searchsorted(at, np.arange(len(used)), sorter=by_feature)
    back_row = row[by_feature]
    del by_feature
    rows, row_starts = np.unique(row, return_index=True)
    weight = np.where(y == 1, n / (2 * positive), n / (2 * (n - positive))) / n
    x = np.zeros(len(used) + before.shape[1] + 1)  # features, categories before, bias
    f, width = len(used), len(x)

    def margin(w):
        made = before @ w[f:-1] + w[-1]
        if f:
            made[rows] += np.add.reduceat((ratio * w[:f])[at], row_starts)
        return made

    def back(g):
        sums = np.add.reduceat(g[back_row], feature_starts) * ratio if f else ratio
        return np.concatenate((sums, before.T @ g, [g.sum()]))

    # largest curvature, by powers from a fixed start
    v = np.ones(width)
    for _ in range(20):
        v = back(0.25 * weight * margin(v / np.linalg.norm(v)))
    step = 1.0 / (1.1 * np.linalg.norm(v) + penalty / n)
    ridge = np.zeros(width)
    ridge[:f] = penalty / n
    ahead, turn = x, 1.0
    for _ in range(STEPS):
        slope = back(weight * (_chance(margin(ahead)) - y)) + ridge * ahead
        new = ahead - step * slope
        later = (1.0 + (1.0 + 4.0 * turn * turn) ** 0.5) / 2.0
        ahead, x, turn = new + (turn - 1.0) / later * (new - x), new, later
    weights = x[:f] * ratio
    some = weights != 0.0
    return Linear(used[some], weights[some], x[f:-1], float(x[-1]))


def _alone(model: Linear | float, terms: np.ndarray, ends: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Probabilities by one model."""
    if isinstance(model, float):
        return np.full(len(ends) - 1, model)
    upto = np.concatenate(([0.0], np.cumsum(model.dense()[terms])))
    return _chance(upto[ends[1:]] - upto[ends[:-1]] + before @ model.before + model.bias)


def out_of_fold(terms: np.ndarray, ends: np.ndarray, fold: np.ndarray, unseen: Sequence[Sequence[Linear | float]]) -> np.ndarray:
    """Probabilities (row, category) of the categories so far, each by the model that has not seen the row's fold."""
    made = np.zeros((len(fold), len(unseen)))
    for i, models in enumerate(unseen):
        for k, model in enumerate(models):
            there = fold == k
            inside = np.repeat(there, np.diff(ends))
            stops = np.concatenate(([0], np.cumsum(np.diff(ends)[there])))
            made[there, i] = _alone(model, terms[inside], stops, made[there, :i])
    return made


def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """``terms``, ``fold`` and the categories of a bounded sample of labelled documents."""
    marked = labels.select(
        F.col("doc_id").alias("_id"), (1 - F.col("quality").cast("int")).alias("low_quality"), F.col("toxic").cast("int").alias("toxic")
    )
    whole = marked.where("_id IS NOT NULL AND low_quality IS NOT NULL AND toxic IS NOT NULL")
    sample = materialise(whole.orderBy(F.xxhash64("_id"), "_id", "low_quality", "toxic").limit(max_rows), "labels")
    texts = docs.select("doc_id", "text")
    joined = texts.join(broadcast_checked(sample, F.lit(16)), texts["doc_id"] == sample["_id"])
    fold = F.pmod(F.xxhash64("_id", F.lit(1)), F.lit(FOLDS)).cast("int")
    return joined.select("_id", hashed(F.col("text")).alias("terms"), fold.alias("fold"), "low_quality", "toxic")


_MODELS = "part int, features array<int>, weights array<double>, before array<double>, bias double, share double"
_KINDS = (pa.int32(), pa.list_(pa.int32()), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.float64(), pa.float64())


def fit_chain(docs: DataFrame, labels: DataFrame, chain: Sequence[str] = CHAIN, max_rows: int = MAX_ROWS, penalty: float = PENALTY) -> Chain:
    """Fit the models of ``chain`` on the bounded sample.

    A category's model on all rows, and those that leave out a fold each, are fitted by a task of their own.
    """
    rows = materialise(training_rows(docs, labels, max_rows), "training")
    models: dict[str, Linear | float] = {}
    unseen: list[list[Linear | float]] = []
    for category in chain:
        last = category == chain[-1]
        parts = F.explode(F.array(*[F.lit(k) for k in ([FOLDS] if last else range(FOLDS + 1))]))
        spread = rows.withColumn("part", parts).where("part <> fold")
        found = {r["part"]: _model(r) for r in spread.groupBy("part").applyInArrow(_fitter(category, list(unseen), penalty), _MODELS).toArrow().to_pylist()}
        models[category] = found.get(FOLDS, 0.0)
        unseen.append([found.get(k, models[category]) for k in range(FOLDS)])
    return Chain(models)


def _fitter(category: str, unseen: list, penalty: float):
    def fit(rows: pa.Table) -> pa.Table:
        # in one order, so that sums do not depend on the order of arrival
        rows = rows.sort_by([("_id", "ascending"), (category, "ascending")]).combine_chunks()
        part = rows.column("part")[0].as_py()
        terms = rows.column("terms").combine_chunks()
        held, ends = np.asarray(terms.flatten()), np.asarray(terms.offsets)
        ends = ends - ends[0]
        before = out_of_fold(held, ends, np.asarray(rows.column("fold")), unseen)
        model = fit_linear(held, ends, before, np.asarray(rows.column(category), dtype=np.float64), penalty)
        del held, ends, terms, before, rows
        give_back()
        made = (None, None, None, None, model) if isinstance(model, float) else (model.features, model.weights, model.before, model.bias, None)
        names = [part.split()[0] for part in _MODELS.split(", ")]
        return pa.table({n: pa.array([v], k) for n, v, k in zip(names, (part, *made), _KINDS)})

    return fit


def _model(row: dict) -> Linear | float:
    if row["share"] is not None:
        return row["share"]
    return Linear(np.array(row["features"], dtype=np.int64), np.array(row["weights"]), np.array(row["before"], dtype=np.float64), row["bias"])


def _some(text: Column) -> Column:
    return F.coalesce(F.trim(text) != "", F.lit(False))


def score(docs: DataFrame, labels: DataFrame, threshold: float = NEAR, **options) -> DataFrame:
    """doc_id, p_low_quality, p_toxic, toxic of every document."""
    fitted = fit_chain(docs, labels, **options)
    text = F.col("text")
    made = fitted.predict(docs.select("doc_id", _some(text).alias("_some"), hashed(text).alias("_terms")))
    return made.select(
        "doc_id",
        F.col("_p_low_quality").alias("p_low_quality"),
        F.col("_p_toxic").alias("p_toxic"),
        (F.col("_some") & (F.col("_p_toxic") >= threshold)).alias("toxic"),
    )


def reject(docs: DataFrame, labels: DataFrame, threshold: float = NEAR, **options) -> DataFrame:
    """The documents that are not toxic, with all their columns."""
    fitted = fit_chain(docs, labels, **options)
    whole = docs.select(F.struct("*").alias("_row"), hashed(F.col("text")).alias("_terms"))
    return fitted.predict(whole).where(~(_some(F.col("_row.text")) & (F.col("_p_toxic") >= threshold))).select("_row.*")
