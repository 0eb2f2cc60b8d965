"""Toxicity of free text by two class-conditional Kneser-Ney models that share their backoff counts."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granero.llm.common import map_arrow, put_aside, workspace

TOKEN = re.compile(r"\w+")
START = ""  # stands before the first word
DISCOUNT = 3.0  # taken from every count: what was seen in so few contexts is left to the shared counts
MAX_TRAINING = 8000  # labelled rows of each class that are learnt from, chosen by a hash of the key
RIDGE = 1e-4
CLASSES = ("ordinary", "toxic")


@dataclass(frozen=True)
class KneserNey:
    """Both models: per class the different words that each word follows, their sum, and the sum of min(count, DISCOUNT).

    Place 0 stands for all words without a number of their own; `shared` is the backoff probability of each place, by the
    contexts of both classes together.
    """

    words: list[str]
    shared: np.ndarray
    contexts: tuple[np.ndarray, np.ndarray]
    totals: tuple[float, float]
    freed: tuple[float, float]

    def places(self) -> dict[str, int]:
        return {w: i + 1 for i, w in enumerate(self.words)}

    @cached_property
    def whole(self) -> tuple[np.ndarray, np.ndarray]:
        """Log-probabilities of all places under the ordinary and the toxic model."""
        return tuple(np.log(np.maximum(c - DISCOUNT, 0) / n + f / n * self.shared)
                     for c, n, f in zip(self.contexts, self.totals, self.freed))

    def log_probabilities(self, at: np.ndarray, own: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Of the words of a text, given by their places. With `own` the text's contexts are taken out of that class first."""
        out = [table[at] for table in self.whole]
        if own is not None and len(at):
            pairs = np.unique(np.concatenate([[-1], at[:-1]]) * len(self.shared) + at)  # all words of place 0 count as one
            less = np.bincount(pairs % len(self.shared), minlength=len(self.shared))
            less[0] = 0
            counts = self.contexts[own]
            left = np.maximum(counts - less, 0)
            total = max(self.totals[own] - len(pairs), 1.0)
            freed = self.freed[own] - (np.minimum(counts, DISCOUNT) - np.minimum(left, DISCOUNT)).sum()
            out[own] = np.log(np.maximum(left[at] - DISCOUNT, 0) / total + max(freed, 1.0) / total * self.shared[at])
        return tuple(out)


def _words(text: str | None) -> list[str]:
    return TOKEN.findall((text or "").lower())


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The different pairs of neighbours in the texts of a batch, by label."""
    for batch in batches:
        seen = set()
        for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = _words(text)
            seen.update(zip([label] * len(words), [START, *words], words))
        labels, before, words = zip(*seen) if seen else ([], [], [])
        yield pa.RecordBatch.from_arrays([pa.array(labels, pa.int32()), pa.array(before, pa.string()), pa.array(words, pa.string())],
                                         ["label", "before", "word"])


def fit(training: DataFrame) -> KneserNey | None:
    """Models from rows (label, text); None unless both classes have words.

    A class counts the different words that a word follows there (continuation counts), so that copies of a passage count
    once. Each count gives up `DISCOUNT`; what the discounts free is dealt out by the counts of both classes together,
    which is all that a rare word has. So a rare word speaks for neither class, and one that follows many words in one
    class alone speaks loudly. Words whose counts the discount uses up have nothing of their own and are not kept; the
    rest is bounded by the sample.
    """
    contexts = map_arrow(training.select("label", "text"), _contexts, "label int, before string, word string").distinct()
    counted = put_aside(contexts.groupBy("word").agg(*[F.count_if(F.col("label") == k).alias(c) for k, c in enumerate(CLASSES)]), "kn-words")
    sums = counted.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in CLASSES], F.count("*").alias("words"), *[
        F.sum(F.least(c, F.lit(DISCOUNT))).alias(f"{c}_freed") for c in CLASSES]).first()
    if not all(sums[c] for c in CLASSES):
        return None
    own = counted.filter(F.greatest(*CLASSES) > DISCOUNT).orderBy("word").toPandas()
    counts = tuple(np.concatenate([[0.0], own[c].to_numpy(float)]) for c in CLASSES)
    shared = (counts[0] + counts[1] + 1.0) / (sum(sums[c] for c in CLASSES) + sums["words"] + 1.0)
    return KneserNey(own["word"].tolist(), shared, counts, tuple(float(sums[c]) for c in CLASSES),
                     tuple(float(sums[f"{c}_freed"]) for c in CLASSES))


def compare(model: KneserNey, places: Callable[[str, int], int], text: str | None, own: int | None = None) -> tuple[float, float, float]:
    """Length-normalised log-likelihoods of a text, toxic and ordinary, and the comparison: their difference over the whole
    text plus that of its strongest word."""
    words = _words(text)
    if not words:
        return 0.0, 0.0, 0.0
    ordinary, toxic = model.log_probabilities(np.fromiter((places(w, 0) for w in words), np.int64, len(words)), own)
    gain = toxic - ordinary
    return toxic.mean(), ordinary.mean(), float(gain.mean() + gain.max())


def _score(ratio: np.ndarray, scale: tuple[float, float]) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(scale[0] + scale[1] * ratio, -50, 50)))


def _measure(shared_model: Broadcast, key_type: pa.DataType, scale: tuple[float, float]):
    """Tasks that score rows (_key, _text)."""
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared_model.value
        places = model.places().get
        for batch in batches:
            toxic, ordinary, ratio = np.array([compare(model, places, t.as_py()) for t in batch.column(1)], float).reshape(-1, 3).T
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, (toxic, ordinary, ratio, _score(ratio, scale)))],
                                             ["_key", "toxic_loglik", "ordinary_loglik", "ratio", "score"])
    return measure


def _keep_civil(shared_model: Broadcast, text: int, scale: tuple[float, float]):
    """Tasks that pass on the rows whose text, the column of that number, is not toxic."""
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared_model.value
        places = model.places().get
        for batch in batches:
            ratio = np.array([compare(model, places, t.as_py())[2] for t in batch.column(text)], float)
            yield batch.filter(pa.array(_score(ratio, scale) < 0.5))
    return keep


def _compare_left_out(shared_model: Broadcast):
    """Tasks that compare rows (label, text) under the models less the row's own pairs."""
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared_model.value
        places = model.places().get
        for batch in batches:
            ratio = [compare(model, places, text, label)[2] for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ratio, pa.float64())], ["label", "ratio"])
    return measure


def logistic(features: np.ndarray, labels: np.ndarray, weights: np.ndarray | None = None, ridge: float = RIDGE) -> tuple[float, ...]:
    """Coefficients (constant first) of a weighted ridge logistic regression: Newton steps on standardised features, halved
    until they improve the fit, so that classes which a feature splits without overlap do no harm."""
    centre, spread = features.mean(axis=0), features.std(axis=0)
    spread = np.where(spread > 0, spread, 1.0)
    x = np.hstack([np.ones((len(features), 1)), (features - centre) / spread])
    penalty = np.full(x.shape[1], ridge)
    weights = np.full(len(x), 1 / len(x)) if weights is None else weights / weights.sum()

    def loss(beta: np.ndarray) -> float:
        return float((weights * np.logaddexp(0, np.where(labels == 1, -1, 1) * (x @ beta))).sum() + (penalty * beta * beta).sum() / 2)

    beta, best = np.zeros(x.shape[1]), np.inf
    for _ in range(200):
        z = np.clip(x @ beta, -50, 50)
        p = 1 / (1 + np.exp(-z))
        slope = x.T @ (weights * (p - labels)) + penalty * beta
        curve = (x * (p * (1 - p) * weights)[:, None]).T @ x + np.diag(penalty)
        step, size = np.linalg.solve(curve, slope), 1.0
        best = loss(beta)
        while size > 1e-6 and loss(beta - size * step) > best:
            size /= 2
        beta = beta - size * step
        if best - loss(beta) < 1e-12:
            break
    slopes = beta[1:] / spread
    return (float(beta[0] - (slopes * centre).sum()), *(float(v) for v in slopes))


def _learn(reports: DataFrame, labels: DataFrame, key: str, text: str, label: str, max_training: int):
    """Broadcast models and the scale of their comparison; None without labels of both classes."""
    known = labels.filter(F.col(key).isNotNull() & F.col(label).isin(0, 1)).groupBy(F.col(key).alias("_key")).agg(
        F.max(label).cast("int").alias("label"))
    order = F.xxhash64("_key", F.lit("training"))
    with workspace():
        known = put_aside(known, "labels")
        shares = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
        chosen = [known.filter(F.col("label") == c).orderBy(order, "_key").limit(max_training) for c in (0, 1)]
        chosen = put_aside(chosen[0].unionByName(chosen[1]), "training-keys")  # at most twice max_training
        rows = reports.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("text"))
        training = put_aside(rows.join(F.broadcast(chosen), "_key").select("label", "text"), "training")
        model = fit(training)
        if model is None:
            return None
        shared = reports.sparkSession.sparkContext.broadcast(model)
        sample = map_arrow(training, _compare_left_out(shared), "label int, ratio double").toPandas()
    truth = sample["label"].to_numpy(float)
    weights = np.where(truth == 1, shares.get(1, 0) / max(truth.sum(), 1), shares.get(0, 0) / max((1 - truth).sum(), 1))
    constant, slope = logistic(sample[["ratio"]].to_numpy(float), truth, weights)
    if slope <= 0:  # labels that the models cannot tell apart: the comparison decides alone, toxic where it is above 0
        constant, slope = 0.0, 1.0
    return shared, (constant, slope)


def score_toxicity(reports: DataFrame, labels: DataFrame, key: str = "hash_respuesta", text: str = "observaciones",
                   label: str = "toxica", *, max_training: int = MAX_TRAINING) -> DataFrame:
    """Toxicity, 0 to 1, of the `observaciones` of every field report; `labels` names the rows to learn from.

    The score is a logistic function of one number: the difference of the length-normalised log-likelihoods under the
    toxic and the ordinary model, over the whole text and, added to it, in its strongest word, so that an insult in a long
    text is not thinned out. Both parts count alike at every size. The function's constant and its slope, always positive, are fitted on the training rows, each compared under
    the models less its own pairs. Per class at most `max_training` labelled rows, chosen by a hash of the key, are learnt
    from; that bounds the models. The two classes weigh in the fit as they occur among all labels, so the threshold does
    not move with the bound. Scoring is a map-only step.

    Columns: key, score, predicted (1 from 0.5 on), toxic_loglik and ordinary_loglik (per word, whole text), ratio. Null and
    empty texts have no words: both log-likelihoods and the ratio are 0. Null keys are scored and never learnt from;
    labels other than 0 and 1 are ignored; a key labelled twice differently is learnt as toxic; repeated rows give
    repeated rows. Without labels of both classes every score is 0. Other columns are ignored.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    rows = reports.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"))
    learnt = _learn(reports, labels, key, text, label, max_training)
    if learnt is None:
        none = F.lit(0.0)
        return rows.select(F.col("_key").alias(key), none.alias("score"), F.lit(0).alias("predicted"),
                           none.alias("toxic_loglik"), none.alias("ordinary_loglik"), none.alias("ratio"))
    kind = rows.schema["_key"].dataType
    schema = T.StructType([T.StructField("_key", kind)] + [
        T.StructField(n, T.DoubleType()) for n in ("toxic_loglik", "ordinary_loglik", "ratio", "score")])
    return map_arrow(rows, _measure(learnt[0], to_arrow_type(kind), learnt[1]), schema).select(
        F.col("_key").alias(key), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "toxic_loglik",
        "ordinary_loglik", "ratio")


def drop_toxic(reports: DataFrame, labels: DataFrame, key: str = "hash_respuesta", text: str = "observaciones",
               label: str = "toxica", *, max_training: int = MAX_TRAINING) -> DataFrame:
    """The reports that `score_toxicity` does not predict to be toxic, all columns as they came, in one map-only step."""
    learnt = _learn(reports, labels, key, text, label, max_training)
    if learnt is None:
        return reports
    return map_arrow(reports, _keep_civil(learnt[0], reports.columns.index(text), learnt[1]), reports.schema)
