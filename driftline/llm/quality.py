"""Quality scores by positive-unlabelled learning.

A linear model is fitted to trusted positives and unlabelled web text so that the non-negative unbiased risk
``prior * risk(positives as good) + max(0, risk(unlabelled as bad) - prior * risk(positives as bad))`` is least. Labelled negatives take no part. The prior
is estimated from the unlabelled texts: where a first model's scores are high enough, hardly anything but good texts lies, and the share of unlabelled
texts there over the share of trusted ones is the share of good texts among all.
"""

from __future__ import annotations

from operator import eq
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.functions.sizing import small_side
from driftline.llm.languages import in_fold
from driftline.llm.registry import query, ready, table, widened

POSITIVES, UNLABELLED = 6_000, 12_000       # most texts the model is fitted to
STEPS, RATE, DECAY = 500, 0.05, 1e-4
FOLDS, FOLD_DECAY = 5, 3e-2                 # of the models that the prior is estimated by
FLOOR = 1e-3                                # shares below this count as none

# Kinds of bytes: lower case, upper case, digit, blank, line end, full stop and comma, other marks one by one, bytes of other letters.
KINDS = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t", "\n\r", ".,", "!?", "|", "#$%&*@^~", "'\"`-", ":;()[]{}<>", "/\\=+_"]
N_KINDS = len(KINDS) + 1
KIND = np.full(256, len(KINDS), np.uint8)
for _k, _letters in enumerate(KINDS):
    KIND[list(_letters.encode())] = _k
N_FEATURES = N_KINDS * N_KINDS + N_KINDS + 7


def features(text: str | None) -> np.ndarray:
    """Shares of byte kinds and of pairs of them in the whole text, and how it repeats words and lines. Null is empty."""
    text = text or ""
    out = np.zeros(N_FEATURES)
    raw = np.frombuffer(text.encode(), np.uint8)
    if len(raw):
        kind = KIND[raw]
        out[:N_KINDS] = np.bincount(kind, minlength=N_KINDS) / len(raw)
        pairs = kind[:-1] * np.uint8(N_KINDS) + kind[1:]
        out[N_KINDS:N_KINDS + N_KINDS * N_KINDS] = np.bincount(pairs, minlength=N_KINDS * N_KINDS) / len(raw)
    words, lines = text.split(), text.split("\n")
    n = max(1, len(words))
    distinct = len(set(words))
    out[:-7] = np.log(out[:-7] + FLOOR)
    out[-7:] = (np.log1p(len(words)), np.log((distinct + 1) / (n + 1)), np.log(sum(map(eq, words, words[1:])) / n + FLOOR),
                np.log(1 - len(set(lines)) / len(lines) + FLOOR), np.log1p(len(text) / n), np.log1p(len(text) / len(lines)),
                np.log1p(n / max(1, distinct) / np.sqrt(n)))
    return out


class Model(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float

    def score(self, rows: np.ndarray) -> np.ndarray:
        z = np.clip((rows - self.mean) / self.scale, -8, 8) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = STEPS, rate: float = RATE, decay: float = DECAY) -> Model:
    """Least non-negative risk with the logistic loss, by Adam over all rows.

    Where the second part of the risk is below zero, its gradient is turned round, as the non-negative estimator asks. Without rows on
    either side every text gets the prior.
    """
    width = positive.shape[1]
    if not len(positive) or not len(unlabelled):
        p = min(max(prior, 1e-6), 1 - 1e-6)
        return Model(np.zeros(width), np.ones(width), np.zeros(width), float(np.log(p / (1 - p))))
    mean, scale = unlabelled.mean(0), unlabelled.std(0) + 0.05
    p, u = (np.clip((x - mean) / scale, -8, 8) for x in (positive, unlabelled))
    w = np.zeros(width + 1)
    m, v = np.zeros_like(w), np.zeros_like(w)
    p, u = np.c_[p, np.ones(len(p))], np.c_[u, np.ones(len(u))]
    for t in range(1, steps + 1):
        sp, su = (1 / (1 + np.exp(-np.clip(x @ w, -30, 30))) for x in (p, u))
        # log(1 + exp(z)) has the slope sigmoid(z), log(1 + exp(-z)) sigmoid(z) - 1.
        bad = np.log1p(-np.minimum(su, 1 - 1e-12)).mean() * -1 - prior * -np.log1p(-np.minimum(sp, 1 - 1e-12)).mean()
        of_bad = u.T @ su / len(u) - prior * (p.T @ sp) / len(p)
        grad = prior * (p.T @ (sp - 1)) / len(p) + of_bad if bad >= 0 else -of_bad
        grad[:-1] += decay * w[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w -= rate * (1 - t / (steps + 1)) * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return Model(mean, scale, w[:-1], float(w[-1]))


def risk(model: Model, positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> tuple[float, float]:
    """The two parts of the risk that ``fit`` makes least, with the logistic loss; the second is not yet cut at zero."""
    p, u = (np.clip((x - model.mean) / model.scale, -8, 8) @ model.weights + model.bias for x in (positive, unlabelled))
    loss = lambda z: np.logaddexp(0, -z).mean()
    return prior * loss(p), loss(-u) - prior * loss(-p)


def estimated_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of good texts among the unlabelled ones, by scores of models that did not see the texts they score.

    Any set of texts holds at least the prior times its share of good texts, so the least ratio over the upper ends of the scores bounds the prior, and
    reaches it where no bad text scores as high. Ends that hold half of the good texts or more are looked at,
    so that the shares are steady. With fewer than four rows on a side it is 0.5.
    """
    if min(len(positive), len(unlabelled)) < 4:
        return 0.5
    scores = [np.empty(len(x)) for x in (positive, unlabelled)]
    folds = [np.arange(len(x)) % FOLDS for x in (positive, unlabelled)]
    for k in range(FOLDS):
        model = fit(positive[folds[0] != k], unlabelled[folds[1] != k], 0.5, steps=STEPS // 2, decay=FOLD_DECAY)
        for out, x, fold in zip(scores, (positive, unlabelled), folds):
            out[fold == k] = model.score(x[fold == k])
    p, u = scores
    best = 1.0
    for t in np.quantile(p, np.linspace(0.1, 0.5, 9)):
        best = min(best, (u >= t).mean() / (p >= t).mean())
    return float(min(max(best, 0.02), 0.98))


def sample(docs: DataFrame, most: int, salt: str) -> np.ndarray:
    """Features of at most ``most`` rows of (doc_id, text), those first in hash order; computed in tasks."""
    ready(docs.sparkSession)
    first = docs.select(F.xxhash64(F.lit(salt), "doc_id", F.octet_length("text")).alias("at"), "text").orderBy("at").limit(most)

    def compute(batches):
        for batch in batches:
            rows = [features(t) for t in batch.column(1).to_pylist()]
            yield pa.record_batch([pa.array([r.tolist() for r in rows], pa.list_(pa.float64()))], names=["x"])

    got = first.mapInArrow(compute, "x array<double>").collect()
    return np.array([r["x"] for r in got]).reshape(len(got), N_FEATURES)


def learn(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Model:
    """A model from (doc_id, text) and (doc_id, quality); both hold only rows to learn from.

    A text is trusted if all its labels are 1; labels without id or quality say nothing. Equal ids count as one text's.
    """
    spark = docs.sparkSession
    asked = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg((F.min("quality") == 1).alias("good"))
    good = asked.where("good").count()
    total = docs.count()

    def thinned(df: DataFrame, most: int, of: int, salt: str) -> DataFrame:
        """By a hash of the id, to about twice what is wanted, before any text moves."""
        share = min(1.0, 2.0 * most / max(1, of) + 100 / max(1, of))
        return df.where(F.pmod(F.xxhash64(F.lit(salt), "doc_id"), F.lit(1 << 40)) < max(1, int(share * (1 << 40))))

    trusted = small_side(thinned(asked.where("good").select("doc_id"), positives, good, "p").limit(4 * positives + 1000))
    p = sample(docs.join(trusted, "doc_id", "left_semi"), positives, "p")
    u = sample(thinned(docs, unlabelled, total, "u"), unlabelled, "u")
    return fit(p, u, estimated_prior(p, u))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score`` and ``predicted``, replacing columns of these names. Null and empty texts are scored too."""
    ready(docs.sparkSession)
    docs = docs.drop("score", "predicted")
    at = docs.columns.index("text")
    schema = widened(docs.schema, score=T.DoubleType(), predicted=T.IntegerType())

    def rate_(batches):
        for batch in batches:
            texts = batch.column(at)
            scores = model.score(np.array([features(t.as_py()) for t in texts]).reshape(len(texts), N_FEATURES))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                                             names=[*batch.schema.names, "score", "predicted"])

    return docs.mapInArrow(rate_, schema)


@query()
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's quality, learnt from two thirds of the documents and their labels; null and empty texts are scored like others, equal rows each."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = in_fold(F.col("doc_id"), 3, 1)
    model = learn(docs.where(~held_out), table(spark, sf_dir, "labels").where(~held_out).select("doc_id", "quality"))
    return score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")
