"""Quality classifier by positive-unlabelled learning with a non-negative risk.

Trusted positives are labelled rows of quality 1; the unlabelled set is drawn from all documents,
their labels unused. With the class prior p, a small network minimises
p R+(positives) + max(0, R-(unlabelled) - p R-(positives)); when the second term turns negative, the
step goes the other way, so that the negative risk cannot be driven below zero. Inputs are features of
the text alone.

The prior is estimated from positives and unlabelled texts only: a network that tells one sample from the
other orders held-back rows, and the prior is the least ratio, over all cuts, of the unlabelled share above
the cut to the positive share. Above a cut that no negative reaches, this ratio is the prior.
"""

from __future__ import annotations

import operator
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimweave.llm.tables import each_text, lean, read_table, unused

# Bounds of the training sample: trusted positives, and unlabelled documents.
POSITIVES = 4000
UNLABELLED = 8000
FOLDS = 5
THRESHOLD = 0.3

FEATURES = 22


def _kinds() -> dict[str, np.ndarray]:
    """Bytes by kind; letters beyond ASCII count at their first byte."""
    b = np.arange(256)
    lower, upper, digit = (b >= 97) & (b <= 122), (b >= 65) & (b <= 90), (b >= 48) & (b <= 57)
    space = (b == 32) | ((b >= 9) & (b <= 13))
    sign = (b > 32) & (b < 127) & ~lower & ~upper & ~digit & (b != 44) & (b != 46) & (b != 95)
    return {"lower": lower, "upper": upper, "digit": digit, "space": space, "sign": sign, "letter": lower | upper | (b >= 192)}


_KINDS = _kinds()


def features(text: str) -> list[float]:
    """Numbers that describe the form of a whole text; no words of any one topic or language."""
    raw = text.encode()
    words = raw.split()
    n, m = len(text), len(words)
    if not m:
        return [0.0] * FEATURES
    data = np.frombuffer(raw, np.uint8)
    of_byte = np.bincount(data, minlength=256)
    count = {k: int(of_byte[v].sum()) for k, v in _KINDS.items()}
    inside = ~_KINDS["space"][data]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    word = np.cumsum(start) - 1
    lengths = np.bincount(word[inside], minlength=m)

    def per_word(kind: str) -> np.ndarray:
        return np.bincount(word[_KINDS[kind][data]], minlength=m)

    capital = (per_word("upper") > 1) & (per_word("lower") == 0) if count["upper"] else np.zeros(1)
    signed = (per_word("sign") > 0).sum() if count["sign"] else 0
    counts = Counter(words)
    top = sorted(counts.values(), reverse=True)[:5]
    again = sum(map(operator.eq, words, words[1:]))
    triples = len(set(zip(words, words[1:], words[2:])))
    lone = sum(c for w, c in counts.items() if len(w) == 1 and not w.isalnum())
    lines = raw.split(b"\n")
    return [
        np.log1p(n), np.log1p(m), lengths.mean(), lengths.std(), np.log1p(lengths.max()),
        count["letter"] / n, count["sign"] / n, count["digit"] / n, count["upper"] / max(count["letter"], 1),
        len(counts) / m, np.log1p(m) - np.log1p(len(counts)), top[0] / m, sum(top) / m,
        again / m, triples / max(m - 2, 1), signed / m, lone / m,
        len(set(lines)) / len(lines), np.log1p(m / len(lines)), (of_byte[46] + of_byte[33] + of_byte[63]) / m,
        len(zlib.compress(raw, 1)) / len(raw), capital.sum() / m,
    ]


def featured(documents: DataFrame, key: str) -> DataFrame:
    """(key, features) of every row; null is the empty text."""

    def compute(batches):
        for batch in batches:
            rows = [features(x or "") for x in each_text(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(rows, pa.list_(pa.float64()))], ["key", "features"]
            )

    kind = documents.schema[key].dataType.simpleString()
    return documents.select(key, "text").mapInArrow(lean(compute), f"key {kind}, features array<double>")


@dataclass(frozen=True)
class Model:
    """A network with one hidden layer over standardised features."""

    mean: np.ndarray
    scale: np.ndarray
    weights: tuple[np.ndarray, ...]
    prior: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        a, b, c, d = self.weights
        return np.tanh(np.clip((x - self.mean) / self.scale, -6, 6) @ a + b) @ c + d

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x), -40, 40)))


def risk(weights: list[np.ndarray], p: np.ndarray, u: np.ndarray, prior: float | None) -> tuple[float, list[np.ndarray]]:
    """What a step descends, by logistic losses, and its gradient by the weights.

    With a prior, the non-negative risk of positives ``p`` and unlabelled rows ``u``; while its negative part
    is below zero, minus that part. Without one, the loss of telling ``p`` from ``u``.
    """
    x = np.concatenate([p, u])
    h = np.tanh(x @ weights[0] + weights[1])
    s = 1 / (1 + np.exp(-np.clip(h @ weights[2] + weights[3], -40, 40)))
    sp, su = s[: len(p)], s[len(p) :]
    positive, as_negative = -np.log(sp + 1e-12).mean(), -np.log(1 - sp + 1e-12).mean()
    unlabelled = -np.log(1 - su + 1e-12).mean()
    # Gradients of the losses by the logit: s - 1 for label 1, s for label 0.
    if prior is None:
        value, g = positive + unlabelled, np.concatenate([(sp - 1) / len(p), su / len(u)])
    elif (negative := unlabelled - prior * as_negative) >= 0:
        value = prior * positive + negative
        g = np.concatenate([(prior * (sp - 1) - prior * sp) / len(p), su / len(u)])
    else:
        value, g = -negative, np.concatenate([prior * sp / len(p), -su / len(u)])
    back = np.outer(g, weights[2]) * (1 - h * h)
    return value, [x.T @ back, back.sum(0), h.T @ g, np.array([g.sum()])]


def train(
    positives: np.ndarray, unlabelled: np.ndarray, prior: float | None, hidden: int = 24, steps: int = 1500
) -> Model:
    """Fits the network to :func:`risk` with Adam on seeded batches."""
    every = np.concatenate([positives, unlabelled])
    mean, scale = every.mean(0), every.std(0) + 1e-6
    p, u = (np.clip((x - mean) / scale, -6, 6) for x in (positives, unlabelled))
    rng = np.random.default_rng(11)
    w = [rng.normal(0, 0.3, (p.shape[1], hidden)), np.zeros(hidden), rng.normal(0, 0.3, hidden), np.zeros(1)]
    first, second = [np.zeros_like(x) for x in w], [np.zeros_like(x) for x in w]
    for step in range(1, steps + 1):
        grads = risk(w, p[rng.integers(0, len(p), 256)], u[rng.integers(0, len(u), 768)], prior)[1]
        rate = 0.01 if step < steps // 2 else 0.002
        for i, d in enumerate(grads):
            d = d + 1e-4 * w[i]
            first[i] = 0.9 * first[i] + 0.1 * d
            second[i] = 0.999 * second[i] + 0.001 * d * d
            w[i] = w[i] - rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return Model(mean, scale, tuple(w), 0.5 if prior is None else prior)


def least_ratio(positives: np.ndarray, unlabelled: np.ndarray, delta: float = 0.1) -> float:
    """Least ratio, over all cuts, of the share of unlabelled scores above the cut to that of positives.

    Both shares carry their deviation at confidence 1 - ``delta``, so that cuts with few rows do not win by
    chance; the ratio returned is that of the shares themselves at the cut chosen.
    """
    cuts = np.unique(np.concatenate([positives, unlabelled]))
    p = 1 - np.searchsorted(np.sort(positives), cuts) / len(positives)
    u = 1 - np.searchsorted(np.sort(unlabelled), cuts) / len(unlabelled)
    slack = sum(np.sqrt(np.log(4 / delta) / (2 * n)) for n in (len(positives), len(unlabelled)))
    best = np.argmin(np.where(p > 0, (u + slack) / np.maximum(p, 1e-12), np.inf))
    return float(u[best] / p[best])


def estimate_prior(positives: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives among the unlabelled rows, the mean over folds read off by a network of the others.

    Training is short, as a network that knows its samples by heart orders other rows worse.
    """
    ratios, folds = [], min(FOLDS, len(positives), len(unlabelled))
    for fold in range(folds if folds > 1 else 0):
        (p, own_p), (u, own_u) = (
            (x[np.arange(len(x)) % folds != fold], x[fold::folds]) for x in (positives, unlabelled)
        )
        model = train(p, u, None, steps=300)
        ratios.append(least_ratio(model.logits(own_p), model.logits(own_u)))
    return float(np.clip(np.mean(ratios), 0.01, 0.99)) if ratios else 0.5


def held_out(doc_id: Column) -> Column:
    """Whether a document's labels may not be used; a null id counts as held out."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def fit(documents: DataFrame, labels: DataFrame) -> Model | None:
    """Trains on samples of documents of smallest hash; None without a trusted positive.

    A document is a trusted positive if all its labels are 1; other labels are not read. Samples are of
    distinct ids, and of the rows of one id, one counts.
    """
    known = (
        labels.where(F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.min("quality").alias("quality"))
    )

    def drawn(ids: DataFrame, seed: int, rows: int) -> DataFrame:
        return ids.orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(rows)

    def matrix(ids: DataFrame) -> np.ndarray:
        rows = documents.join(F.broadcast(ids), "doc_id", "left_semi")
        one = featured(rows, "doc_id").groupBy("key").agg(F.min("features").alias("features"))
        found = one.orderBy("key").toArrow()["features"].combine_chunks()
        return found.flatten().to_numpy().reshape(-1, FEATURES)

    p = matrix(drawn(known.where("quality = 1").select("doc_id"), 3, POSITIVES))
    u = matrix(drawn(documents.select("doc_id").distinct(), 5, UNLABELLED)) if len(p) else p
    return train(p, u, estimate_prior(p, u)) if len(u) else None


def score(documents: DataFrame, model: Model | None) -> DataFrame:
    """``documents`` with ``score`` from 0 to 1; without a model all score 1.

    Whole texts count; null and empty texts get the score of a text without words. Columns named
    score are replaced.
    """
    kept = [c for c in documents.columns if c.lower() != "score"]
    row, text = unused([], "row", "text")

    def compute(batches):
        for batch in batches:
            x = np.array([features(t or "") for t in each_text(batch.column(1))], float).reshape(-1, FEATURES)
            s = model.scores(x) if model else np.ones(len(x))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s, pa.float64())], ["row", "score"])

    packed = documents.select(F.struct(*kept).alias(row), F.col("text").alias(text))
    kind = packed.schema[row].dataType.simpleString()
    done = packed.mapInArrow(lean(compute), f"row {kind}, score double")
    return done.select("row.*", "score")


def keep_good(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Documents that reach the threshold, with their own columns."""
    columns = documents.columns
    name, = unused(columns, "score_of_text")
    scored = score(documents, fit(documents, labels)).withColumnRenamed("score", name)
    return scored.where(F.col(name) >= threshold).select(*columns)


def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of all documents."""
    documents, labels = read_table(spark, folder, "documents"), read_table(spark, folder, "labels")
    scored = score(documents.select("doc_id", "text"), fit(documents, labels))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
