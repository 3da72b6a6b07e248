"""Document quality by positive-unlabelled learning: the non-negative unbiased risk with an estimated class prior."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm.samples import bounded, remainder
from marlstone.llm.shape import SIZE, measures
from marlstone.llm.texts import carried, slices

#: Trusted positives and unlabelled documents that the model is fitted on, of each.
SAMPLE_DOCS = 6144
HIDDEN, STEPS, BATCH = 24, 700, 512


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    first: np.ndarray  # SIZE x hidden
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: np.ndarray
    prior: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        x = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.tanh(x @ self.first + self.first_bias) @ self.second + self.second_bias[0]


def softplus(x: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, x)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def train(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = STEPS, seed: int = 9) -> Model:
    """Minimise ``prior * E_p[l(g)] + max(0, E_u[l(-g)] - prior * E_p[l(-g)])``, l the logistic loss.

    Where the second part falls below zero on a batch, the step goes the other way on it, as the
    non-negative estimator asks, so that unlabelled positives are not learnt as negatives.
    """
    rng = np.random.default_rng(seed)
    every = np.concatenate([positive, unlabelled])
    model = Model(
        every.mean(axis=0), every.std(axis=0) + 1e-2, rng.normal(0, SIZE ** -0.5, (SIZE, HIDDEN)), np.zeros(HIDDEN),
        rng.normal(0, HIDDEN ** -0.5, HIDDEN), np.zeros(1), prior,
    )
    p, u = (np.clip((x - model.mean) / model.scale, -6, 6) for x in (positive, unlabelled))
    values = [model.first, model.first_bias, model.second, model.second_bias]
    moments = [(np.zeros_like(v), np.zeros_like(v)) for v in values]
    for step in range(1, steps + 1):
        x = np.concatenate([p[rng.integers(0, len(p), BATCH)], u[rng.integers(0, len(u), BATCH)]])
        inner = np.tanh(x @ model.first + model.first_bias)
        g = inner @ model.second + model.second_bias[0]
        gp, gu = g[:BATCH], g[BATCH:]
        negative = softplus(gu).mean() - prior * softplus(gp).mean()
        if negative >= 0:
            pull = np.concatenate([-prior * sigmoid(-gp) - prior * sigmoid(gp), sigmoid(gu)]) / BATCH
        else:
            pull = np.concatenate([prior * sigmoid(gp), -sigmoid(gu)]) / BATCH
        back = pull[:, None] * model.second * (1 - inner ** 2)
        found = [x.T @ back + 1e-3 * model.first, back.sum(axis=0), inner.T @ pull, np.array([pull.sum()])]
        for v, d, (m, s) in zip(values, found, moments):
            m += 0.1 * (d - m)
            s += 0.01 * (d * d - s)
            v -= 0.01 * (1 - 0.9 * step / steps) * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.99 ** step)) + 1e-8)
    return model


def class_prior(positive: np.ndarray, unlabelled: np.ndarray, delta: float = 0.1) -> float:
    """Share of positives among unlabelled scores: the least ratio of the two upper tails.

    Above any cut, positives alone make up at most the unlabelled tail, so the prior is at most the ratio
    of the tails; it is reached where no negative scores as high. Tails are widened by their sampling
    error, which keeps cuts with few rows from being chosen by luck.
    """
    cuts = np.unique(positive)
    above_p = 1 - np.searchsorted(np.sort(positive), cuts) / len(positive)
    above_u = 1 - np.searchsorted(np.sort(unlabelled), cuts) / len(unlabelled)
    slack = np.sqrt(np.log(4 / delta) / 2) * (len(positive) ** -0.5 + len(unlabelled) ** -0.5)
    best = int(np.argmin((above_u + slack) / np.maximum(above_p, 1e-9)))
    return float(np.clip(above_u[best] / above_p[best], 0.05, 0.98))


def fit(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE_DOCS) -> Model | None:
    """Fit on at most ``bound`` trusted positives (quality 1) and as many unlabelled documents.

    Trusted are documents whose marks are all 1; null marks are none. Unlabelled are all documents, marked
    or not: negative marks are never used. The class prior is estimated on one half of both samples by a
    model fitted on the other half, for unlabelled positives against trusted ones; the final model uses all.
    None without a trusted document.
    """
    marks = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    trusted = bounded(marks.where("quality > 0"), "quality", "doc_id", bound)
    place = F.xxhash64("doc_id", F.lit(23))
    total = docs.count()
    share = min(1.0, 1.2 * bound / max(total, 1)) * float(1 << 31)
    texts = docs.select("doc_id", "text")
    some = texts.where(F.pmod(place, F.lit(1 << 31)) < share)
    found = []
    for rows in (texts.join(F.broadcast(trusted.select("doc_id")), "doc_id"), some):
        measured = rows.select("doc_id", "text").mapInArrow(_measure, "place long, measures binary")
        measured = measured.orderBy("place", "measures").limit(bound).toPandas()["measures"]
        found.append(np.stack([np.frombuffer(x, np.float32) for x in measured]).astype(float) if len(measured) else np.zeros((0, SIZE)))
    positive, unlabelled = found
    if not len(positive) or not len(unlabelled):
        return None
    if min(len(positive), len(unlabelled)) < 8:
        return train(positive, unlabelled, 0.5)
    early = train(positive[::2], unlabelled[::2], 0.5, STEPS // 2)
    prior = class_prior(early.margin(positive[1::2]), early.margin(unlabelled[1::2]))
    return train(positive, unlabelled, prior)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from marlstone.llm.texts import hashes

    for batch in batches:
        for first, last, data, offsets in slices(batch.column(batch.schema.get_field_index("text"))):
            rows = measures(data, offsets)
            place = hashes(data, offsets[:-1], offsets[1:], lower=False).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(place), pa.array([r.tobytes() for r in rows], pa.binary())],
                                             ["place", "measures"])


def score(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``row`` (all its columns), score, predicted.

    The score is the logistic of the model's margin over the whole text. Null and empty texts have the
    score of a text without characters. Without a model every score is 0. Only the text is read.
    """
    out = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    if model is None:
        found = out.withColumn("score", F.lit(0.0))
    else:
        sent = docs.sparkSession.sparkContext.broadcast(model)
        found = out.mapInArrow(
            _score(sent, text), f"row {docs.schema.simpleString()}, score double")
    return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def _score(sent, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            rows, texts = carried(batch, text)
            for first, last, data, offsets in slices(texts):
                value = sigmoid(model.margin(measures(data, offsets).astype(float)))
                yield pa.RecordBatch.from_arrays(
                    [rows.slice(first, last - first), pa.array(value)], ["row", "score"])

    return run


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    learn = remainder("doc_id", 3) != 1
    model = fit(docs.where(learn), spark.read.parquet(f"{sf_dir}/labels.parquet").where(learn))
    return score(docs, model).select(
        "row.doc_id", (remainder("row.doc_id", 3) == 1).alias("held_out"), "score", "predicted")
