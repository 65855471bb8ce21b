"""Quality classifier: naive Bayes features under a support vector machine (Wang and Manning 2012).

A text's features are the distinct byte n-grams (1 to 3) in it, hashed into BUCKETS places. Each is scaled by the log ratio
of its smoothed shares in good and bad documents; a linear hinge-loss model is fitted by dual coordinate descent, and its
margin is turned into a probability by a logistic curve fitted on documents that it hasn't seen.

It learns from at most SAMPLE labelled documents, those of least hash; scores cover every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cladeforge.llm.common import flat_bytes, id_part, texts

BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
SAMPLE = 3_000
THRESHOLD = 0.7


def features(data: np.ndarray) -> np.ndarray:
    """Distinct feature numbers of a text's bytes."""
    seen = np.zeros(BUCKETS, bool)
    for at in range(0, len(data), 1 << 20):
        part = data[at : at + (1 << 20) + ORDERS[-1] - 1].astype(np.uint32)
        code = np.zeros(len(part), np.uint32)
        for n in range(1, ORDERS[-1] + 1):
            if len(part) < n:
                break
            code = code[: len(part) - n + 1] * np.uint32(257) + part[n - 1 :] + np.uint32(1) if n > 1 else part + np.uint32(1)
            if n in ORDERS:
                seen[(code * np.uint32(2654435761) + np.uint32(n)) >> np.uint32(16)] = True
    return np.flatnonzero(seen)


@dataclass
class Model:
    weights: np.ndarray
    slope: float
    shift: float

    def score(self, data: np.ndarray) -> float:
        found = features(data)
        margin = float(self.weights[found].sum()) / max(1.0, len(found)) ** 0.5
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -30, 30))))


def _descend(rows: list[np.ndarray], scale: np.ndarray, y: np.ndarray, rounds: int = 15, cost: float = 1.0, seed: int = 1) -> np.ndarray:
    """Weights of the scaled, length-normalised indicators by dual coordinate descent on the hinge loss."""
    w, alpha = np.zeros(BUCKETS), np.zeros(len(rows))
    share = np.where(y > 0, len(y) / (2 * max(1, (y > 0).sum())), len(y) / (2 * max(1, (y < 0).sum())))  # both classes weigh alike
    values = [scale[r] / max(1.0, len(r)) ** 0.5 for r in rows]
    squares = np.array([max(v @ v, 1e-12) for v in values])
    order, random = np.arange(len(rows)), np.random.default_rng(seed)
    for _ in range(rounds):
        random.shuffle(order)
        for i in order:
            gradient = y[i] * (w[rows[i]] @ values[i]) - 1
            new = min(max(alpha[i] - gradient / squares[i], 0.0), cost * share[i])
            if new != alpha[i]:
                w[rows[i]] += (new - alpha[i]) * y[i] * values[i]
                alpha[i] = new
    return w


def train(rows: list[np.ndarray], labels: np.ndarray) -> Model:
    y = np.where(labels == 1, 1.0, -1.0)
    if not len(y) or (y > 0).all() or (y < 0).all():  # one class or none: its share, smoothed
        return Model(np.zeros(BUCKETS, np.float32), 1.0, float(np.log(((y > 0).sum() + 1) / ((y < 0).sum() + 1))))

    def fit(part: np.ndarray) -> np.ndarray:
        counts = np.ones((2, BUCKETS))
        for i in part:
            counts[int(y[i] > 0), rows[i]] += 1
        ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
        return _descend([rows[i] for i in part], ratio, y[part]) * ratio

    every = np.arange(len(y))
    margins = np.zeros(len(y))
    folds = 3 if min((y > 0).sum(), (y < 0).sum()) >= 6 else 1
    fold = np.zeros(len(y), int)
    for side in (y > 0, y < 0):
        fold[side] = np.arange(side.sum()) % folds
    for k in range(folds):
        w = fit(every[fold != k] if folds > 1 else every)
        for i in every[fold == k]:
            margins[i] = w[rows[i]].sum() / max(1.0, len(rows[i])) ** 0.5
    slope, shift, t = 1.0, 0.0, (y > 0) * 1.0
    for _ in range(100):  # Newton steps on the logistic loss, lightly held
        p = 1 / (1 + np.exp(-np.clip(slope * margins + shift, -30, 30)))
        g = np.array([(p - t) @ margins + 1e-3 * slope, (p - t).sum()])
        s = p * (1 - p) + 1e-6
        h = np.array([[s @ margins**2 + 1e-3, s @ margins], [s @ margins, s.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        slope, shift = slope - np.clip(step[0], -5, 5), shift - np.clip(step[1], -5, 5)
        if abs(step).max() < 1e-6:
            break
    return Model(fit(every).astype(np.float32), float(slope), float(shift))


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """Fits on at most SAMPLE labelled documents whose id_part(4) isn't 2."""
    known = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality"))
    known = known.join(docs.select("doc_id").filter(id_part(4) != 2).distinct(), "doc_id").orderBy(F.xxhash64(F.col("doc_id").cast("long"), F.lit(7)), "doc_id").limit(SAMPLE)
    chosen = {r["doc_id"]: r["quality"] for r in known.collect()}  # SAMPLE rows at most
    if not chosen:
        return train([], np.zeros(0))
    rows = docs.filter(F.col("doc_id").isin(list(chosen))).groupBy("doc_id").agg(F.max(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text"))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, begins = flat_bytes(batch.column("text"))
            lists = [features(data[b:e]).astype("<u4").tobytes() for b, e in zip(begins, begins[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(lists, pa.binary())], ["doc_id", "found"])

    got = sorted((r["doc_id"], bytes(r["found"])) for r in rows.select(F.col("doc_id").cast("long"), "text").mapInArrow(found, "doc_id long, found binary").collect())
    return train([np.frombuffer(x, "<u4") for _, x in got], np.array([chosen[i] for i, _ in got]))


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of each row.

    A null text is scored as an empty one, which has no features: what the classes' shares and the fit say of nothing.
    Without labels of both classes every text gets one score, from the shares of the labels. Ids with several labels count
    as good if one label is. Repeated rows come back repeated. Other columns are left aside.
    """
    return _scored(docs, labels).drop("rid")


def _scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = docs.sparkSession.sparkContext.broadcast(learn(docs, labels))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, begins = flat_bytes(batch.column("text"))
            s = [model.value.score(data[b:e]) for b, e in zip(begins, begins[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column("rid"), batch.column("doc_id"), batch.column("held_out"), pa.array(s, pa.float64()), pa.array([int(x >= THRESHOLD) for x in s], pa.int32())], ["rid", "doc_id", "held_out", "score", "predicted"])

    rows = texts(docs).withColumn("held_out", id_part(4) == 2)
    return rows.mapInArrow(scored, "rid long, doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs without the rows predicted 0. Null texts are judged as empty ones, equal rows stay or go together, other columns are kept."""
    bad = _scored(docs, labels).filter("predicted = 0").select("rid").distinct()
    rid = F.xxhash64(F.col("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")))
    return docs.select(F.struct("*").alias("row"), rid.alias("rid")).join(bad, "rid", "left_anti").select("row.*")
