"""Language of documents by a bidirectional gated recurrent network over bytes, in numpy.

Texts are cut into windows of WINDOW bytes, which are read with MARGIN further bytes of the text on either side. In each, one
network reads forwards and one backwards; every position gets probabilities of the languages from both states, and a
document's are the mean over its positions. So each position is labelled from MARGIN bytes of the text before it and after it
at least, wherever windows begin, and a long text's windows go through the network side by side. The networks are
trained by backpropagation through time on pieces of STEP bytes of at most PER_LANGUAGE documents of each language, those of
least hash. Of one with more than PIECES x PIECE characters as many pieces of that length are learned from, drawn over its whole text by
hash, so that what is fitted on is bounded by rows and pieces and not by where a text begins (scores are of whole texts).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cladeforge.llm.common import flat_bytes, id_part, texts

HIDDEN, WINDOW, MARGIN = 8, 192, 24
PER_LANGUAGE, PIECES, PIECE, STEP, BATCH, STEPS, RATE = 200, 64, 1024, 64, 256, 160, 0.02
#: Windows that go through the network together.
TOGETHER = 1024


def _forward(p: dict[str, np.ndarray], x: np.ndarray) -> tuple[np.ndarray, list]:
    """States of every step, and what backpropagation needs. x: steps by rows of bytes."""
    n = p["u"].shape[0]
    h = np.zeros((x.shape[1], n), np.float32)
    states, kept = np.empty((*x.shape, n), np.float32), []
    for t in range(len(x)):
        a, u = p["w"][x[t]], h @ p["u"]
        gates = 1 / (1 + np.exp(-(a[:, : 2 * n] + u[:, : 2 * n])))
        z, r = gates[:, :n], gates[:, n:]
        new = np.tanh(a[:, 2 * n :] + r * u[:, 2 * n :])
        kept.append((h, z, r, new, u[:, 2 * n :]))
        h = new + z * (h - new)
        states[t] = h
    return states, kept


def _backward(p: dict[str, np.ndarray], x: np.ndarray, kept: list, up: np.ndarray) -> dict[str, np.ndarray]:
    n = p["u"].shape[0]
    du, da = np.zeros_like(p["u"]), np.empty((*x.shape, 3 * n), np.float32)
    dh = np.zeros((x.shape[1], n), np.float32)
    for t in reversed(range(len(x))):
        h, z, r, new, inner = kept[t]
        dh = dh + up[t]
        dn = dh * (1 - z) * (1 - new * new)
        dz, dr = dh * (h - new) * z * (1 - z), dn * inner * r * (1 - r)
        da[t] = np.concatenate((dz, dr, dn), 1)
        through = np.concatenate((dz, dr, dn * r), 1)
        du += h.T @ through
        dh = dh * z + through @ p["u"].T
    dw = np.zeros_like(p["w"])
    order = np.argsort(x, axis=None, kind="stable")
    seen, first = np.unique(x.ravel()[order], return_index=True)
    dw[seen] = np.add.reduceat(da.reshape(-1, 3 * n)[order], first, axis=0)
    return {"w": dw, "u": du}


@dataclass
class Model:
    languages: list[str]
    ahead: dict[str, np.ndarray]
    back: dict[str, np.ndarray]
    out: np.ndarray
    bias: np.ndarray

    def positions(self, x: np.ndarray, there: np.ndarray | None = None) -> np.ndarray:
        """Probabilities of the languages at each place of x (steps by windows). Places that aren't there leave the state zero."""
        there = None if there is None or there.all() else there
        both = np.concatenate((self._states(self.ahead, x, there), self._states(self.back, x[::-1], None if there is None else there[::-1])[::-1]), 2)
        e = both @ self.out + self.bias
        e -= e.max(2, keepdims=True)
        np.exp(e, out=e)
        return e / e.sum(2, keepdims=True)

    @staticmethod
    def _states(p: dict[str, np.ndarray], x: np.ndarray, there: np.ndarray | None = None) -> np.ndarray:
        n = p["u"].shape[0]
        w, u = p["w"].copy(), p["u"].copy()
        w[:, : 2 * n] *= -1
        u[:, : 2 * n] *= -1
        h = np.zeros((x.shape[1], n), np.float32)
        states = np.empty((*x.shape, n), np.float32)
        for t in range(len(x)):
            a, v = w.take(x[t], axis=0), h @ u
            gates = a[:, : 2 * n] + v[:, : 2 * n]
            np.exp(gates, out=gates)
            gates += 1
            np.reciprocal(gates, out=gates)
            new = v[:, 2 * n :] * gates[:, n:]
            new += a[:, 2 * n :]
            np.tanh(new, out=new)
            h = h - new
            h *= gates[:, :n]
            h += new
            if there is not None:
                h *= there[t][:, None]
            states[t] = h
        return states

    def documents(self, data: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Mean probabilities of each text; those without bytes get 0."""
        lengths = np.diff(begins)
        number = -(-lengths // WINDOW)
        owner = np.repeat(np.arange(len(lengths)), number)
        start = begins[:-1][owner] + WINDOW * (np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number))
        low, high = np.maximum(start - MARGIN, begins[:-1][owner]), np.minimum(start + WINDOW + MARGIN, begins[1:][owner])
        sums = np.zeros((len(lengths), len(self.languages)))
        order = np.argsort(high - low, kind="stable")  # windows of like lengths go together
        for at in range(0, len(order), TOGETHER):
            w = order[at : at + TOGETHER]
            steps = int((high[w] - low[w]).max())
            place = low[w] + np.arange(steps)[:, None]
            there = place < high[w]
            x = np.where(there, data[np.minimum(place, len(data) - 1)], 0)
            own = (place >= start[w]) & (place < np.minimum(start[w] + WINDOW, high[w]))
            found = np.einsum("twl,tw->wl", self.positions(x, there), own.astype(np.float32))
            np.add.at(sums, owner[w], found)
        return sums / np.maximum(lengths, 1)[:, None]


def train(samples: list[tuple[bytes, str]], seed: int = 7) -> Model:
    languages = sorted({x for _, x in samples})
    random, n = np.random.default_rng(seed), len(languages)

    def start(*shape: int) -> np.ndarray:
        return (random.standard_normal(shape) * 0.3).astype(np.float32)

    p = {"ahead.w": start(256, 3 * HIDDEN), "ahead.u": start(HIDDEN, 3 * HIDDEN), "back.w": start(256, 3 * HIDDEN), "back.u": start(HIDDEN, 3 * HIDDEN), "out": start(2 * HIDDEN, n), "bias": np.zeros(n, np.float32)}
    by = {x: [np.frombuffer(t, np.uint8) for t, y in samples if y == x and t] for x in languages}
    if n > 1 and all(by.values()):
        first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
        for step in range(1, STEPS + 1):
            y = random.integers(0, n, BATCH)
            x = np.zeros((STEP, BATCH), np.uint8)
            for i, k in enumerate(y):
                text = by[languages[k]][random.integers(len(by[languages[k]]))]
                at = random.integers(max(1, len(text) - STEP // 2))
                x[: len(text[at : at + STEP]), i] = text[at : at + STEP]
            sides = {"ahead": x, "back": x[::-1]}
            runs = {k: _forward({"w": p[f"{k}.w"], "u": p[f"{k}.u"]}, v) for k, v in sides.items()}
            both = np.concatenate((runs["ahead"][0], runs["back"][0][::-1]), 2)
            e = both @ p["out"] + p["bias"]
            e = np.exp(e - e.max(2, keepdims=True))
            d = e / e.sum(2, keepdims=True)
            d[:, np.arange(BATCH), y] -= 1
            d /= d.shape[0] * BATCH
            grads = {"out": np.einsum("tbh,tbl->hl", both, d), "bias": d.sum((0, 1))}
            dh = d @ p["out"].T
            for k, up in (("ahead", dh[:, :, :HIDDEN]), ("back", dh[::-1, :, HIDDEN:])):
                g = _backward({"w": p[f"{k}.w"], "u": p[f"{k}.u"]}, sides[k], runs[k][1], up)
                grads |= {f"{k}.{name}": v for name, v in g.items()}
            for k, g in grads.items():  # Adam
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.01 * (g * g - second[k])
                p[k] -= (RATE * (1 - 0.9 * step / STEPS) * first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    side = lambda k: {"w": p[f"{k}.w"], "u": p[f"{k}.u"]}
    return Model(languages, side("ahead"), side("back"), p["out"], p["bias"])


def sampled(text: Column, seed: Column) -> Column:
    """A text of up to PIECES x PIECE characters as it is; of a longer one so many pieces at places drawn by hash, in the order of their places."""
    last = F.length(text) - PIECE
    places = F.transform(F.sequence(F.lit(0), F.lit(PIECES - 1)), lambda k: F.pmod(F.xxhash64(seed, k), last + 1).cast("int"))
    drawn = F.array_join(F.transform(F.array_sort(places), lambda at: F.substr(text, at + 1, F.lit(PIECE))), "\n")
    return F.when(F.length(text) > PIECES * PIECE, drawn).otherwise(text)


def learn(docs: DataFrame) -> Model:
    """Fits on PER_LANGUAGE rows a language at most, those of least hash of doc_id and text; equal ids and equal rows are rows like others."""
    text = sampled(F.col("text").cast("string"), F.col("doc_id").cast("long"))
    known = docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull() & (id_part(4) != 2)).select(F.col("lang").cast("string").alias("lang"), text.alias("text"), F.xxhash64(F.col("doc_id").cast("long"), F.lit(4)).alias("h"))
    order = F.row_number().over(Window.partitionBy("lang").orderBy("h", F.xxhash64("text")))
    return train(sorted((r["text"].encode(), r["lang"]) for r in known.withColumn("order", order).filter(F.col("order") <= PER_LANGUAGE).collect()))


def predict_languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of each row.

    lang_pred is `und`, with score 0, where the text is null or empty or has no letter, and where there is nothing to learn
    from. One language alone is always predicted, with score 1. Rows of null lang aren't learned from; null doc_ids neither.
    Repeated rows come back repeated. Other columns are left aside.
    """
    model = docs.sparkSession.sparkContext.broadcast(learn(docs))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        letter, m = regex.compile(r"\p{L}").search, model.value
        for batch in batches:
            names, scores = ["und"] * len(batch), [0.0] * len(batch)
            if m.languages:
                mean = m.documents(*flat_bytes(batch.column("text")))
                for i, text in enumerate(batch.column("text").to_pylist()):
                    if letter(text):
                        names[i], scores[i] = m.languages[int(mean[i].argmax())], float(min(1.0, mean[i].max()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    return texts(docs).withColumn("held_out", id_part(4) == 2).select("doc_id", "held_out", "text").mapInArrow(predict, "doc_id long, held_out boolean, lang_pred string, score double")
