"""Language of whole texts by a bidirectional gated recurrent network over bytes, in numpy.

Two recurrent layers, one in each direction, read chunks of ``CHUNK`` bytes; every
position gets probabilities of all languages, and a text's are the mean over its
positions. The network is trained by backpropagation through time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spindlewatch.llm.common import fold, query, slices, small, table, texts_of

HIDDEN = 8
CHUNK = 128
TEXTS = 400  # training texts of each language, at most
CHUNKS = 6  # training chunks of a text, at most
STEPS = 500
BATCH = 192
TRAIN_CHUNK = 48
_LETTER = regex.compile(r"\p{L}")


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


class Network:
    """Weights: for each direction input (256 x 3H, one row a byte), recurrent (H x 3H), bias;
    output (2H x languages) and its bias. Gates lie in the order update, reset, candidate."""

    def __init__(self, languages: int, hidden: int = HIDDEN, seed: int = 3):
        random = np.random.default_rng(seed)
        draw = lambda *shape: (random.normal(size=shape) * 0.3).astype(np.float32)
        self.hidden = hidden
        self.weights = {}
        for side in "fb":
            self.weights[f"x{side}"] = draw(256, 3 * hidden)
            self.weights[f"h{side}"] = draw(hidden, 3 * hidden)
            self.weights[f"c{side}"] = np.zeros(3 * hidden, np.float32)
        self.weights["out"] = draw(2 * hidden, languages)
        self.weights["bias"] = np.zeros(languages, np.float32)

    def states(self, data: np.ndarray, side: str, trace: list | None = None) -> np.ndarray:
        """Hidden states (time x chunk x H) for bytes (time x chunk), in reading direction ``side``."""
        n, h = self.hidden, np.zeros((data.shape[1], self.hidden), np.float32)
        inputs = self.weights[f"x{side}"] + self.weights[f"c{side}"]
        recurrent = self.weights[f"h{side}"]
        gates, fresh = np.ascontiguousarray(recurrent[:, : 2 * n]), np.ascontiguousarray(recurrent[:, 2 * n :])
        out = np.empty((*data.shape, n), np.float32)
        for t in range(len(data)) if side == "f" else reversed(range(len(data))):
            given = inputs[data[t]]
            both = _sigmoid(given[:, : 2 * n] + h @ gates)
            update, reset = both[:, :n], both[:, n:]
            candidate = np.tanh(given[:, 2 * n :] + (reset * h) @ fresh)
            if trace is not None:
                trace.append((t, h, update, reset, candidate))
            h = h + update * (candidate - h)
            out[t] = h
        return out

    def probabilities(self, data: np.ndarray) -> np.ndarray:
        """(time x languages x chunk), the forward pass of whole texts.

        The chunks are the last axis throughout, so every step works on long
        contiguous rows; ``states`` keeps the layout that training needs.
        """
        n, width = self.hidden, data.shape[1]
        p = np.empty((len(data), len(self.weights["bias"]), width), np.float32)
        p[:] = self.weights["bias"][:, None]
        half = np.repeat(np.float32([0.5, 0.5, 1]), n)  # a gate is 0.5 + 0.5 * tanh(0.5 * x)
        for k, side in enumerate("fb"):
            inputs = np.ascontiguousarray(((self.weights[f"x{side}"] + self.weights[f"c{side}"]) * half).T)
            recurrent = np.ascontiguousarray((self.weights[f"h{side}"] * half).T)
            gates, fresh = recurrent[: 2 * n], recurrent[2 * n :]
            reading = np.ascontiguousarray(self.weights["out"][k * n : (k + 1) * n].T)
            h = np.zeros((n, width), np.float32)
            for t in range(len(data)) if side == "f" else reversed(range(len(data))):
                given = inputs.take(data[t], axis=1, mode="clip")
                both = gates @ h
                both += given[: 2 * n]
                np.tanh(both, out=both)
                both *= 0.5
                both += 0.5
                update, reset = both[:n], both[n:]
                candidate = fresh @ (reset * h)
                candidate += given[2 * n :]
                np.tanh(candidate, out=candidate)
                candidate -= h
                candidate *= update
                h += candidate
                p[t] += reading @ h
        p -= p.max(axis=1, keepdims=True)
        np.exp(p, out=p)
        p /= p.sum(axis=1, keepdims=True)
        return p

    def _softmax(self, states: np.ndarray) -> np.ndarray:
        logits = states @ self.weights["out"] + self.weights["bias"]
        logits -= logits.max(axis=2, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=2, keepdims=True)
        return logits

    def gradients(self, data: np.ndarray, labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss over positions and its gradients, by backpropagation through time.

        A byte 0 is padding: the layers read it, as they do behind a whole text's
        end, but its position counts for nothing.
        """
        n = self.hidden
        traces = {"f": [], "b": []}
        states = np.concatenate([self.states(data, s, traces[s]) for s in "fb"], axis=2)
        p = self._softmax(states)
        inside = data != 0
        positions = max(1, int(inside.sum()))
        loss = -float((np.log(p[:, np.arange(len(labels)), labels] + 1e-9) * inside).sum() / positions)
        p[:, np.arange(len(labels)), labels] -= 1
        p *= inside[:, :, None]
        p /= positions
        grads = {"out": np.einsum("tbh,tbl->hl", states, p), "bias": p.sum(axis=(0, 1))}
        above = p @ self.weights["out"].T
        for k, side in enumerate("fb"):
            recurrent = self.weights[f"h{side}"]
            steps, dh = np.empty((len(data), data.shape[1], 3 * n), np.float32), np.zeros_like(recurrent)
            back = np.zeros((data.shape[1], n), np.float32)
            for t, h, update, reset, candidate in reversed(traces[side]):
                back = back + above[t, :, k * n : (k + 1) * n]
                given = steps[t]
                given[:, :n] = back * (candidate - h) * update * (1 - update)
                given[:, 2 * n :] = back * update * (1 - candidate**2)
                through = given[:, 2 * n :] @ recurrent[:, 2 * n :].T
                given[:, n : 2 * n] = through * h * reset * (1 - reset)
                dh[:, : 2 * n] += h.T @ given[:, : 2 * n]
                dh[:, 2 * n :] += (reset * h).T @ given[:, 2 * n :]
                back = back * (1 - update) + through * reset + given[:, : 2 * n] @ recurrent[:, : 2 * n].T
            flat = np.ascontiguousarray(steps.reshape(-1, 3 * n).T)
            dx = np.stack([np.bincount(data.ravel(), own, 256) for own in flat], axis=1).astype(np.float32)
            grads[f"x{side}"], grads[f"h{side}"], grads[f"c{side}"] = dx, dh, dx.sum(axis=0)
        return loss, grads

    def train(self, chunks: np.ndarray, labels: np.ndarray, steps: int, batch: int, seed: int = 1) -> list[float]:
        """Adam over random batches that draw every language alike; ``chunks`` are rows of bytes."""
        random = np.random.default_rng(seed)
        weight = 1 / np.bincount(labels)[labels]
        weight /= weight.sum()
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        losses = []
        for step in range(1, steps + 1):
            chosen = random.choice(len(chunks), batch, p=weight)
            loss, grads = self.gradients(np.ascontiguousarray(chunks[chosen].T), labels[chosen])
            losses.append(loss)
            rate = 0.03 * min(1, 2 * (1 - step / (steps + 1)))
            for k, g in grads.items():
                g = np.clip(g, -1, 1)
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                fixed = (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
                self.weights[k] = (self.weights[k] - rate * fixed).astype(np.float32)
        return losses

    def pooled(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Mean probabilities over the positions of each whole text, and how many positions each label got."""
        languages = len(self.weights["bias"])
        total, seen = np.zeros((len(texts), languages)), np.zeros((len(texts), languages), np.int64)
        for low, high in slices([len(t) + CHUNK for t in texts], CHUNK * 2048):
            padded = [t + b"\0" * (-len(t) % CHUNK) for t in texts[low:high]]
            whole = np.frombuffer(b"".join(padded), np.uint8).reshape(-1, CHUNK)
            own = np.repeat(np.arange(low, high), [len(t) // CHUNK for t in padded])
            length = np.full(len(whole), CHUNK)
            for i, t in enumerate(texts[low:high], low):
                if len(t) % CHUNK:
                    length[np.searchsorted(own, i, "right") - 1] = len(t) % CHUNK
            for at in range(0, len(whole), 2048):
                data = np.ascontiguousarray(whole[at : at + 2048].T)
                p = self.probabilities(data)
                inside = np.arange(CHUNK)[:, None] < length[at : at + 2048]
                p *= inside[:, None, :]
                best, top = np.where(inside, 0, languages).astype(np.int16), p[:, 0].copy()
                for c in range(1, languages):
                    best[p[:, c] > top] = c
                    np.maximum(top, p[:, c], out=top)
                np.add.at(total, own[at : at + 2048], p.sum(axis=0).T)
                for c in range(languages):
                    np.add.at(seen[:, c], own[at : at + 2048], (best == c).sum(axis=0))
        sizes = np.maximum(1, [len(t) for t in texts])[:, None]
        return total / sizes, seen


def fitted(docs: DataFrame) -> tuple[list[str], Network | None]:
    """Languages and a network trained on ``TEXTS`` texts of each, at most, drawn by a hash of the id.

    Of a drawn text ``CHUNKS`` pieces of ``TRAIN_CHUNK`` bytes are learnt from,
    evenly spread over all of it; a shorter text is one padded piece.
    """
    known = docs.where("doc_id is not null and lang is not null and text is not null").where(fold("doc_id", 3) != 1)
    by_hash = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    drawn = known.select("doc_id", "lang").withColumn("no", F.row_number().over(by_hash)).where(F.col("no") <= TEXTS)
    # As many rows as languages times TEXTS; the merge join needs no bound.
    rows = (
        known.select("doc_id", "lang", "text").join(drawn.select("doc_id", "lang").distinct(), ["doc_id", "lang"])
        .mapInArrow(_chunked, "doc_id long, lang string, chunk binary")
        .orderBy("doc_id", "chunk")
        .collect()
    )
    if not rows:
        return [], None
    languages = sorted({r.lang for r in rows})
    chunks = np.frombuffer(b"".join(r.chunk for r in rows), np.uint8).reshape(-1, TRAIN_CHUNK)
    network = Network(len(languages))
    network.train(chunks, np.array([languages.index(r.lang) for r in rows]), STEPS, BATCH)
    return languages, network


def _chunked(batches):
    for batch in small(batches):
        out = []
        for identity, lang, text in zip(batch.column("doc_id").to_pylist(), batch.column("lang").to_pylist(), texts_of(batch)):
            if not text:
                continue
            text = text.ljust(TRAIN_CHUNK, b"\0")
            places = np.unique(np.linspace(0, len(text) - TRAIN_CHUNK, CHUNKS).astype(int))
            out += [(identity, lang, text[p : p + TRAIN_CHUNK]) for p in places]
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out), (pa.int64(), pa.string(), pa.binary()))], ["doc_id", "lang", "chunk"]
            )


def predict_language(docs: DataFrame) -> DataFrame:
    """``docs`` as (id, lang_pred, score, positions), a row for a row; language, source and id are not inputs.

    ``positions`` counts the positions that each language was given. A null text
    or one without letters is ``und`` with score 0, as is every text if nothing
    can be learnt. Ties go to the first language in order.
    """
    languages, network = fitted(docs)

    def run(batches):
        for batch in small(batches):
            texts = batch.column("text").to_pylist()
            raw = texts_of(batch)
            lettered = [t is not None and network is not None and bool(_LETTER.search(t)) for t in texts]
            names, scores, places = ["und"] * len(texts), [0.0] * len(texts), [None] * len(texts)
            chosen = [i for i, ok in enumerate(lettered) if ok]
            if chosen:
                p, seen = network.pooled([raw[i] for i in chosen])
                for i, row, own in zip(chosen, p, seen):
                    best = int(row.argmax())
                    names[i], scores[i] = languages[best], min(1.0, float(row[best]))
                    places[i] = own.tolist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(names), pa.array(scores), pa.array(places, pa.list_(pa.int64()))],
                ["id", "lang_pred", "score", "positions"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "id long, lang_pred string, score double, positions array<long>")


@query
def op3_language_gru(spark, sf_dir):
    found = predict_language(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), (fold("id", 3) == 1).alias("held_out"), "lang_pred", "score")
