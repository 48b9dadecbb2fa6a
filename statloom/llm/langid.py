"""Language of whole texts by a bidirectional gated recurrent network over bytes.

A text's bytes are dealt into windows of a fixed length; in each, one network reads forwards and
one backwards, both states together give every position probabilities of the languages, and a
document's probabilities are the mean over all its positions. The windows cover the whole text, so
time is linear and memory bounded by one block of windows. Training is backpropagation through
time, with Adam, in numpy on the driver: on at most `per_language` distinct labelled texts of each language
(those with the smallest hash of the text) and, of a long one, `train_chars` characters from all over it: a bound
that grows with the number of languages and not with the table. Every labelled language is learned; the networks'
states and the steps of training grow with their number. Every document is then predicted from its whole text.

A null text, or one without a letter, gets `und` and score 0. With no labelled text at all every
document gets `und`. Rows are treated one by one: repeated rows and ids give repeated rows. Other
columns are not looked at.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import map_batches, spread

WINDOW = 64
HIDDEN = 8
BLOCK = 4096  # windows computed at once


def _sigmoid(x):
    x *= 0.5
    np.tanh(x, x)
    x += 1
    x *= 0.5
    return x


class ByteGru:
    """Two gated recurrent networks over bytes and a linear layer over their states.

    Gates of a direction lie side by side: update z, reset r, candidate n.
    """

    def __init__(self, labels: list[str], hidden: int | None = None, seed: int = 7):
        rng = np.random.default_rng(seed)
        hidden = hidden or max(HIDDEN, 4 * math.ceil(math.log2(max(2, len(labels)))))
        self.labels, self.hidden = labels, hidden
        self.p = {"out": rng.normal(0, 0.3, (2 * hidden, len(labels))), "bias": np.zeros(len(labels))}
        for d in "fb":
            self.p["in" + d] = rng.normal(0, 0.3, (256, 3 * hidden))
            self.p["rec" + d] = rng.normal(0, 0.3, (hidden, 3 * hidden))
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def states(self, x: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        """States (time, windows, hidden) of one direction over bytes x (time, windows)."""
        h2, w, u = 2 * self.hidden, self.p["in" + d], self.p["rec" + d]
        out = np.zeros((len(x) + 1, x.shape[1], self.hidden), np.float32)
        for t in range(len(x)) if d == "f" else range(len(x) - 1, -1, -1):
            h = out[t] if d == "f" else out[t + 1]
            a, r = w.take(x[t], 0), h @ u
            gates = _sigmoid(a[:, :h2] + r[:, :h2])
            z, reset = gates[:, :self.hidden], gates[:, self.hidden:]
            n = np.tanh(a[:, h2:] + reset * r[:, h2:])
            new = out[t + 1] if d == "f" else out[t]
            np.subtract(h, n, out=new)
            new *= z
            new += n
            if keep is not None:
                keep.append((t, h, gates, n, r[:, h2:]))
        return out[1:] if d == "f" else out[:-1]

    def position_probabilities(self, x: np.ndarray) -> np.ndarray:
        """Probabilities (labels, windows) summed over the positions that x (time, windows) marks.

        Features come first here, so that the parts of a gate lie together. A byte of 0 to 255 counts;
        256 stands for no byte.
        """
        k, (steps, n) = self.hidden, x.shape
        score = np.empty((steps, len(self.labels), n), np.float32)
        score[:] = self.p["bias"][:, None]
        a, r = np.empty((3 * k, n), np.float32), np.empty((3 * k, n), np.float32)
        for d, part in (("f", slice(0, k)), ("b", slice(k, 2 * k))):
            w = np.ascontiguousarray(np.concatenate([self.p["in" + d], np.zeros((1, 3 * k), np.float32)]).T)
            w[:2 * k] *= 0.5  # sigmoid(v) = (1 + tanh(v / 2)) / 2
            u = np.ascontiguousarray(self.p["rec" + d].T)
            u[:2 * k] *= 0.5
            v = np.ascontiguousarray(self.p["out"][part].T)
            h = np.zeros((k, n), np.float32)
            for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
                np.take(w, x[t], 1, out=a, mode="clip")
                np.matmul(u, h, out=r)
                gates, new = a[:2 * k], a[2 * k:]
                gates += r[:2 * k]
                np.tanh(gates, gates)
                gates *= 0.5
                gates += 0.5
                r[2 * k:] *= gates[k:]
                new += r[2 * k:]
                np.tanh(new, new)
                h -= new
                h *= gates[:k]
                h += new
                score[t] += v @ h
        score -= score.max(1, keepdims=True)
        np.exp(score, score)
        score /= score.sum(1, keepdims=True)
        score *= (x < 256)[:, None]
        return score.sum(0)

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
        """Mean loss over all positions and its gradients, back through time."""
        k, out = self.hidden, self.p["out"]
        kept: dict[str, list] = {"f": [], "b": []}
        s = {d: self.states(x, d, kept[d]) for d in "fb"}
        logit = s["f"] @ out[:k] + s["b"] @ out[k:] + self.p["bias"]
        logit -= logit.max(-1, keepdims=True)
        prob = np.exp(logit)
        prob /= prob.sum(-1, keepdims=True)
        rows = np.arange(x.shape[1])
        loss = -np.log(prob[:, rows, y] + 1e-9).mean()
        prob[:, rows, y] -= 1
        prob /= x.size
        g = {n: np.zeros_like(v) for n, v in self.p.items()}
        g["bias"] = prob.sum((0, 1))
        for d, part in (("f", slice(0, k)), ("b", slice(k, 2 * k))):
            g["out"][part] = np.einsum("tnh,tnc->hc", s[d], prob)
            above, u = prob @ out[part].T, self.p["rec" + d]
            carry = np.zeros_like(above[0])
            for t, h, gates, n, rn in reversed(kept[d]):
                z, reset = gates[:, :k], gates[:, k:]
                dh = above[t] + carry
                dn = dh * (1 - z) * (1 - n * n)
                dz = dh * (h - n) * z * (1 - z)
                dr = dn * rn * reset * (1 - reset)
                da = np.concatenate([dz, dr, dn], 1)
                dr_in = np.concatenate([dz, dr, dn * reset], 1)
                np.add.at(g["in" + d], x[t], da)
                g["rec" + d] += h.T @ dr_in
                carry = dh * z + dr_in @ u.T
        return float(loss), g

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int = 400, batch: int = 256, rate: float = 0.02, seed: int = 7) -> ByteGru:
        """Adam over random batches of windows x (windows, time) with labels y."""
        rng = np.random.default_rng(seed)
        m = {n: np.zeros_like(v) for n, v in self.p.items()}
        v = {n: np.zeros_like(w) for n, w in self.p.items()}
        order = np.argsort(y, kind="stable")
        sizes = np.bincount(y)
        ends, present = np.cumsum(sizes), np.flatnonzero(sizes)
        for step in range(1, steps + 1):
            c = rng.choice(present, batch)
            at = order[ends[c] - sizes[c] + (rng.random(batch) * sizes[c]).astype(np.int64)]
            _, g = self.gradients(np.ascontiguousarray(x[at].T), y[at])
            lr = rate * min(1.0, 2 * (1 - step / (steps + 1)))
            for n, d in g.items():
                m[n] += 0.1 * (d - m[n])
                v[n] += 0.01 * (d * d - v[n])
                self.p[n] -= (lr * (m[n] / (1 - 0.9**step)) / (np.sqrt(v[n] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
        return self

    def predict(self, texts: list[bytes]) -> np.ndarray:
        """Mean probabilities over all positions of each text; zeros for an empty one."""
        total = np.zeros((len(texts), len(self.labels)))
        windows: list[np.ndarray] = []
        owners: list[np.ndarray] = []
        held = 0
        for i, text in enumerate(texts):
            for at in range(0, len(text), WINDOW * BLOCK):
                w, size = cut(text[at:at + WINDOW * BLOCK])
                windows.append(w)
                owners.append(np.stack([np.full(len(w), i), size], 1))
                held += len(w)
                if held >= BLOCK:
                    self._add(windows, owners, total)
                    windows, owners, held = [], [], 0
        if windows:
            self._add(windows, owners, total)
        length = np.array([max(1, len(t)) for t in texts], float)[:, None]
        return total / length if len(texts) else total

    def _add(self, windows, owners, total) -> None:
        x, own = np.concatenate(windows), np.concatenate(owners)
        block = max(64, BLOCK * 8 // max(8, len(self.labels)))  # what is held grows with windows times labels
        for at in range(0, len(x), block):
            o = own[at:at + block]
            y = np.ascontiguousarray(x[at:at + block].T).astype(np.intp)
            y[np.arange(WINDOW)[:, None] >= o[None, :, 1]] = 256
            np.add.at(total, o[:, 0], self.position_probabilities(y).T)


def cut(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Windows of a text as rows of bytes, the last one filled with blanks, and their sizes."""
    n = -(-len(text) // WINDOW)
    w = np.full(n * WINDOW, 32, np.uint8)
    w[:len(text)] = np.frombuffer(text, np.uint8)
    size = np.full(n, WINDOW)
    if n:
        size[-1] = len(text) - (n - 1) * WINDOW
    return w.reshape(n, WINDOW), size


def training_windows(text: bytes) -> np.ndarray:
    """Windows that cover a whole text; the last one of a longer text lies back over the one before."""
    w, size = cut(text)
    if len(w) > 1 and size[-1] < WINDOW:
        w[-1] = np.frombuffer(text[-WINDOW:], np.uint8)
    return w


def train(labelled: DataFrame, text: str = "text", label: str = "lang", key: str = "doc_id", per_language: int = 150,
          train_chars: int = 4096, steps: int | None = None) -> ByteGru | None:
    """The network, from a bounded sample of the texts of every labelled language; None if there are none.

    The sample is the `per_language` distinct texts of each language with the smallest hash; of long ones
    `train_chars` characters. Equal texts are one, so copies do not fill it.
    """
    known = labelled.select(
        F.col(key).alias("k"), F.col(label).alias("y"), F.col(text).alias("x"),
    ).where("y IS NOT NULL AND x RLIKE '\\\\p{L}'")
    # Spark keeps the first rows of each language in every task before it deals them by language.
    first = Window.partitionBy("y").orderBy("o")
    picked = (
        known.select("y", F.xxhash64("x").alias("o")).distinct()
        .withColumn("n", F.row_number().over(first)).where(F.col("n") <= per_language).drop("n"))
    texts = known.select("y", F.xxhash64("x").alias("o"), spread(F.col("x"), train_chars).alias("x"))
    rows = texts.join(picked, ["y", "o"]).groupBy("y", "o").agg(F.min("x").alias("x")).orderBy("o", "y").collect()
    if not rows:
        return None
    labels = sorted({r.y for r in rows})
    place = {y: i for i, y in enumerate(labels)}
    xs = [training_windows(r.x.encode("utf-8")) for r in rows]
    x, y = np.concatenate(xs), np.concatenate([np.full(len(w), place[r.y]) for w, r in zip(xs, rows)])
    # Every language weighs the same, however long its texts are: one is drawn, then a window of it.
    return ByteGru(labels).fit(x, y, steps or 400 + 2 * max(0, len(labels) - 8))


def identify(docs: DataFrame, model: ByteGru | None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, lang_pred, score for every row: the likeliest language and its mean probability."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # a few thousand numbers

    def run(batch: pa.RecordBatch):
        own = sent.value
        texts = [x or "" for x in batch.column(1).to_pylist()]
        lettered = [own is not None and any(map(str.isalpha, x)) for x in texts]
        p = own.predict([x.encode("utf-8") if ok else b"" for x, ok in zip(texts, lettered)]) if own else np.zeros((len(texts), 1))
        best = p.argmax(1)
        lang = [own.labels[i] if ok else "und" for i, ok in zip(best, lettered)]
        score = np.clip(np.where(lettered, p.max(1), 0.0), 0, 1)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang, pa.string()), pa.array(score)], names=[key, "lang_pred", "score"])

    kind = docs.select(key).schema[0].dataType.simpleString()
    return map_batches(docs.select(key, text), run, f"{key} {kind}, lang_pred string, score double")
