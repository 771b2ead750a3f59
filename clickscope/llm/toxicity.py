"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained in numpy.

A word (a run of bytes between white space and ASCII punctuation, A-Z lowered) enters as the embedding of
its hash beside the mean embedding of its character trigrams (over UTF-8), so unseen forms of a known stem still speak. Two GRUs read a window of WINDOW words forwards and backwards; attention
pools their states; a linear layer gives the window's logit. A document is scored by its highest window,
over all windows (they start every STRIDE words, so every passage of STRIDE words lies whole in one).

Training fits on a bounded sample: at most `per_class` labelled documents of each class (smallest hashes of
doc_id), all windows of each. Labels belong to documents, so every epoch trains on the highest window of each
document and on half as many random clean ones; a first epoch on all windows, where each document weighs the
same, starts it off. A fifth of the sample calibrates the scores for the true share of the classes.

Scoring runs in Arrow batches: the input side of both GRUs is computed once per distinct word of a batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW, STRIDE = 48, 24
HIDDEN, WORD_DIM, CHAR_DIM = 8, 8, 12
WORD_BITS, CHAR_BITS = 16, 15
BATCH_WORDS = 400_000
# bytes of words, lower case; 0 separates: white space, control characters and ASCII punctuation
_LETTERS = np.array([c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 0 for c in range(256)], np.uint8)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> np.uint64(32))


@dataclass(frozen=True)
class ToxicityParams:
    per_class: int = 1200
    epochs: int = 9
    rate: float = 0.02
    seed: int = 3


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


class Words:
    """The distinct words of a batch: rows of the word table and hashed trigrams; number 0 is padding.

    data: lower-case bytes; start, size: of one occurrence of every distinct word; h: their hashes.
    """

    def __init__(self, data: np.ndarray, start: np.ndarray, size: np.ndarray, h: np.ndarray):
        self.word = np.concatenate([[0], 1 + (_scramble(h) % np.uint64((1 << WORD_BITS) - 1)).astype(np.int64)])
        # every word between two marks, one after the other
        wide = size + 2
        first = np.cumsum(wide) - wide
        codes = np.zeros(int(wide.sum()) + 2, np.uint64)
        spot = np.repeat(first + 1 - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        codes[spot] = data[np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))]
        codes[first], codes[first + wide - 1] = 2, 3
        tri = _scramble(codes[:-2] << np.uint64(16) | codes[1:-1] << np.uint64(8) | codes[2:])
        self.tri = 1 + (tri[spot - 1] % np.uint64((1 << CHAR_BITS) - 1)).astype(np.int64)
        self.owner = np.repeat(np.arange(1, len(size) + 1), size)
        self.count = np.concatenate([[1], size]).astype(np.float32)

    def chars(self, table: np.ndarray) -> np.ndarray:
        """Mean trigram embedding of every word."""
        out = np.zeros((len(self.word), table.shape[1]), np.float32)
        if len(self.owner):
            first = np.flatnonzero(np.diff(self.owner, prepend=0))
            out[self.owner[first]] = np.add.reduceat(table[self.tri], first, axis=0)
            out /= self.count[:, None]
        return out

    def spread(self, grad: np.ndarray, table: np.ndarray) -> np.ndarray:
        """The gradient of the trigram table for a gradient per word."""
        out = np.zeros_like(table)
        if len(self.owner):
            np.add.at(out, self.tri, (grad / self.count[:, None])[self.owner])
        return out


def windows_of(texts: list[str | None]) -> tuple[Words, np.ndarray, np.ndarray]:
    """(distinct words, word numbers by window, document of each window). An empty text has one empty window."""
    parts = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    data = _LETTERS[np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)]
    inner = data > 0
    edge = np.diff(inner.astype(np.int8), prepend=0)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    # a hash that does not depend on the place: sums of byte * B^place, divided by B^start
    power = np.cumprod(np.full(len(data), _BASE, np.uint64))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(data * power, dtype=np.uint64)])
    back = np.cumprod(np.full(len(data), _BASE_INVERSE, np.uint64))
    _, some, number = np.unique((sums[end] - sums[start]) * back[start], return_index=True, return_inverse=True)
    h = (sums[end[some]] - sums[start[some]]) * back[start[some]]
    doc_end = np.cumsum([len(p) + 1 for p in parts])
    sizes = np.bincount(np.searchsorted(doc_end, start, "right"), minlength=len(parts)) if len(parts) else np.zeros(0, np.int64)
    total = len(start)
    ids = np.zeros(total + 1, np.int32)
    ids[:total] = number + 1
    n = np.maximum(1, -(-(sizes - (WINDOW - STRIDE)) // STRIDE))  # windows of each document
    owner = np.repeat(np.arange(len(parts)), n)
    last = np.cumsum(sizes)
    starts = (last - sizes)[owner] + STRIDE * (np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n))
    place = starts[:, None] + np.arange(WINDOW)
    place = np.where(place < last[owner][:, None], place, total)
    return Words(data, start[some], (end - start)[some], h), ids[place], owner


class Net:
    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        d, h = WORD_DIM + CHAR_DIM, HIDDEN
        init = lambda *s, k=1.0: (rng.normal(0, k / np.sqrt(s[0]), s)).astype(np.float32)
        self.p = {"word": (rng.normal(0, 0.1, (1 << WORD_BITS, WORD_DIM))).astype(np.float32),
                  "char": (rng.normal(0, 0.3, (1 << CHAR_BITS, CHAR_DIM))).astype(np.float32),
                  "att": init(2 * h),
                  "out": init(2 * h), "out_b": np.full(1, -0.5, np.float32)}
        for side in "fb":
            self.p |= {f"{side}_x": init(d, 3 * h), f"{side}_b": np.zeros(3 * h, np.float32), f"{side}_h": init(h, 3 * h)}
        self.scale, self.shift = 1.0, 0.0

    def inputs(self, words: Words) -> np.ndarray:
        x = np.hstack([self.p["word"][words.word], words.chars(self.p["char"])])
        x[0] = 0
        return x

    def _run(self, side: str, proj: np.ndarray, ids: np.ndarray, keep: bool):
        """States by step (in the order read) and what the way back needs."""
        u, h = self.p[f"{side}_h"], np.zeros((len(ids), HIDDEN), np.float32)
        order = range(WINDOW) if side == "f" else range(WINDOW - 1, -1, -1)
        states, trace, k = np.empty((WINDOW, len(ids), HIDDEN), np.float32), [], HIDDEN
        for t in order:
            a, c = proj[ids[:, t]], h @ u
            g = _sigmoid(a[:, :2 * k] + c[:, :2 * k])
            z, r = g[:, :k], g[:, k:]
            n = np.tanh(a[:, 2 * k:] + r * c[:, 2 * k:])
            new = n + z * (h - n)
            if keep:
                trace.append((t, h, z, r, n, c[:, 2 * k:]))
            states[t] = h = new
        return states, trace

    def forward(self, words: Words, ids: np.ndarray, keep: bool = False):
        x = self.inputs(words)
        sides = [self._run(s, x @ self.p[f"{s}_x"] + self.p[f"{s}_b"], ids, keep) for s in "fb"]
        states = np.concatenate([s for s, _ in sides], axis=2)
        score = np.where((ids > 0).T, states @ self.p["att"], -1e9)
        weight = np.exp(score - score.max(axis=0))
        weight = weight / weight.sum(axis=0) * (ids > 0).any(axis=1)
        pooled = (weight[:, :, None] * states).sum(axis=0)
        logit = pooled @ self.p["out"] + self.p["out_b"][0]
        return (logit, (x, sides, states, weight, pooled)) if keep else logit

    def gradients(self, words: Words, ids: np.ndarray, label: np.ndarray, importance: np.ndarray) -> dict:
        logit, (x, sides, states, weight, pooled) = self.forward(words, ids, True)
        p, k, g = self.p, HIDDEN, {}
        d = ((_sigmoid(logit) - label) * importance / len(ids)).astype(np.float32)
        g["out"], g["out_b"] = pooled.T @ d, np.array([d.sum()], np.float32)
        d_pooled = d[:, None] * p["out"]
        d_weight = (states * d_pooled).sum(axis=2)
        d_states = weight[:, :, None] * d_pooled
        d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
        g["att"] = np.einsum("tb,tbh->h", d_score, states)
        d_states = d_states + d_score[:, :, None] * p["att"]
        d_x = np.zeros_like(x)
        for i, side in enumerate("fb"):
            u, gu = p[f"{side}_h"], np.zeros_like(p[f"{side}_h"])
            d_proj = np.zeros((len(x), 3 * k), np.float32)
            carry = np.zeros((len(ids), k), np.float32)
            for t, h, z, r, n, cn in reversed(sides[i][1]):
                dh = carry + d_states[t][:, i * k:(i + 1) * k]
                dn = dh * (1 - z) * (1 - n * n)
                dz = dh * (h - n) * z * (1 - z)
                dr = dn * cn * r * (1 - r)
                da = np.hstack([dz, dr, dn])
                dc = np.hstack([dz, dr, dn * r])
                np.add.at(d_proj, ids[:, t], da)
                gu += h.T @ dc
                carry = dh * z + dc @ u.T
            g[f"{side}_h"], g[f"{side}_x"], g[f"{side}_b"] = gu, x.T @ d_proj, d_proj.sum(axis=0)
            d_proj[0] = 0  # padding has no embedding
            d_x += d_proj @ p[f"{side}_x"].T
        g["word"] = np.zeros_like(p["word"])
        np.add.at(g["word"], words.word, d_x[:, :WORD_DIM])
        g["char"] = words.spread(d_x[:, WORD_DIM:], p["char"])
        return g

    def logits(self, words: Words, ids: np.ndarray) -> np.ndarray:
        """Logits of any number of windows, in parts that fit a cache."""
        x = self.inputs(words)
        proj = [x @ self.p[f"{s}_x"] + self.p[f"{s}_b"] for s in "fb"]
        out = [self._pooled(proj, ids[a:a + 2048]) for a in range(0, len(ids), 2048)]
        return np.concatenate(out) if out else np.empty(0, np.float32)

    def _pooled(self, proj, ids):
        f, b = (self._run(s, p, ids, False)[0] for s, p in zip("fb", proj))
        k, att, out = HIDDEN, self.p["att"], self.p["out"]
        score = np.where((ids > 0).T, f @ att[:k] + b @ att[k:], np.float32(-1e9))
        weight = np.exp(score - score.max(axis=0))
        weight = weight / weight.sum(axis=0) * (ids > 0).any(axis=1)
        return (weight * (f @ out[:k] + b @ out[k:])).sum(axis=0) + self.p["out_b"][0]


def highest(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    out = np.full(n, -np.inf, np.float64)
    np.maximum.at(out, owner, values)
    return out


class _Adam:
    def __init__(self, net: Net, rate: float):
        self.net, self.rate, self.t = net, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in net.p.items()}
        self.v = {k: np.zeros_like(v) for k, v in net.p.items()}

    def step(self, grads: dict):
        self.t += 1
        fix = np.sqrt(1 - 0.999 ** self.t) / (1 - 0.9 ** self.t)
        for k, g in grads.items():
            rows = np.flatnonzero(g.any(axis=1)) if k in ("word", "char") else slice(None)
            self.m[k][rows] = 0.9 * self.m[k][rows] + 0.1 * g[rows]
            self.v[k][rows] = 0.999 * self.v[k][rows] + 0.001 * g[rows] ** 2
            self.net.p[k][rows] -= self.rate * fix * self.m[k][rows] / (np.sqrt(self.v[k][rows]) + 1e-7)


def train(texts: list[str | None], labels: np.ndarray, shares: tuple[float, float], params: ToxicityParams) -> Net:
    """Fit on whole sampled documents. shares: documents of class 0 and 1 among all labelled ones."""
    net, rng = Net(params.seed), np.random.default_rng(params.seed)
    words, ids, owner = windows_of(texts)
    fit = np.arange(len(texts)) % 5 != 0
    adam = _Adam(net, params.rate)
    for epoch in range(params.epochs):
        weight = np.ones(len(ids), np.float32)
        if epoch == 0:
            chosen = np.flatnonzero(fit[owner])
            weight = (1 / np.bincount(owner, minlength=len(texts)))[owner].astype(np.float32)
            weight /= weight.mean() if len(weight) else 1
        else:
            top = np.lexsort((-net.logits(words, ids), owner))
            top = top[np.concatenate([[True], owner[top][1:] != owner[top][:-1]])]
            clean = np.flatnonzero(labels[owner] == 0)
            more = rng.choice(clean, min(len(clean), len(texts) // 2), replace=False) if len(clean) else clean
            chosen = np.concatenate([top, more])
            chosen = chosen[fit[owner[chosen]]]
        chosen = rng.permutation(chosen)
        adam.rate = params.rate * (0.5 if epoch > params.epochs // 2 else 1.0)
        for a in range(0, len(chosen), 256):
            rows = chosen[a:a + 256]
            used, local = np.unique(ids[rows], return_inverse=True)
            part = _subset(words, used)
            y = labels[owner[rows]].astype(np.float32)
            adam.step(net.gradients(part, local.reshape(len(rows), WINDOW) + (used[0] != 0), y, weight[rows]))
    _calibrate(net, highest(net.logits(words, ids), owner, len(texts))[~fit], labels[~fit], shares)
    return net


def _subset(words: Words, used: np.ndarray) -> Words:
    """The words numbered `used`, renumbered in that order after the padding."""
    out, used = object.__new__(Words), used[used > 0]
    out.word = np.concatenate([[0], words.word[used]])
    lo, hi = np.searchsorted(words.owner, used), np.searchsorted(words.owner, used, "right")
    n = hi - lo
    at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    out.tri, out.owner = words.tri[at], np.repeat(np.arange(1, len(used) + 1), n)
    out.count = np.concatenate([[1], words.count[used]]).astype(np.float32)
    return out


def _calibrate(net: Net, logit: np.ndarray, label: np.ndarray, shares: tuple[float, float]) -> None:
    """Logistic regression of the labels on the logits, each class weighing its true share."""
    if len(set(label.tolist())) < 2:
        return
    weight = np.where(label == 1, shares[1] / (label == 1).sum(), shares[0] / (label == 0).sum())
    a, b = 1.0, 0.0
    for _ in range(2000):
        e = (_sigmoid(a * logit + b) - label) * weight
        a, b = max(a - 0.5 * float((e * logit).sum()), 0.05), b - 0.5 * float(e.sum())
    net.scale, net.shift = a, b


def score_documents(docs: DataFrame, labels: DataFrame, params: ToxicityParams = ToxicityParams()) -> DataFrame:
    """doc_id, held_out, score, predicted for every document.

    Learns from labelled rows whose crc32(doc_id as text) mod 5 is not 0; a document labelled twice is toxic
    if any label says so. With labels of one class only, every score is that class. Null and empty texts are
    one empty window. Other columns of docs are not read.
    """
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    known = (labels.where("doc_id is not null and toxic is not null").groupBy("doc_id")
             .agg(F.max((F.col("toxic") == 1).cast("int")).alias("toxic")).where(~held_out))
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    picked = [known.where(F.col("toxic") == c).orderBy(F.xxhash64(F.lit(params.seed), "doc_id"), "doc_id").limit(params.per_class)
              for c in (0, 1)]
    sample = (docs.select("doc_id", "text").join(F.broadcast(picked[0].unionByName(picked[1])), "doc_id")
              .orderBy(F.xxhash64(F.lit(params.seed + 1), "doc_id"), "doc_id", "text").limit(2 * params.per_class).collect())
    y = np.array([r["toxic"] for r in sample], np.int64)
    if len(set(y.tolist())) < 2:
        constant = float(y[0]) if len(y) else 0.0
        return docs.select("doc_id", held_out.alias("held_out"), F.lit(constant).alias("score"), F.lit(int(constant)).alias("predicted"))
    total = sum(counts.values())
    net = train([r["text"] for r in sample], y, (counts[0] / total, counts[1] / total), params)
    model = docs.sparkSession.sparkContext.broadcast((net.p, net.scale, net.shift))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = object.__new__(Net)
        own.p, own.scale, own.shift = model.value
        for batch in batches:
            texts, at = batch.column("text").to_pylist(), 0
            score = []
            while at < len(texts):
                stop, held = at, 0
                while stop < len(texts) and (stop == at or held + len(texts[stop] or "") <= 6 * BATCH_WORDS):
                    held += len(texts[stop] or "")
                    stop += 1
                words, ids, owner = windows_of(texts[at:stop])
                score.append(_sigmoid(own.scale * highest(own.logits(words, ids), owner, stop - at) + own.shift))
                at = stop
            value = np.concatenate(score) if score else np.empty(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(value, pa.float64()),
                 pa.array((value >= 0.5).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
