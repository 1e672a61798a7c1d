"""Language of texts by a bidirectional gated recurrent network over bytes.

Two gated recurrent layers read windows of a text's bytes, one from each end; both states together
label every byte with a language, and the labels' probabilities are averaged over the whole
document. The network is trained in numpy by backpropagation through time on windows of at most
`PER_LANGUAGE` documents of each language, chosen by a hash; every byte of every text is labelled.

Defined results: `und` with score 0 where the text is null, empty or has no letter, and for every
text if nothing can be learned; among equal probabilities the first language by code point; very long
texts are labelled whole, some thousand windows at a time; equal rows give equal results; an empty
table gives no rows; columns other than doc_id, text and (to learn from) lang are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from liftlens.llm.common import fold, slices

FOLDS, HELD_OUT = 5, 0
PER_LANGUAGE = 400  # documents to learn from
WINDOW = 96  # bytes
PER_DOCUMENT = 6  # windows to learn from
HIDDEN = 12
STEPS, BATCH, RATE = 500, 96, 0.02
LANES = 2048  # windows that are read together
PART = 1 << 20  # bytes of texts that are labelled together
PAD = 256
_LETTER = re.compile(r"[^\W\d_]")


def sigmoid(x):
    return 0.5 * (1.0 + np.tanh(0.5 * x))


@dataclass
class Network:
    languages: list[str]
    weights: dict[str, np.ndarray]


def initial(languages: list[str], rng) -> Network:
    w = {}
    for d in "fb":
        w["x" + d] = rng.normal(0, 0.3, (257, 3 * HIDDEN))
        w["u" + d] = rng.normal(0, 0.3, (HIDDEN, 3 * HIDDEN))
        w["o" + d] = rng.normal(0, 0.3, (HIDDEN, len(languages)))
    w["c"] = np.zeros(len(languages))
    return Network(languages, {k: v.astype(np.float32) for k, v in w.items()})


def layer(w, d: str, data: np.ndarray):
    """States after each byte (time, lanes, HIDDEN), and the gates for the way back.
    Columns of the weights: update gate, reset gate, candidate."""
    h = np.zeros((data.shape[1], HIDDEN), np.float32)
    x, u, states, gates = w["x" + d], w["u" + d], [], []
    for row in data:
        a, b = x[row], h @ u
        zr = sigmoid(a[:, :2 * HIDDEN] + b[:, :2 * HIDDEN])
        z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
        inner = b[:, 2 * HIDDEN:]
        c = np.tanh(a[:, 2 * HIDDEN:] + r * inner)
        gates.append((h, z, r, c, inner))
        h = c + z * (h - c)
        states.append(h)
    return states, gates


def probabilities(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def gradients(net: Network, data: np.ndarray, target: np.ndarray):
    """Of the mean cross entropy over all bytes; `data` is (time, lanes)."""
    w, steps = net.weights, len(data)
    sides = {"f": data, "b": data[::-1]}
    runs = {d: layer(w, d, rows) for d, rows in sides.items()}
    ahead = np.stack(runs["f"][0])
    back = np.stack(runs["b"][0][::-1])
    p = probabilities(ahead @ w["of"] + back @ w["ob"] + w["c"])
    mask = (data != PAD)[..., None]
    delta = p.copy()
    delta[:, np.arange(data.shape[1]), target] -= 1
    delta = (delta * mask / mask.sum()).astype(np.float32)
    g = {"c": delta.sum(axis=(0, 1)), "of": np.einsum("tnh,tnk->hk", ahead, delta),
         "ob": np.einsum("tnh,tnk->hk", back, delta)}
    for d, rows in sides.items():
        states, gates = runs[d]
        u = w["u" + d]
        gx, gu = np.zeros_like(w["x" + d]), np.zeros_like(u)
        from_above = (delta if d == "f" else delta[::-1]) @ w["o" + d].T
        dh = np.zeros_like(states[0])
        for t in range(steps - 1, -1, -1):
            h, z, r, c, inner = gates[t]
            dh = dh + from_above[t]
            dc = dh * (1 - z) * (1 - c * c)
            dz = dh * (h - c) * z * (1 - z)
            dr = dc * inner * r * (1 - r)
            da = np.concatenate([dz, dr, dc], axis=1)
            db = np.concatenate([dz, dr, dc * r], axis=1)
            np.add.at(gx, rows[t], da)
            gu += h.T @ db
            dh = dh * z + db @ u.T
        g["x" + d], g["u" + d] = gx, gu
    return g


def train(samples: list[tuple[bytes, str]]) -> Network | None:
    """A network from windows of bytes and their languages (Adam, falling rate)."""
    languages = sorted({lang for _, lang in samples})
    if not languages:
        return None
    rng = np.random.default_rng(11)
    net = initial(languages, rng)
    by_language = [[b for b, lang in samples if lang == own] for own in languages]
    first = {k: np.zeros_like(v) for k, v in net.weights.items()}
    second = {k: np.zeros_like(v) for k, v in net.weights.items()}
    for step in range(1, STEPS + 1):
        target = rng.integers(0, len(languages), BATCH)
        data = np.full((BATCH, WINDOW), PAD)
        for row, k in zip(data, target):
            own = by_language[k][rng.integers(len(by_language[k]))]
            row[:len(own)] = np.frombuffer(own, np.uint8)
        for k, g in gradients(net, data.T, target).items():
            g = np.clip(g, -0.1, 0.1)
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            rate = RATE * (1 - step / (STEPS + 1)) * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
            net.weights[k] -= (rate * first[k] / (np.sqrt(second[k]) + 1e-8)).astype(np.float32)
    return net


def stepped(h: np.ndarray, row: np.ndarray, x: np.ndarray, u: np.ndarray) -> np.ndarray:
    """The next states (HIDDEN, lanes) after a byte in each lane."""
    a, b = x[:, row], u @ h
    zr = sigmoid(a[:2 * HIDDEN] + b[:2 * HIDDEN])
    c = np.tanh(a[2 * HIDDEN:] + zr[HIDDEN:] * b[2 * HIDDEN:])
    return c + zr[:HIDDEN] * (h - c)


def pooled(net: Network, texts: list[bytes]) -> np.ndarray:
    """Per text the mean over all its bytes of their label probabilities."""
    sums = np.zeros((len(texts), len(net.languages)))
    lengths = np.array([len(t) for t in texts])
    numbers = -(-lengths // WINDOW)
    all_bytes = np.full(int(numbers.sum()) * WINDOW, PAD, np.int16)
    starts = np.concatenate([[0], np.cumsum(numbers)[:-1]]) * WINDOW
    for start, text in zip(starts, texts):
        all_bytes[start:start + len(text)] = np.frombuffer(text, np.uint8)
    windows = all_bytes.reshape(-1, WINDOW)
    owner = np.repeat(np.arange(len(texts)), numbers)
    # lanes in the last dimension, which makes every operation run along them
    w = {k: np.ascontiguousarray(v.T) for k, v in net.weights.items()}
    for at in range(0, len(windows), LANES):
        data = windows[at:at + LANES].T
        blank = np.zeros((HIDDEN, data.shape[1]), np.float32)
        ahead, h = [], blank
        for row in data:
            h = stepped(h, row, w["xf"], w["uf"])
            ahead.append(h)
        total, h = np.zeros((len(net.languages), data.shape[1])), blank
        for row, other in zip(data[::-1], ahead[::-1]):
            h = stepped(h, row, w["xb"], w["ub"])
            e = np.exp(w["of"] @ other + w["ob"] @ h + w["c"][:, None])
            total += e / e.sum(axis=0) * (row != PAD)
        np.add.at(sums, owner[at:at + LANES], total.T)
    return sums / np.maximum(lengths, 1)[:, None]


def predictions(net: Network | None, texts: list[str | None]) -> list[tuple[str, float]]:
    out = [("und", 0.0)] * len(texts)
    some = [i for i, t in enumerate(texts) if t and net and _LETTER.search(t)]
    if some:
        p = pooled(net, [texts[i].encode() for i in some])
        for i, row in zip(some, p):
            k = int(row.argmax())
            out[i] = net.languages[k], min(1.0, float(row[k]))
    return out


def samples(docs: DataFrame, per_language: int) -> list[tuple[bytes, str]]:
    """Windows spread over the sampled documents: a bounded number per language."""
    known = docs.where("lang is not null and text != ''").where(fold("doc_id", FOLDS) != HELD_OUT)
    h = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    order = Window.partitionBy("lang").orderBy(h, F.length("text"))
    size = F.length("text")
    step = F.greatest(F.lit(1), F.floor(size / PER_DOCUMENT))
    cut = F.transform(F.sequence(F.lit(0), F.lit(PER_DOCUMENT - 1)),
                      lambda i: F.substr("text", (i * step + 1).cast("int"), F.lit(WINDOW)))
    chosen = known.select("lang", cut.alias("cut"), F.row_number().over(order).alias("row"))
    rows = chosen.where(F.col("row") <= per_language).select("lang", "row", "cut")
    found = rows.orderBy("lang", "row").collect()
    out = [(c.encode()[:WINDOW], r["lang"]) for r in found for c in r["cut"]]
    return [(c, lang) for c, lang in out if len(c) >= 8] or [(c, lang) for c, lang in out if c]


def identify(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""
    net = train(samples(docs, per_language))
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches):
        for part in slices(batches, 2, PART):
            found = predictions(shared.value, part.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array([x for x, _ in found], pa.string()),
                 pa.array([s for _, s in found], pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select("doc_id", (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
