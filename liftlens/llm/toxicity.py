"""Toxicity by class-conditional Kneser-Ney models.

Two models of the bytes of words, learned from toxic and from ordinary documents, share
their backoff: the top order (a byte after five others, word borders included) has counts
of its own class with absolute discounting, and hands the rest to Kneser-Ney continuation counts
of both classes together. A form that neither class knows well thus gets nearly the same
probability from both. A word's evidence is its log-likelihood ratio; a document's evidence is
the length-normalised ratio over the whole text and over its most toxic passage, and a logistic
curve, fitted on evidence from models that have not seen the document, turns both into a score.

The fit reads at most `PER_CLASS` labelled documents of each class, chosen by a hash; the model
has a bounded size and is broadcast. Every whole text is scored, without a shuffle.

Defined results: null and empty texts have no evidence and get the score of zero evidence; labels
without a toxic value are ignored, several labels of a document count as their largest; without
labelled documents of both classes every score is 0; very long texts are scored whole; equal rows give
equal results; an empty table gives no rows; columns other than doc_id and text (labels: doc_id,
toxic) are not read.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from liftlens.llm.common import by_batch, fold, slices
from liftlens.operators.scale import cut_lineage

FOLDS, HELD_OUT = 4, 2
PER_CLASS = 4000
ORDER = 6
PASSAGE = 3  # words
THRESHOLD = 0.3
CACHE = 1 << 20  # bytes of words whose evidence is remembered
PARTS = 3  # of the sample; evidence for the fit comes from models of the other parts
CHUNK = 1 << 22  # bytes of text that are looked up together
PAD = b"\x00" * (ORDER - 2) + b"\x02"
END = b"\x03"
# bytes of words: A-Z in lower case, other ASCII characters than letters and digits are borders
PLAIN = bytes(ord(chr(i).lower()) if chr(i).isalnum() else 32 for i in range(128)) \
    + bytes(range(128, 256))


@dataclass
class Model:
    grams: np.ndarray  # sorted forms of ORDER bytes, packed in one number
    ratios: np.ndarray  # log ratio of the last byte after the others
    contexts: np.ndarray  # sorted contexts
    backoffs: np.ndarray  # log ratio of their backoff weights
    weights: list[float]  # of the logistic curve: constant, whole text, passage, length


def tokens(text: str | None) -> list[bytes]:
    return text.lower().encode().translate(PLAIN).split() if text else []


def forms(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Every byte of the words and their ends after the bytes before it, packed in one number;
    and where each word's forms begin."""
    text = np.frombuffer(END.join([PAD + w for w in words]) + END, np.uint8)
    packed = np.zeros(len(text), np.uint64)
    for i in range(ORDER):
        packed[i:] |= text[:len(text) - i].astype(np.uint64) << np.uint64(8 * i)
    starts = np.cumsum([0] + [len(w) + 1 for w in words[:-1]])
    return packed[(text != 0) & (text != PAD[-1])], starts


def looked_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray):
    """The values of the wanted keys (0 if unknown) and whether they are known."""
    if not len(keys):
        return np.zeros(len(wanted)), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    known = keys[at] == wanted
    return np.where(known, values[at], 0.0), known


class Scorer:
    """Evidence of texts under a model; words are remembered up to a bound."""

    def __init__(self, model: Model):
        self.model, self.known, self.size = model, {}, 0

    def learn(self, words: list[bytes]) -> None:
        packed, starts = forms(words)
        ratio, known = looked_up(self.model.grams, self.model.ratios, packed)
        rest = ~known
        ratio[rest] = looked_up(self.model.contexts, self.model.backoffs,
                                packed[rest] >> np.uint64(8))[0]
        self.known.update(zip(words, np.add.reduceat(ratio, starts).tolist()))
        self.size += sum(map(len, words))

    def features(self, texts: list[str | None]) -> np.ndarray:
        out = np.zeros((len(texts), 4))
        out[:, 0] = 1.0
        for rows, lists in chunks(texts):
            new = set().union(*lists).difference(self.known)
            if self.size > CACHE:
                self.known.clear()
                self.size, new = 0, set().union(*lists)
            if new:
                self.learn(list(new))
            for row, own in zip(rows, lists):
                if own:
                    r = np.fromiter(map(self.known.__getitem__, own), np.float64, len(own))
                    n = min(PASSAGE, len(r))
                    sums = np.concatenate([[0.0], np.cumsum(r)])
                    best = (sums[n:] - sums[:-n]).max() / PASSAGE
                    out[row, 1:] = r.mean(), best, math.log(len(r))
        return out

    def scores(self, texts: list[str | None]) -> np.ndarray:
        z = self.features(texts) @ np.array(self.model.weights)
        return 1.0 / (1.0 + np.exp(-np.clip(z, -30.0, 30.0)))


def chunks(texts: list[str | None]):
    """Rows and their words, some megabytes of text at a time."""
    rows, lists, size = [], [], 0
    for row, text in enumerate(texts):
        rows.append(row)
        lists.append(tokens(text))
        size += len(text or "")
        if size > CHUNK:
            yield rows, lists
            rows, lists, size = [], [], 0
    if rows:
        yield rows, lists


def counted(docs: DataFrame) -> DataFrame:
    """gram, cell (part and class) and n: the places in distinct words of documents, summed."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        seen = defaultdict(Counter)
        for text, cell in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            seen[cell].update(set(tokens(text)))
        grams, cells, sums = [np.empty(0, np.int64)], [np.empty(0, np.int32)], [np.empty(0, np.int64)]
        for cell, words in seen.items():
            if words:
                packed, starts = forms(list(words))
                times = np.repeat(list(words.values()), np.diff(np.append(starts, len(packed))))
                keys, at = np.unique(packed, return_inverse=True)
                grams.append(keys.astype(np.int64))
                cells.append(np.full(len(keys), cell, np.int32))
                sums.append(np.bincount(at, times).astype(np.int64))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (grams, cells, sums)],
                                          names=["gram", "cell", "n"])

    return by_batch(docs, run, "gram long, cell int, n long")


def discount(n: np.ndarray) -> float:
    ones, twos = (n == 1).sum(), (n == 2).sum()
    return float(ones / (ones + 2 * twos)) if ones else 0.5


def by_context(grams: np.ndarray, *columns: np.ndarray):
    """Contexts, each form's place among them, and sums of the columns per context."""
    contexts, at = np.unique(grams >> np.uint64(8), return_inverse=True)
    return contexts, at, [np.bincount(at, c, len(contexts)) for c in columns]


def ratios(grams: np.ndarray, counts: np.ndarray):
    """Log ratios of the two models for each form, and of the backoff weights of each context.
    `counts`: one row per class."""
    seen = counts.sum(axis=0) > 0
    grams, counts = grams[seen], counts[:, seen]
    # continuation counts, shared by the classes: in how many distinct forms one order up
    levels, keys = [], grams
    for order in range(ORDER - 1, 0, -1):
        keys, n = np.unique(keys & np.uint64((1 << 8 * order) - 1), return_counts=True)
        levels.append((order, keys, n))
    below = None
    for order, keys, n in reversed(levels):
        d = discount(n)
        _, at, (total, kinds) = by_context(keys, n, np.ones(len(n)))
        if below is None:
            base = np.full(len(keys), 1 / 256)
        else:
            base = below[1][np.searchsorted(below[0], keys & np.uint64((1 << 8 * (order - 1)) - 1))]
        below = keys, (np.maximum(n - d, 0) + d * kinds[at] * base) / total[at]
    base = below[1][np.searchsorted(below[0], grams & np.uint64((1 << 8 * (ORDER - 1)) - 1))]
    chance, weight = [], []
    for n in counts:
        d = discount(n)
        contexts, at, (total, kinds) = by_context(grams, n, n > 0)
        w = np.where(total > 0, d * kinds / np.maximum(total, 1), 1.0)
        own = np.maximum(n - d, 0) / np.maximum(total[at], 1)
        weight.append(w)
        chance.append(np.where(n > 0, own, 0.0) + w[at] * base)
    return grams, np.log(chance[1] / chance[0]), contexts, np.log(weight[1] / weight[0])


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted logistic regression with a small ridge, by Newton's method."""
    b = np.zeros(x.shape[1])
    ridge = np.diag([1e-6] + [1e-2] * (x.shape[1] - 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve(
            (x * (weight * p * (1 - p))[:, None]).T @ x + ridge,
            x.T @ (weight * (y - p)) - ridge @ b)
        b += step * min(1.0, 5.0 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return b


def labelled(docs: DataFrame, labels: DataFrame, per_class: int) -> tuple[DataFrame, list[int]]:
    """text and cell (part and class) of a bounded sample of training documents; labels per
    class."""
    known = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(
        (F.max("toxic") > 0).cast("int").alias("toxic"))
    known = known.where(fold("doc_id", FOLDS) != HELD_OUT)
    counts = dict(known.groupBy("toxic").count().collect())
    h = F.md5(F.col("doc_id").cast("string").cast("binary"))
    parts = [known.where(F.col("toxic") == c).orderBy(h, "doc_id").limit(per_class)
             for c in (0, 1)]
    cell = F.crc32(h.cast("binary")) % PARTS * 2 + F.col("toxic")
    sample = parts[0].union(parts[1]).select("doc_id", cell.cast("int").alias("cell"))
    texts = docs.select("doc_id", "text").where("text is not null")
    # at most 2 * per_class rows of two numbers
    found = texts.join(F.broadcast(sample), "doc_id").select("text", "cell")
    return found, [counts.get(0, 0), counts.get(1, 0)]


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model | None:
    """The model; None without labelled documents of both classes."""
    sample, totals = labelled(docs, labels, per_class)
    if not all(totals):
        return None
    sample = cut_lineage(sample)
    # as many rows as the bounded sample has forms
    table = counted(sample).groupBy("gram", "cell").agg(F.sum("n").alias("n")).toArrow()
    gram, cell, n = (table.column(c).to_numpy() for c in ("gram", "cell", "n"))
    keys, at = np.unique(gram.astype(np.uint64), return_inverse=True)
    if not len(keys):
        return None
    counts = np.zeros((PARTS, 2, len(keys)))
    counts[cell // 2, cell % 2, at] = n
    del table, gram, cell, n, at
    models = [Model(*ratios(keys, counts.sum(axis=0) - counts[p]), []) for p in range(PARTS)]
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def run(batches):
        scorers = [Scorer(m) for m in shared.value]
        for batch in slices(batches, 0):
            texts, cells = batch.column(0).to_pylist(), np.array(batch.column(1))
            x = np.zeros((len(texts), 4))
            for p, scorer in enumerate(scorers):
                own = np.flatnonzero(cells // 2 == p)
                x[own] = scorer.features([texts[i] for i in own])
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(x), pa.list_(pa.float64())), pa.array(cells % 2)], names=["x", "y"])

    rows = sample.mapInArrow(run, "x array<double>, y int").toArrow()
    shared.destroy()
    model = Model(*ratios(keys, counts.sum(axis=0)), [-2.0, 0.0, 2.0, 0.0])
    y = rows.column("y").to_numpy().astype(float)
    if 0 < y.sum() < len(y):
        share = [totals[c] / (y == c).sum() for c in (0, 1)]
        weight = np.where(y == 1, share[1], share[0])
        model.weights = logistic(np.array(rows.column("x").to_pylist()), y, weight * len(y) / weight.sum()).tolist()
    return model


def scores(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, per_class))
    scorers: list[Scorer] = []

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not scorers and shared.value is not None:
            scorers.append(Scorer(shared.value))
        texts = batch.column(2).to_pylist()
        score = scorers[0].scores(texts) if scorers else np.zeros(len(texts))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(score),
             pa.array((score >= THRESHOLD).astype(np.int32))],
            names=["doc_id", "held_out", "score", "predicted"])

    rows = docs.select("doc_id", (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "text")
    return by_batch(rows, run, "doc_id long, held_out boolean, score double, predicted int")


def without_toxic(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """The documents that are not predicted toxic, with all their columns."""
    model = train(docs, labels, per_class)
    if model is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches):
        scorer = Scorer(shared.value)
        for batch in slices(batches, at):
            keep = scorer.scores(batch.column(at).to_pylist()) < THRESHOLD
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
