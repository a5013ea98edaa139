"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Features of a whole text are rates a word: densities of a learned lexicon and of its strongest part, how near its words
stand to a second person, capitals, exclamation marks, repeated punctuation, and words that hide letters behind digits
or symbols.  The lexicon, the trees and the calibration are fitted on the driver from a bounded sample of labelled
documents (``SAMPLE``); scoring runs where the texts are.
"""

from __future__ import annotations

import json
import re
import sys
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .textkit import least_hashed, released

#: Labelled documents a model is fitted on at most: those of least hash, so that the choice doesn't depend on order.
SAMPLE = 6000
#: Words of a sampled document that the lexicon counts once each; the lexicon keeps at most ``LEXICON`` of them.
LEXICON = 200
TREES, DEPTH, RATE, BINS = 60, 3, 0.15, 32

TOKEN = re.compile(r"[^\W_]+(?:['*@$!#0-9]+[^\W_]+)*")
#: Second-person forms of the languages at hand.  Fixed values.
SECOND = frozenset("you your yours yourself u ur du dich dir dein deine ihr euch euer tu te toi ton ta tes vous votre vos usted ustedes tú ti vosotros vuestro".split())
#: Stand-ins of letters.  Fixed values.
STAND_INS = str.maketrans("013457@$!*", "oieastasi.")
FEATURES = ("lexicon", "strong", "lexicon_kinds", "any_lexicon", "near_second", "second", "capitals", "exclaims", "repeats", "questions", "obfuscated", "hidden_lexicon", "log_words")
NEAR = 4


def words(text: str) -> list[str]:
    return TOKEN.findall(text)


class Reading:
    """What the features of a text need, whatever the lexicon: its words, and what is counted without one."""

    def __init__(self, text: str | None, kept: bool = False):
        """``kept``: the reading stays in memory with others, so that equal words should be one object."""
        text = text or ""
        self.words = words(text.lower())
        if kept:
            self.words = list(map(sys.intern, self.words))
        self.second = {i for i, w in enumerate(self.words) if w in SECOND}
        mixed = [w for w in self.words if not w.isalpha() and not w.isdigit()]
        self.hidden = [w.translate(STAND_INS) for w in mixed]
        n, chars = max(1, len(self.words)), max(1, len(text))
        capitals = sum(map(str.isupper, text)) / chars if not text.islower() else 0.0
        self.rates = [len(self.second) / n, capitals, text.count("!") / n, text.count("!!") / n, text.count("?") / n, len(mixed) / n]

    def features(self, lexicon: dict[str, float]) -> list[float]:
        n = max(1, len(self.words))
        hits = [i for i, w in enumerate(self.words) if w in lexicon]
        strong = sum(lexicon[self.words[i]] > 2 for i in hits)
        near = sum(not self.second.isdisjoint(range(i - NEAR, i + NEAR + 1)) for i in hits)
        kinds = len({self.words[i] for i in hits})
        hidden = sum(w in lexicon for w in self.hidden)
        return [len(hits) / n, strong / n, float(kinds), float(bool(hits)), near / n, *self.rates, hidden / n, float(np.log1p(len(self.words)))]


def features(text: str | None, lexicon: dict[str, float]) -> list[float]:
    """The dense features of a whole text; zeros where it is null or empty."""
    return Reading(text).features(lexicon)


def learn_lexicon(readings: list[Reading], labels: np.ndarray, size: int = LEXICON) -> dict[str, float]:
    """Words that mark positive documents, with their log odds (add-one smoothed) over documents; of equal ones those first by code point."""
    with_word: tuple[Counter, Counter] = (Counter(), Counter())
    for reading, label in zip(readings, labels, strict=True):
        with_word[int(label)].update(set(reading.words))
    n1, n0 = int(labels.sum()), int(len(labels) - labels.sum())
    scored = {}
    for word, n in with_word[1].items():
        if n < 5:
            continue
        p1, p0 = (n + 0.5) / (n1 + 1), (with_word[0][word] + 0.5) / (n0 + 1)
        # how far apart the two rates are in standard errors; chance alone does not reach it among many words
        gap = (p1 - p0) / np.sqrt(p1 * (1 - p1) / (n1 + 1) + p0 * (1 - p0) / (n0 + 1))
        if gap > 3.5 and p1 > 3 * p0:
            scored[word] = float(np.log(p1 / p0))
    return dict(sorted(scored.items(), key=lambda x: (-x[1], x[0]))[:size])


class Trees:
    """Gradient-boosted regression trees for log-loss over binned features."""

    def __init__(self, edges: list[np.ndarray], prior: float, trees: list[dict]):
        self.edges, self.prior, self.trees = edges, prior, trees

    @staticmethod
    def _bins(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k], "left") for k, e in enumerate(edges)], axis=1)

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE, bins: int = BINS, least: float = 5.0) -> Trees:
        edges = []
        for k in range(x.shape[1]):
            values = np.unique(x[:, k])
            if len(values) > bins:
                values = np.unique(np.concatenate([values[:1], np.quantile(x[:, k], np.linspace(0, 1, bins + 1)[1:-1]), np.quantile(values, np.linspace(0, 1, bins // 2 + 1)[1:-1])]))
            edges.append((values[:-1] + values[1:]) / 2 if len(values) <= bins else values)
        b = cls._bins(x, edges)
        rates = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        model = cls(edges, float(np.log(rates / (1 - rates))), [])
        margin = np.full(len(y), model.prior)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-margin))
            grad, hess = y - p, p * (1 - p)
            tree = cls._grow(b, grad, hess, np.arange(len(y)), depth, rate, least)
            model.trees.append(tree)
            margin += model._leaf(tree, b)
        return model

    @classmethod
    def _grow(cls, b: np.ndarray, grad: np.ndarray, hess: np.ndarray, rows: np.ndarray, depth: int, rate: float, least: float) -> dict:
        g, h = grad[rows].sum(), hess[rows].sum()
        best = (1e-6, -1, -1)
        if depth:
            for k in range(b.shape[1]):
                left_g, left_h, left_n = (np.cumsum(np.bincount(b[rows, k], w))[:-1] for w in (grad[rows], hess[rows], np.ones(len(rows))))
                if not len(left_g):
                    continue
                ok = (left_n >= least) & (len(rows) - left_n >= least)
                gain = np.where(ok, left_g**2 / (left_h + 1) + (g - left_g) ** 2 / (h - left_h + 1) - g**2 / (h + 1), -1)
                at = int(gain.argmax())
                if gain[at] > best[0]:
                    best = (float(gain[at]), k, at)
        if best[1] < 0:
            return {"value": float(rate * g / (h + 1))}
        _, k, at = best
        under = b[rows, k] <= at
        return {"feature": k, "bin": at, "low": cls._grow(b, grad, hess, rows[under], depth - 1, rate, least), "high": cls._grow(b, grad, hess, rows[~under], depth - 1, rate, least)}

    def _leaf(self, tree: dict, b: np.ndarray) -> np.ndarray:
        if "value" in tree:
            return np.full(len(b), tree["value"])
        return np.where(b[:, tree["feature"]] <= tree["bin"], self._leaf(tree["low"], b), self._leaf(tree["high"], b))

    def margin(self, x: np.ndarray) -> np.ndarray:
        b = self._bins(x, self.edges)
        return self.prior + sum((self._leaf(t, b) for t in self.trees), np.zeros(len(x)))


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least-squares non-decreasing step function of y on x (pool adjacent violators): knots and values."""
    order = np.argsort(x, kind="stable")
    blocks: list[list[float]] = []
    for at, value in zip(x[order].tolist(), y[order].tolist(), strict=True):
        blocks.append([value, 1.0, at, at])
        while len(blocks) > 1 and (blocks[-2][0] >= blocks[-1][0] or blocks[-2][3] == blocks[-1][2]):
            v, w, _, last = blocks.pop()
            b = blocks[-1]
            b[0], b[1], b[3] = (b[0] * b[1] + v * w) / (b[1] + w), b[1] + w, last
    knots = np.array([p for b in blocks for p in (b[2], b[3])])
    return knots, np.array([v for b in blocks for v in (b[0], b[0])])


class Model:
    """Lexicon, trees and calibration of one task."""

    def __init__(self, lexicon: dict[str, float], trees: Trees | None, knots: np.ndarray, values: np.ndarray, constant: float = 0.0):
        self.lexicon, self.trees, self.knots, self.values, self.constant = lexicon, trees, knots, values, constant

    @classmethod
    def fit(cls, texts: list[str], labels: np.ndarray) -> Model:
        """With fewer than 20 labels, or labels of one kind, the score is their smoothed mean (a quarter without any)."""
        labels = np.asarray(labels, float)
        if len(labels) < 20 or labels.min() == labels.max():
            return cls({}, None, np.zeros(0), np.zeros(0), float((labels.sum() + 1) / (len(labels) + 4)))
        readings = [Reading(t, kept=True) for t in texts]
        table = lambda lexicon: np.array([r.features(lexicon) for r in readings])
        # calibration is fitted on margins of documents that the trees haven't seen
        fold = np.arange(len(labels)) % 3
        margins = np.zeros(len(labels))
        for k in range(3):
            rest = fold != k
            x = table(learn_lexicon([t for t, r in zip(readings, rest, strict=True) if r], labels[rest]))
            margins[~rest] = Trees.fit(x[rest], labels[rest]).margin(x[~rest])
        knots, values = isotonic(margins, labels)
        lexicon = learn_lexicon(readings, labels)
        return cls(lexicon, Trees.fit(table(lexicon), labels), knots, values)

    def score(self, texts: list[str | None]) -> np.ndarray:
        if not self.trees or not texts:
            return np.full(len(texts), self.constant)
        margin = self.trees.margin(np.array([features(t, self.lexicon) for t in texts]))
        return np.clip(np.interp(margin, self.knots, self.values), 0.0, 1.0)

    def dumps(self) -> str:
        return json.dumps({"lexicon": self.lexicon, "edges": [e.tolist() for e in self.trees.edges] if self.trees else None, "prior": self.trees.prior if self.trees else 0.0, "trees": self.trees.trees if self.trees else [], "knots": self.knots.tolist(), "values": self.values.tolist(), "constant": self.constant})


def remainder(id_column: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null ids have none."""
    return F.crc32(F.col(id_column).cast("string")) % parts


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """A model from labelled rows whose remainder by 5 isn't 0; at most ``sample`` of them, those of least hash.

    Rows without id, label or text are not used; of repeated labels of an id the largest counts.
    """
    usable = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & (remainder(id_col, 5) != 0))
    once = usable.groupBy(F.col(id_col).alias("doc_id")).agg(F.max(F.col(label_col).cast("int")).alias("label"))
    chosen = least_hashed(once, "doc_id", sample)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("text IS NOT NULL")
    # one text an id, the least, so that the sample's bound is also that of the rows that come to the driver
    rows = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    table = sorted(rows.collect(), key=lambda r: r.doc_id)
    return Model.fit([r.text for r in table], np.array([r.label for r in table], float))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, score)`` for each row of ``docs``; null texts score as empty ones."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            for at in range(0, len(batch), 512):
                part = batch.slice(at, 512)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sent.value.score([t.as_py() for t in part.column(1)]), pa.float64())], ["doc_id", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(work, f"doc_id {kind}, score double")


def predict(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for each row of ``docs``, repeated rows and null ids included.

    Empty documents give an empty table; without labels every score is a quarter.  Of equal splits the first feature's first wins.
    """
    scored = score(docs, train(docs, labels, id_col=id_col, text_col=text_col), id_col, text_col)
    return scored.select("doc_id", F.coalesce(remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with all their columns and no shuffle."""
    sent = docs.sparkSession.sparkContext.broadcast(train(docs, labels, id_col=id_col, text_col=text_col))
    place = docs.columns.index(text_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            for at in range(0, len(batch), 512):
                part = batch.slice(at, 512)
                keep = sent.value.score([t.as_py() for t in part.column(place)]) < threshold
                yield part.filter(pa.array(keep))

    return docs.mapInArrow(work, docs.schema)
