"""Language identification with string kernels.

The blended-spectrum presence kernel of two texts is the number of character n-grams (n = 1 to ``LONGEST``) that both hold,
over the geometric mean of the numbers each holds.  A kernel ridge regression of one language against the rest is
solved in the Nystroem approximation: a text is described by its kernel with ``LANDMARKS`` texts, so the normal equations have
that many unknowns whatever the sample.  n-grams are kept as ``BITS``-bit hashes, a text as the sorted list of those it holds, and the
kernel of a batch with the landmarks, and with that the score, is one product of a sparse matrix and a dense one.

As the kernel is linear in the presence bits, the landmarks' bits are multiplied by the regression weights once, when a model
is fitted; scoring a batch is then its bits times that matrix, with the same result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .textkit import checkpointed, least_hashed, released
from .toxicity import remainder

LONGEST = 4
BITS = 18
LANDMARKS = 256
#: Labelled documents a model is fitted on at most, those of least hash.
SAMPLE = 2000
#: Documents of each language that are learned besides, where the language has them.
EACH = 20
RIDGE = 1e-3
BATCH = 64
LETTER = re.compile(r"[^\W\d_]")
UNKNOWN = "und"


_HELD = np.zeros(1 << BITS, bool)


def presence(text: str | None, longest: int = LONGEST) -> np.ndarray:
    """The n-grams of a whole text, case folded, as distinct hashes in order."""
    chars = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    code, held = np.zeros(len(chars), np.uint32), _HELD
    for n in range(1, min(longest, len(chars)) + 1):
        code = code[: len(chars) - n + 1] * np.uint32(0x01000193) + chars[n - 1 :]
        mixed = (code ^ np.uint32(n * 0x9E3779B9 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
        mixed ^= mixed >> np.uint32(15)
        held[(mixed * np.uint32(0xC2B2AE35)) >> np.uint32(32 - BITS)] = True
    found = np.flatnonzero(held)
    held[found] = False
    return found


def product(rows: list[np.ndarray], matrix: np.ndarray) -> np.ndarray:
    """The rows' presence bits, scaled to length one, times a dense matrix; a row without bits gives zeros."""
    out = np.zeros((len(rows), matrix.shape[1]))
    full = [i for i, row in enumerate(rows) if len(row)]
    if full:
        sizes = np.array([len(rows[i]) for i in full])
        sums = np.add.reduceat(matrix[np.concatenate([rows[i] for i in full])], np.concatenate([[0], np.cumsum(sizes)[:-1]]), axis=0, dtype=float)
        out[full] = sums / np.sqrt(sizes)[:, None]
    return out


def _shared(rows: list[np.ndarray], marks: list[np.ndarray]) -> np.ndarray:
    """How many n-grams each row shares with each landmark, by the list of landmarks that hold an n-gram."""
    grams, holder = np.concatenate(marks), np.repeat(np.arange(len(marks)), [len(m) for m in marks])
    order = np.argsort(grams, kind="stable")
    holder, limits = holder[order].astype(np.int32), np.searchsorted(grams[order], np.arange((1 << BITS) + 1))
    out = np.zeros((len(rows), len(marks)))
    for k, row in enumerate(rows):
        first, n = limits[row], limits[row + 1] - limits[row]
        ends = np.cumsum(n)
        if len(row) and ends[-1]:
            places = np.arange(ends[-1]) + np.repeat(first - ends + n, n)
            out[k] = np.bincount(holder[places], minlength=len(marks))
    return out


class Model:
    def __init__(self, languages: list[str], weights: np.ndarray):
        self.languages, self.weights = languages, weights

    @classmethod
    def fit(cls, texts: list[str], languages: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
        """One-versus-rest kernel ridge regression; without labelled texts the only class is ``und``."""
        names = sorted(set(languages))
        if not names:
            return cls([UNKNOWN], np.zeros((1 << BITS, 1), np.float32))
        rows = list(map(presence, texts))
        # landmarks: the languages in turn, each in the order of the sample
        turn, seen = [], dict.fromkeys(names, 0)
        for name in languages:
            turn.append(seen[name])
            seen[name] += 1
        chosen = np.lexsort((np.arange(len(texts)), turn))[:landmarks]
        length = np.sqrt([max(1, len(rows[row])) for row in chosen])
        shared = _shared(rows, [rows[row] for row in chosen])
        kernel = shared / length / np.sqrt([max(1, len(row)) for row in rows])[:, None]
        own = kernel[chosen]
        target = np.where(np.array(languages)[:, None] == np.array(names)[None], 1.0, -1.0)
        # a class counts as much as any other
        share = np.array([1 / (len(names) * seen[name]) for name in languages])[:, None]
        solved = np.linalg.solve(kernel.T @ (share * kernel) + ridge * own / len(names) + 1e-9 * np.eye(len(chosen)), kernel.T @ (share * target))
        weights = np.zeros((1 << BITS, len(names)), np.float32)
        for k, row in enumerate(chosen):
            weights[rows[row]] += solved[k] / length[k]
        return cls(names, weights)

    def margins(self, texts: list[str | None]) -> np.ndarray:
        return product(list(map(presence, texts)), self.weights)

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Languages and scores; of equal margins the first language by code point wins."""
        margins = self.margins(texts)
        odds = np.exp(4.0 * (margins - margins.max(axis=1, keepdims=True)))
        best = margins.argmax(axis=1)
        sure = odds[np.arange(len(texts)), best] / odds.sum(axis=1)
        named = [self.languages[b] if t and LETTER.search(t) else UNKNOWN for b, t in zip(best, texts, strict=True)]
        return named, np.where([n == UNKNOWN for n in named], 0.0, sure).astype(float)


def _of_each(usable: DataFrame, most: int = EACH) -> DataFrame:
    """``(doc_id)``: those of least hash of each language, at most ``most``."""
    pairs = checkpointed(usable.select("lang", "doc_id", F.xxhash64("doc_id").alias("hash")).distinct())
    sizes = pairs.groupBy("lang").agg(F.count("*").alias("n"))
    # a few times as many as wanted are below the limit, so no window holds a whole language
    limit = F.lit(float(-(2**63))) + float(2**64) * F.least(F.lit(1.0), 4.0 * most / F.col("n"))
    low = pairs.join(F.broadcast(sizes), "lang").where(F.col("hash").cast("double") <= limit)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("hash", "doc_id"))
    return low.withColumn("rank", rank).where(F.col("rank") <= most).select("doc_id")


def train(docs: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """A model from rows with a language whose remainder by 4 isn't 2: the ``sample`` of least hash, and the ``EACH`` of least hash of
    every language, so that a rare one is learned too.  The languages are taken to be few (``EACH`` rows each reach the driver).

    Rows without id, text or language, and those without a letter, are not used.
    """
    usable = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    learn = (F.col("lang").isNotNull()) & F.col("doc_id").isNotNull() & (remainder("doc_id", 4) != 2)
    # ids first: the sort then carries no texts
    chosen = least_hashed(usable.where(learn).select("doc_id").distinct(), "doc_id", sample)
    chosen = chosen.union(_of_each(usable.where(learn & F.col("text").rlike(r"\p{L}")))).distinct()
    # one text an id, the least with a letter
    wanted = usable.where(learn & F.col("text").rlike(r"\p{L}")).join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min(F.struct("text", "lang")).alias("r"))
    table = [r for r in sorted(wanted.select("doc_id", "r.*").collect(), key=lambda r: r.doc_id) if LETTER.search(r.text)]
    return Model.fit([r.text for r in table], [r.lang for r in table])


def identify(docs: DataFrame, model: Model | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` for each row of ``docs``.

    An empty table gives an empty one; without any language to learn all are ``und``.  A null text, or one without a letter, is ``und`` with score 0.  Repeated rows give repeated results; a null id is kept
    and counts as not held out.  Languages of the model come from its labels, never from the row predicted.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model or train(docs, id_col=id_col, text_col=text_col, lang_col=lang_col))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            for at in range(0, len(batch), BATCH):
                part = batch.slice(at, BATCH)
                names, sure = sent.value.predict([t.as_py() for t in part.column(1)])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names, pa.string()), pa.array(sure, pa.float64())], ["doc_id", "lang_pred", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    found = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(work, f"doc_id {kind}, lang_pred string, score double")
    return found.select("doc_id", F.coalesce(remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")
