"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document.  The ledger keeps the measurements and one long whose bit k says that rule k
failed; a policy is a versioned mask over those bits, so changing a policy, or asking what a policy would lose without
one of its rules, is bitwise arithmetic over the ledger and reads no text again.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .textkit import Chunk, chunks, released

WINDOW = 8
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


@dataclass(frozen=True)
class Rule:
    name: str
    bit: int
    #: SQL over the measurements: true where the document fails.
    fails: str


RULES = (
    Rule("too_few_words", 0, "n_words < 20"),
    Rule("repeated_windows", 1, "100 * n_repeat_words > 30 * n_words"),
    Rule("symbol_heavy", 2, "10 * n_symbols > n_words"),
    Rule("short_words", 3, "word_chars < 2 * n_words"),
    Rule("long_words", 4, "word_chars > 15 * n_words"),
    Rule("repeated_lines", 5, "10 * n_dup_lines > 3 * n_lines"),
)
BIT = {r.name: 1 << r.bit for r in RULES}
BASE = BIT["too_few_words"] | BIT["repeated_windows"]
#: A document is rejected by a policy when a rule of its mask failed.  Versions are never edited, only added.
POLICIES = {
    "base-1": BASE,
    "web-1": BASE | BIT["symbol_heavy"] | BIT["short_words"] | BIT["long_words"] | BIT["repeated_lines"],
}
CURRENT = "web-1"


def _twice(doc: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A stable order by document and hash; which items there have an equal neighbour; which follow their equal."""
    order = np.lexsort((hashes, doc))
    same = np.zeros(len(order) + 1, bool)
    if len(order) > 1:
        same[1:-1] = (hashes[order][1:] == hashes[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    return order, same[:-1] | same[1:], same[:-1]


def measure(chunk: Chunk, window: int = WINDOW) -> dict[str, np.ndarray]:
    """The measurements of each document of a chunk."""
    n_words = np.diff(chunk.first)
    letters = chunk.word & ((chunk.data & 0xC0) != 0x80)
    doc = chunk.doc
    covered = np.zeros(len(chunk.starts) + 1, np.int64)
    if (whole := chunk.whole(window)).any():
        at = np.flatnonzero(whole)
        order, twice, _ = _twice(doc[at], chunk.gram_hashes(chunk.word_hashes(), window)[at])
        begin = at[order[twice]]
        np.add.at(covered, begin, 1)
        np.subtract.at(covered, begin + window, 1)
    repeated = np.cumsum(covered[:-1]) > 0
    breaks = np.flatnonzero(chunk.data == 10)
    starts = np.concatenate([chunk.at[:-1], breaks + 1])
    ends = np.sort(np.concatenate([chunk.at[1:], breaks]))
    starts = np.sort(starts)
    with_word = np.searchsorted(chunk.starts, starts) < np.searchsorted(chunk.starts, ends)
    starts, ends = starts[with_word], ends[with_word]
    line_doc = np.searchsorted(chunk.at, starts, "right") - 1
    order, _, later = _twice(line_doc, chunk.hash_spans(starts, ends))
    size = len(chunk)
    return {
        "n_words": n_words,
        "word_chars": chunk.per_doc_bytes(letters),
        "n_symbols": chunk.per_doc_bytes(_SYMBOL[chunk.data]),
        "n_dup_lines": np.bincount(line_doc[order[later]], minlength=size),
        "n_repeat_words": chunk.per_doc(repeated),
        "n_lines": np.bincount(line_doc, minlength=size),
    }


def measurements(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and the measurements (long) of each row's whole text; a null text is an empty one."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            for chunk in chunks(batch.column(1)):
                found = measure(chunk)
                ids = batch.column(0).slice(chunk.row, len(chunk))
                yield pa.RecordBatch.from_arrays([ids, *[pa.array(found[m].astype(np.int64)) for m in MEASURES]], ["doc_id", *MEASURES])

    kind = docs.schema[id_col].dataType.simpleString()
    columns = ", ".join(f"{m} long" for m in MEASURES)
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(work, f"doc_id {kind}, {columns}")


def failure_bits(rules: tuple[Rule, ...] = RULES) -> Column:
    bits = F.lit(0).cast("long")
    for rule in rules:
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << rule.bit).cast("long")).otherwise(F.lit(0).cast("long")))
    return bits


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: id, measurements and ``failed`` (bit k: rule k of ``RULES`` failed).

    Null and empty texts measure zero and fail ``too_few_words``; repeated rows give repeated rows; a null id is kept.
    """
    return measurements(docs, id_col, text_col).withColumn("failed", failure_bits())


def rejected(policy: str | int, failed: str = "failed") -> Column:
    mask = POLICIES[policy] if isinstance(policy, str) else policy
    return F.col(failed).bitwiseAND(F.lit(mask).cast("long")) != 0


def verdicts(book: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The ledger with ``base_failed`` and ``kept`` under a policy; what fails the base is never kept."""
    return book.withColumn("base_failed", rejected("base-1")).withColumn("kept", ~rejected(POLICIES[policy] | BASE))


def ablations(book: DataFrame, policy: str = CURRENT) -> DataFrame:
    """For each rule of a policy: documents that fail it, fail only it (what dropping the rule would win back), and its mask.

    The ledger is first counted by its bit pattern, of which there are at most 2**len(RULES).
    """
    mask = POLICIES[policy]
    patterns = book.groupBy(F.col("failed").bitwiseAND(F.lit(mask).cast("long")).alias("failed")).agg(F.count("*").alias("n"))
    rules = [r for r in RULES if mask >> r.bit & 1]
    one = F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("mask")) for r in rules])).alias("r")
    spread = patterns.select("failed", "n", one).select("failed", "n", "r.rule", "r.mask")
    hit = F.col("failed").bitwiseAND(F.col("mask")) != 0
    return spread.groupBy("rule", "mask").agg(
        F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0)).alias("n_failed"),
        F.coalesce(F.sum(F.when(F.col("failed") == F.col("mask"), F.col("n"))), F.lit(0)).alias("n_only"),
    )


def attach(docs: DataFrame, policy: str = CURRENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids a policy keeps, for a semi-join with ``docs``."""
    return verdicts(ledger(docs, id_col, text_col), policy).where("kept").select(F.col("doc_id").alias(id_col)).distinct()
