"""Substring dedup with suffix automata of reference shards.

Which words go: every word of a window of ``WINDOW`` words whose sequence also starts earlier (smaller id, or earlier in
the same document).  The rest follows from three facts.

* Two equal windows have the same minimiser: the leftmost ``ANCHOR``-gram of least hash in them, at the same offset.  So
  the windows of a document fall into runs with one anchor each, and only runs whose anchor occurs twice or more in the
  corpus can hold a repeated window.  Anchors are counted with map-side combining and joined back.
* Runs with equal word sequences (the anchor's context, at most ``2 * WINDOW - ANCHOR`` words) are collapsed to their
  first occurrence by another aggregation; any later one is removed whole.  Only anchors with several different
  contexts need a comparison.
* These contexts are the reference.  They are dealt by anchor to shards of bounded size; each shard is
  one suffix automaton over word symbols, in which every state knows the earliest place where its words end.  A shard's
  own contexts are streamed through it: the matching statistic at a word is the longest suffix read so far that the
  reference contains, and where it reaches the window length, the state for exactly that length tells whether
  the window starts earlier.

Automata are built where their shard's rows arrive instead of being broadcast to all documents: a document meets only
the shards that can match it, so the work is in proportion to the text and not to documents times shards.  An anchor with
more than ``HOT`` different contexts is a shard a window instead: equal windows collapse by aggregation alone, so that no
task holds an unbounded group.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textkit import Chunk, checkpointed, chunks, document_keys, mix, released, with_ids

WINDOW = 20
ANCHOR = 6
HOT = 2048
SHARD_WORDS = 200_000


class SuffixAutomaton:
    """All factors of some sequences of symbols, with the least place at which each ends.

    A place is a number that grows with the document and the position; see ``place``.
    """

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.place = [-1], [0], [0]

    def add(self, symbols: list[int], before: int) -> None:
        """Add a sequence whose first symbol ends at the place after ``before``."""
        last = 0
        for end, symbol in enumerate(symbols, before + 1):
            last = self._step(last, symbol, end)

    def _state(self, following: dict[int, int], link: int, length: int, place) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        self.place.append(place)
        return len(self.next) - 1

    def _step(self, last: int, symbol: int, place) -> int:
        following, link, length = self.next, self.link, self.length
        old = following[last].get(symbol)
        if old is not None:
            if length[old] == length[last] + 1:
                return old if self.place[old] <= place else self._place(old, place)
            return self._place(self._clone(last, symbol, old), place)
        state = self._state({}, 0, length[last] + 1, place)
        at = last
        while at != -1 and symbol not in following[at]:
            following[at][symbol] = state
            at = link[at]
        if at != -1:
            old = following[at][symbol]
            link[state] = old if length[old] == length[at] + 1 else self._clone(at, symbol, old)
        return state

    def _place(self, state: int, place) -> int:
        self.place[state] = min(self.place[state], place)
        return state

    def _clone(self, at: int, symbol: int, old: int) -> int:
        clone = self._state(dict(self.next[old]), self.link[old], self.length[at] + 1, self.place[old])
        while at != -1 and self.next[at].get(symbol) == old:
            self.next[at][symbol] = clone
            at = self.link[at]
        self.link[old] = clone
        return clone

    def finish(self) -> None:
        """Hand each place down to the suffixes of its state."""
        for state in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            parent = self.link[state]
            if parent > 0 and self.place[state] < self.place[parent]:
                self.place[parent] = self.place[state]

    def statistics(self, symbols: list[int], cut: int) -> Iterator[tuple[int, object]]:
        """At each symbol: the longest matching suffix, no longer than ``cut``, and the least place where it ends."""
        state = size = 0
        for symbol in symbols:
            while state and symbol not in self.next[state]:
                state = self.link[state]
                size = self.length[state]
            if symbol in self.next[state]:
                state = self.next[state][symbol]
                size += 1
            while state and self.length[self.link[state]] >= cut:
                state = self.link[state]
            size = min(size, self.length[state])
            yield min(size, cut), self.place[state]


def _runs(chunk: Chunk, window: int, anchor: int) -> tuple[np.ndarray, ...]:
    """The runs of windows with one anchor: document, first window (word of the document), count, anchor and context hash."""
    words = chunk.word_hashes()
    starts = np.flatnonzero(chunk.whole(window)) if len(words) >= window else np.zeros(0, np.int64)
    if not len(starts):
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    grams = chunk.gram_hashes(words, anchor)
    span = window - anchor + 1
    # the leftmost least gram of each window, by doubling: least of spans of 1, 2, 4, ... and then of two that overlap
    least, where, reach = grams, np.arange(len(grams)), 1
    while 2 * reach <= span:
        left, right = least[:-reach], least[reach:]
        where = np.where(left <= right, where[:-reach], where[reach:])
        least, reach = np.minimum(left, right), 2 * reach
    shift = span - reach
    if shift:
        where = np.where(least[:-shift] <= least[shift:], where[:-shift], where[shift:])
    at = where[starts]
    doc = chunk.doc[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(starts)))
    begin = starts[first]
    # the context: words from the run's first window to the end of its last one; windows overlap, so two hashes pin it
    ends = begin + count - 1
    windows = chunk.gram_hashes(words, window)
    context = mix(windows[begin] ^ mix(windows[ends] + count.astype(np.uint64)))
    return doc[first], begin - chunk.first[doc[first]], count, grams[at[first]], context


def place(key: int, word: int) -> int:
    """Word positions of all documents as one order."""
    return (key << 40) + word


def runs(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """``(anchor, context, key, start, n)`` for each run of windows of ``docs(key, text)``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            keys = batch.column(0)
            for chunk in chunks(batch.column(1)):
                doc, start, count, grams, context = _runs(chunk, window, anchor)
                columns = [pa.array(grams.view(np.int64)), pa.array(context.view(np.int64)), keys.take(pa.array(doc + chunk.row)), pa.array(start.astype(np.int32)), pa.array(count.astype(np.int16))]
                yield pa.RecordBatch.from_arrays(columns, ["anchor", "context", "key", "start", "n"])

    return docs.select("key", "text").mapInArrow(work, "anchor long, context long, key long, start int, n short")


def _words_of(window: int):
    """Rows (key, text, asked) to the words of each asked context; for hot anchors to its windows' hashes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["anchor", "context", "key", "start", "hot", "symbols"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.list_(pa.int64())]
        for batch in released(batches):
            keys, asked = batch.column(0), batch.column(2)
            for chunk in chunks(batch.column(1)):
                words = chunk.word_hashes()
                windows = chunk.gram_hashes(words, window).view(np.int64)
                words = words.view(np.int64)
                out: list[list] = [[] for _ in names]
                for doc in range(len(chunk)):
                    for x in asked[chunk.row + doc].as_py():
                        at, n = int(chunk.first[doc]) + x["start"], x["n"]
                        symbols = windows[at : at + n] if x["hot"] else words[at : at + n + window - 1]
                        for column, value in zip(out, (x["anchor"], x["context"], keys[chunk.row + doc].as_py(), x["start"], x["hot"], symbols), strict=True):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds, strict=True)], names)

    return work


def judge(shard: list[tuple[int, int, int, int, list[int]]], window: int = WINDOW) -> Iterator[tuple[int, int, int]]:
    """``(anchor, context, mask)`` of a shard's ``(anchor, context, key, start, symbols)``: bit i says that window i starts earlier as well."""
    automaton = SuffixAutomaton()
    for _, _, key, start, symbols in shard:
        automaton.add(symbols, place(key, start))
    automaton.finish()
    for anchor, context, key, start, symbols in shard:
        mask, own = 0, place(key, start)
        for end, (size, first) in enumerate(automaton.statistics(symbols, window), 1):
            if size == window and first < own + end:
                mask |= 1 << end - window
        if mask:
            yield anchor, context, mask


def _judged(window: int, shard_words: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in released(batches):
                yield from zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True)

        def out(shard: list) -> pa.RecordBatch:
            found = list(judge(shard, window))
            return pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in range(3)], ["anchor", "context", "mask"])

        shard: list[tuple] = []
        size = 0
        for _, group in groupby(rows(), key=lambda r: r[0]):
            for row in group:
                shard.append(row)
                size += len(row[4])
            if size >= shard_words:
                yield out(shard)
                shard, size = [], 0
        if shard:
            yield out(shard)

    return work


def _cut(window: int):
    """Rows (key, text, hits) to the result: hits are runs with the windows to remove."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            ids, hits = batch.column(0), batch.column(2)
            for chunk in chunks(batch.column(1)):
                cover = np.zeros(len(chunk.starts) + window + 1, np.int32)
                for doc in range(len(chunk)):
                    for hit in hits[chunk.row + doc].as_py() or ():
                        at, mask = int(chunk.first[doc]) + hit["start"], hit["mask"]
                        bit = 0
                        while mask >> bit:
                            if mask >> bit & 1:
                                cover[at + bit] += 1
                                cover[at + bit + window] -= 1
                            bit += 1
                keep = np.cumsum(cover)[: len(chunk.starts)] == 0
                text, starts, ends, first = chunk.spaced(keep)
                n_words = np.diff(chunk.first)
                kept = np.diff(first)
                digests = [hashlib.sha256(text[starts[a] : ends[b - 1]] if b > a else b"").hexdigest() for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([ids.slice(chunk.row, len(chunk)), pa.array(n_words.astype(np.int64)), pa.array((n_words - kept).astype(np.int64)), pa.array(digests, pa.string())], ["key", "n_words", "n_removed", "kept_sha256"])

    return work


def repeated_runs(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, hot: int = HOT, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``(key, start, mask)``: bit i says that the window at word ``start + i`` of the document also starts earlier.

    ``docs(key, text)`` has one row a text; see ``document_keys``.
    """
    found = runs(docs, window, anchor)
    # kept first, so that both sides of the join are plain exchanges and a hot anchor can be split
    often = checkpointed(found.groupBy("anchor").agg(F.count("*").alias("times")).where("times > 1").select("anchor"))
    seen = checkpointed(found.join(often, "anchor"))
    firsts = checkpointed(seen.groupBy("anchor", "context").agg(F.min(F.struct("key", "start")).alias("first"), F.max("n").alias("n")))
    several = firsts.groupBy("anchor").agg(F.count("*").alias("contexts")).where("contexts > 1")
    asked = firsts.join(several, "anchor").select("anchor", "context", F.col("first.key").alias("key"), F.col("first.start").alias("start"), "n", (F.col("contexts") > hot).alias("hot"))
    by_text = asked.groupBy("key").agg(F.collect_list(F.struct("anchor", "context", "start", "n", "hot")).alias("asked"))
    # not kept on disk: the exchange of the texts is the one that ``cut`` reads as well
    words = docs.join(by_text, "key").select("key", "text", "asked").mapInArrow(_words_of(window), "anchor long, context long, key long, start int, hot boolean, symbols array<long>")
    ordinary = words.where("NOT hot").select("anchor", "context", "key", "start", "symbols").repartition("anchor").sortWithinPartitions("anchor", "key", "start")
    masks = ordinary.mapInArrow(_judged(window, shard_words), "anchor long, context long, mask long")
    if not several.where(F.col("contexts") > hot).isEmpty():
        single = words.where("hot").select("anchor", "context", "key", "start", F.posexplode("symbols").alias("i", "window"))
        at = F.struct("key", (F.col("start") + F.col("i")).alias("at"))
        earliest = single.groupBy("anchor", "window").agg(F.min(at).alias("earliest"))
        later = single.join(earliest, ["anchor", "window"]).where(at != F.col("earliest"))
        masks = masks.union(later.groupBy("anchor", "context").agg(F.bit_or(F.expr("shiftleft(1L, i)")).alias("mask")))
    # both sides are plain exchanges of written tables, so a context of many copies can be split; firsts are one a context
    place_of = F.struct("key", "start")
    later_runs = seen.join(firsts.select("anchor", "context", "first"), ["anchor", "context"]).where(F.col("first") != place_of)
    copies = later_runs.select("key", "start", F.expr("shiftleft(1L, CAST(n AS INT)) - 1").alias("mask"))
    own = firsts.join(masks, ["anchor", "context"]).select("first.key", "first.start", "mask").where("mask <> 0")
    return copies.unionByName(own)


def cut(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, anchor: int = ANCHOR, hot: int = HOT, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256)``, one row for each row of ``docs``.

    An empty table gives an empty one.  Null and empty texts have no words and the digest of an empty string.  Rows that repeat both id and text count as one
    document and get equal results; an id that comes with several texts, or a null id, names several documents, ordered by
    a hash of the text.  Other columns of ``docs`` are not read.  Any window length to 63 more than an anchor's works.
    """
    keyed, ids = document_keys(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    hits = repeated_runs(keyed, window, anchor, hot, shard_words).groupBy("key").agg(F.collect_list(F.struct("start", "mask")).alias("hits"))
    found = keyed.join(hits, "key", "left").select("key", "text", "hits").mapInArrow(_cut(window), "key long, n_words long, n_removed long, kept_sha256 string")
    return with_ids(found, ids, docs.schema[id_col].dataType.simpleString())
