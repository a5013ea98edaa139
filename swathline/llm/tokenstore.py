"""Token ids in Parquet list columns.

Documents are dealt by ranges of their ids and sorted, encoded, and written with Spark's Parquet writer: one row a
document, its ids a list column in dictionary encoding (a page whose dictionary grows too large falls back to delta
encoding), with fixed row groups and pages and their column and page indexes.  Readers of counts or positions touch no token
page, and a filter on ids reads only the pages that hold them.

A file row knows its part and the ids before it within the part; the parts' totals, one number a task, give the global
position.

Byte-level BPE works on pre-tokens, and no pre-token spans the place where other text meets white space, or where an ASCII
letter or digit meets ASCII punctuation.  Texts are cut there, each distinct piece of a batch is looked up once, and only pieces
that are not remembered reach the tokenizer, many in one text; all else is Arrow and numpy on whole columns.
"""

from __future__ import annotations

import base64
import functools
import os
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .textkit import released, shared_folder, text_buffers

END_ID = 0
ROW_GROUP = 16 << 20
PAGE = 256 << 10
#: Bytes of text encoded together (a longer document is encoded by itself).
SLICE = 4 << 20
#: Pieces a worker remembers, the first it meets, and the bytes of the longest one.
REMEMBERED, LONGEST = 400_000, 64
#: Where more than this share of a slice's pieces is new, the texts have changed and the memory starts anew.
FORGET = 0.4
#: Pieces encoded as one text.
RUN = 4096
#: How rank files' vocabularies split text, as published with them.  Fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_BYTES = np.arange(256)
_SPACE = np.isin(_BYTES, [0x20, *range(0x09, 0x0E)])
_ALNUM = np.array([b < 128 and chr(b).isalnum() for b in range(256)])
_PUNCT = np.array([0x20 < b < 0x7F and not chr(b).isalnum() for b in range(256)])
_LISTS = pa.list_(pa.int32())
WRITE_OPTIONS = {
    "parquet.block.size": str(ROW_GROUP),
    "parquet.page.size": str(PAGE),
    "parquet.dictionary.page.size": str(1 << 20),
    "parquet.enable.dictionary": "true",
    "parquet.writer.version": "PARQUET_2_0",
    "compression": "snappy",
}


def _after_space(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether a white-space character outside of the ASCII six (or a separator control) ends just before each place."""
    one, two, three = (data[np.maximum(at - k, 0)] for k in (1, 2, 3))
    wide = ((three == 0xE1) & (two == 0x9A) & (one == 0x80)) | ((three == 0xE2) & (two == 0x81) & (one == 0x9F)) | ((three == 0xE3) & (two == 0x80) & (one == 0x80))
    wide |= (three == 0xE2) & (two == 0x80) & ((one <= 0x8A) | (one == 0xA8) | (one == 0xA9) | (one == 0xAF))
    return wide | ((two == 0xC2) & ((one == 0x85) | (one == 0xA0))) | ((one >= 0x1C) & (one <= 0x1F))


def cuts(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The places where pieces of the documents ``data[at[i]:at[i + 1]]`` begin."""
    cut = np.zeros(len(data), bool)
    space = _SPACE[data]
    cut[1:] = (space[1:] & ~space[:-1]) | (_PUNCT[data[1:]] & _ALNUM[data[:-1]])
    doubtful = np.flatnonzero(cut[1:] & (data[:-1] >= 0x1C) & ~_ALNUM[data[:-1]] & ~_PUNCT[data[:-1]]) + 1
    cut[doubtful[_after_space(data, doubtful)]] = False
    heads = at[:-1]
    cut[heads[heads < len(data)]] = True
    return np.flatnonzero(cut)


class Encoder:
    """Texts to lists of ids with a file of the ``tokenizers`` library, or with a rank file of ``tiktoken``."""

    def __init__(self, path: str):
        if path.endswith(".tiktoken"):
            import tiktoken

            with open(path, "rb") as file:
                ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
            encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
            self.splits, sizes = True, {rank: len(token) for token, rank in ranks.items()}
            self._ids = lambda texts: [encoding.encode_ordinary(t) for t in texts]
            self.special = None
        else:
            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            from tokenizers import Tokenizer, pre_tokenizers

            tokenizer = Tokenizer.from_file(path)
            added = tokenizer.get_added_tokens_decoder().values()
            byte_level = isinstance(tokenizer.pre_tokenizer, pre_tokenizers.ByteLevel) and not tokenizer.pre_tokenizer.add_prefix_space and tokenizer.normalizer is None
            #: Whether texts may be cut; files of another kind encode whole texts.
            self.splits = byte_level and not any(t.rstrip or t.lstrip or t.single_word or any(c.isspace() for c in t.content) for t in added)
            #: Added tokens are found before a text is split, so no cut may lie within one.
            self.special = re.compile(b"|".join(re.escape(t.content.encode()) for t in added)) if added else None
            #: A byte-level token has a character a byte.
            sizes = {i: len(token) for token, i in tokenizer.get_vocab().items()}
            self._ids = lambda texts: [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        self.sizes = np.zeros(max(sizes) + 1, np.int64)
        self.sizes[list(sizes)] = list(sizes.values())
        self._forget()

    def _forget(self) -> None:
        self.known, self.ids = pa.array([], pa.string()), pa.array([], _LISTS)

    def _together(self, pieces: pa.StringArray, before: str) -> tuple[np.ndarray, np.ndarray] | None:
        """The ids of pieces encoded as one text, ``before`` in front of each, and how many each has; None where tokens don't end with the pieces."""
        joined = pc.binary_join_element_wise(before, pieces, "") if before else pieces
        data, at = text_buffers(joined)
        ids = np.array(self._ids([data[at[0] : at[-1]].tobytes().decode()])[0], np.int32)
        reached, ends = np.cumsum(self.sizes[ids]), at[1:] - at[0]
        cut = np.searchsorted(reached, ends) + 1
        if not len(ids) or cut[-1] != len(ids) or not np.array_equal(reached[cut - 1], ends):
            return None
        counts = np.diff(cut, prepend=0)
        if before:
            # it is a token by itself
            keep = np.ones(len(ids), bool)
            keep[cut - counts] = False
            return ids[keep], counts - 1
        return ids, counts

    def _learn(self, new: pa.StringArray) -> pa.ListArray:
        """The ids of distinct pieces.

        Pieces that begin with white space can follow each other in a text; a line feed, which is a token by itself there, goes before
        others that begin with an ASCII character.
        """
        data, at = text_buffers(new)
        head = data[at[:-1]]
        kind = np.where(_SPACE[head], 0, np.where(_ALNUM[head] | _PUNCT[head], 1, 2)) if self.splits else np.full(len(new), 2)
        order, ids, counts = [], [np.zeros(0, np.int32)], []
        for number, before in enumerate(("", "\n", None)):
            places = np.flatnonzero(kind == number)
            for run in (places[a : a + RUN] for a in range(0, len(places), RUN)):
                pieces = new.take(pa.array(run))
                found = self._together(pieces, before) if before is not None else None
                if found is None:
                    each = self._ids(pieces.to_pylist())
                    found = np.array([i for x in each for i in x], np.int32), np.array([len(x) for x in each])
                order.append(run)
                ids.append(found[0])
                counts.append(found[1])
        if not order:
            return pa.array([], _LISTS)
        limits = np.concatenate([[0], np.cumsum(np.concatenate(counts))]).astype(np.int32)
        back = np.empty(len(new), np.int64)
        back[np.concatenate(order)] = np.arange(len(new))
        return pa.ListArray.from_arrays(pa.array(limits), pa.array(np.concatenate(ids))).take(pa.array(back))

    def _cuts(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        begin = cuts(data, at)
        inside = [(m.start() + 1, m.end()) for m in self.special.finditer(data.tobytes())] if self.special else ()
        if inside:
            # the heads of documents stay, as a match may reach over the end of one
            low, high = np.array(inside).T
            within = np.searchsorted(low, begin, "right") > np.searchsorted(high, begin, "right")
            begin = begin[~within | np.isin(begin, at)]
        return begin

    def encode_slice(self, data: np.ndarray, at: np.ndarray) -> pa.ListArray:
        """The ids of each document ``data[at[i]:at[i + 1]]``, ``END_ID`` after them."""
        begin = self._cuts(data, at) if self.splits else np.unique(at[:-1][np.diff(at) > 0])
        limits = np.append(begin, len(data)).astype(np.int32)
        pieces = pa.StringArray.from_buffers(len(begin), pa.py_buffer(limits), pa.py_buffer(data)).dictionary_encode()
        distinct, places = pieces.dictionary, pieces.indices.to_numpy()
        found = pc.index_in(distinct, value_set=self.known)
        missing = found.is_null()
        unknown = missing.to_numpy(zero_copy_only=False)
        new = distinct.filter(missing)
        learned = self._learn(new)
        where = found.fill_null(0).to_numpy().copy()
        where[unknown] = len(self.known) + np.arange(len(new))
        lists = pa.concat_arrays([self.ids, learned, pa.array([[END_ID]], _LISTS)])
        # documents' pieces, and a piece that ends each document
        ends = np.searchsorted(begin, at)
        taken = lists.take(pa.array(np.insert(where[places], ends[1:], len(lists) - 1)))
        result = pa.ListArray.from_arrays(pa.array(taken.offsets.to_numpy()[ends + np.arange(len(at))]), taken.values)
        times = np.bincount(places, minlength=len(distinct))
        if times[unknown].sum() > FORGET * max(1, len(places)):
            self._forget()
        if len(self.known) < REMEMBERED:
            short = pc.less_equal(pc.binary_length(new), LONGEST)
            self.known, self.ids = pa.concat_arrays([self.known, new.filter(short)]), pa.concat_arrays([self.ids, learned.filter(short)])
        return result

    def encode(self, column: pa.Array) -> Iterator[tuple[int, pa.ListArray]]:
        """The lists of ids of a column's texts (null as empty), in slices, with the row of each slice's first."""
        data, at = text_buffers(column)
        row = 0
        while row < len(at) - 1:
            end = min(len(at) - 1, max(row + 1, int(np.searchsorted(at, at[row] + SLICE, "right")) - 1))
            yield row, self.encode_slice(data[at[row] : at[end]], at[row : end + 1] - at[row])
            row = end


@functools.cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def write_tokens(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write ``(doc_id, part, before, n_tokens, tokens)`` under ``path`` in ascending order of ids, null first.

    Every text, a null one as an empty one, ends with id 0.  Rows that repeat an id are written each, in the order of a hash of the text.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            for row, tokens in released(encoder(tokenizer).encode(batch.column(1))):
                limits = tokens.offsets.to_numpy().astype(np.int64)
                columns = [batch.column(0).slice(row, len(tokens)), pa.array(np.full(len(tokens), part, np.int32)), pa.array(before + limits[:-1]), pa.array(np.diff(limits)), tokens]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "part", "before", "n_tokens", "tokens"])
                before += int(limits[-1])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    tie = F.xxhash64("text")
    ordered = rows.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), tie)
    ordered.mapInArrow(work, f"doc_id {kind}, part int, before long, n_tokens long, tokens array<int>").write.options(**WRITE_OPTIONS).mode("error").parquet(path)


def positions(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens)`` and the tokens of a written folder; columns not asked for are not read."""
    files = spark.read.parquet(path)
    # one row a part: as many as there were tasks
    totals = {r.part: r.n for r in files.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()}
    offset, before = {}, 0
    for part in sorted(totals):
        offset[part] = before
        before += totals[part]
    if not offset:
        return files.select("doc_id", F.lit(0).cast("long").alias("start"), "n_tokens", "tokens")
    table = spark.createDataFrame(list(offset.items()), "part int, offset long")
    return files.join(F.broadcast(table), "part").select("doc_id", (F.col("offset") + F.col("before")).alias("start"), "n_tokens", "tokens")


def digests(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of each document, read back from the files."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            limits = np.frombuffer(lists.buffers()[1], np.int32)[lists.offset : lists.offset + len(lists) + 1]
            raw = lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False).view(np.uint8)
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(limits[:-1].tolist(), limits[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    found = positions(spark, path)
    return found.mapInArrow(work, f"doc_id {found.schema['doc_id'].dataType.simpleString()}, start long, n_tokens long, ids_crc32 long")


def token_range(spark: SparkSession, path: str, first: int, last: int) -> DataFrame:
    """Tokens of documents whose ids lie in a range; the indexes let the reader skip all other pages."""
    return positions(spark, path).where(F.col("doc_id").between(first, last))


def new_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/tokens-{uuid.uuid4().hex}"


def encoded(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` written to a new folder of the shared one and read back as ``digests``."""
    path = new_folder(docs.sparkSession)
    write_tokens(docs, path, tokenizer, id_col, text_col)
    return digests(docs.sparkSession, path)
