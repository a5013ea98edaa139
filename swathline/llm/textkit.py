"""Whole-text tokenising and hashing over Arrow buffers, one bounded chunk at a time.

Texts reach Python as Arrow batches.  ``chunks`` cuts a batch into runs of whole documents of about
``CHUNK_BYTES`` bytes (one longer document is a chunk by itself), so working memory follows the longest
document and never the partition.  A word is a run of bytes other than 0x20 and 0x09-0x0D; as these are ASCII,
runs of UTF-8 bytes and runs of code points are the same.

Hashes are 64-bit: a polynomial in a fixed odd base over random byte values, taken from prefix sums modulo 2**64
and finished with a mixer.  They depend on content alone, so all executors agree on them.
"""

from __future__ import annotations

import ctypes
import functools
import os
import re
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK_BYTES = 1 << 19
WORD = r"[^\x20\x09-\x0D]+"

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_GRAM_BASE = np.uint64(0xD1342543DE82EF95)
_GRAM_INVERSE = np.uint64(pow(0xD1342543DE82EF95, -1, 1 << 64))
_BYTE_VALUES = np.random.default_rng(20240501).integers(1, 2**64, 256, dtype=np.uint64)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class _Powers:
    """Powers of a base modulo 2**64, grown when a longer chunk comes."""

    def __init__(self, base: np.uint64):
        self.base, self.table = base, np.ones(1, np.uint64)

    def upto(self, n: int) -> np.ndarray:
        if len(self.table) < n:
            size = 1 << (n - 1).bit_length()
            table = np.empty(size, np.uint64)
            table[0] = 1
            done = 1
            while done < size:
                step = np.uint64(pow(int(self.base), done, 1 << 64))
                table[done : 2 * done] = table[:done] * step
                done *= 2
            self.table = table
        return self.table[:n]


_UP, _DOWN = _Powers(_BASE), _Powers(_INVERSE)
_GRAM_UP, _GRAM_DOWN = _Powers(_GRAM_BASE), _Powers(_GRAM_INVERSE)


def mix(x: np.ndarray) -> np.ndarray:
    """The finishing steps of splitmix64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Chunk:
    """Some whole documents.  ``at``: their byte limits in ``data``; ``first``: their word limits in ``starts``."""

    def __init__(self, data: np.ndarray, at: np.ndarray, row: int, space: np.ndarray = _IS_SPACE):
        self.data, self.at, self.row = data, at, row
        word = ~space[data]
        starts, ends = word.copy(), word.copy()
        starts[1:] &= ~word[:-1]
        ends[:-1] &= ~word[1:]
        inner = at[1:-1][(at[1:-1] > 0) & (at[1:-1] < len(data))]
        starts[inner] = word[inner]
        ends[inner - 1] = word[inner - 1]
        self.word = word
        self.starts, self.ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.starts, at)
        self._prefix = None

    def __len__(self) -> int:
        return len(self.at) - 1

    @property
    def doc(self) -> np.ndarray:
        """The document of each word."""
        return np.repeat(np.arange(len(self)), np.diff(self.first))

    def hash_spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if self._prefix is None:
            self._prefix = np.zeros(len(self.data) + 1, np.uint64)
            np.cumsum(_BYTE_VALUES[self.data] * _UP.upto(len(self.data)), out=self._prefix[1:])
        down = _DOWN.upto(len(self.data) + 1)
        return mix((self._prefix[ends] - self._prefix[starts]) * down[starts] + (ends - starts).astype(np.uint64))

    def word_hashes(self) -> np.ndarray:
        return self.hash_spans(self.starts, self.ends)

    def gram_hashes(self, words: np.ndarray, n: int) -> np.ndarray:
        """The hash of n words from each word on; where the document ends earlier it is meaningless (see ``grams``)."""
        if len(words) < n:
            return np.zeros(0, np.uint64)
        prefix = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words * _GRAM_UP.upto(len(words)), out=prefix[1:])
        return mix((prefix[n:] - prefix[:-n]) * _GRAM_DOWN.upto(len(words))[: len(words) - n + 1] + np.uint64(n))

    def whole(self, n: int) -> np.ndarray:
        """Whether n words from each word on lie in one document, for the positions of ``gram_hashes``."""
        count = max(0, len(self.starts) - n + 1)
        left = np.repeat(self.first[1:], np.diff(self.first)) - np.arange(len(self.starts))
        return left[:count] >= n

    def per_doc(self, values: np.ndarray) -> np.ndarray:
        """Sums over each document's words."""
        total = np.zeros(len(values) + 1, np.int64)
        np.cumsum(values, out=total[1:])
        return total[self.first[1:]] - total[self.first[:-1]]

    def per_doc_bytes(self, values: np.ndarray) -> np.ndarray:
        total = np.zeros(len(values) + 1, np.int64)
        np.cumsum(values, out=total[1:])
        return total[self.at[1:]] - total[self.at[:-1]]

    def spaced(self, keep: np.ndarray | None = None) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
        """The words (those of ``keep``), a space after each; where each starts and ends; the word limits of documents."""
        lengths, used, first = self.ends - self.starts, self.word, self.first
        if keep is not None:
            used = used.copy()
            used[used] = np.repeat(keep, lengths)
            lengths = lengths[keep]
            first = np.concatenate([[0], np.cumsum(keep)])[self.first]
        starts = np.zeros(len(lengths) + 1, np.int64)
        np.cumsum(lengths + 1, out=starts[1:])
        out = np.full(int(starts[-1]), 32, np.uint8)
        out[np.arange(int(lengths.sum())) + np.repeat(np.arange(len(lengths)), lengths)] = self.data[used]
        return out.tobytes(), starts[:-1], starts[:-1] + lengths, first

    def text(self, doc: int) -> str:
        return self.data[self.at[doc] : self.at[doc + 1]].tobytes().decode("utf-8", "replace")


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its row limits; a null is an empty text."""
    if pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        column, kind = column.cast(pa.string()), np.int32
    _, limits, data = column.buffers()
    if limits is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(limits, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return (np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)), at


def chunks(column: pa.Array, *, lower: bool = False, space: np.ndarray = _IS_SPACE, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    data, at = text_buffers(column)
    row, rows = 0, len(at) - 1
    while row < rows:
        end = min(rows, max(row + 1, int(np.searchsorted(at, at[row] + limit, "right")) - 1))
        part = data[at[row] : at[end]]
        yield Chunk(_LOWER[part] if lower else part, at[row : end + 1] - at[row], row, space)
        row = end


@functools.cache
def _trim():
    try:
        return ctypes.CDLL("libc.so.6").malloc_trim
    except (OSError, AttributeError):
        return lambda pad: None


def released(batches: Iterator) -> Iterator:
    """``batches``, with the memory that a worker's allocators keep handed back after each, as workers live on between tasks."""
    for batch in batches:
        yield batch
        pa.default_memory_pool().release_unused()
        _trim()(0)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.  Where it is unset, a local session has one of its own; a cluster has none, which is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = os.path.join(tempfile.gettempdir(), f"swathline-{spark.sparkContext.applicationId}")
    return folder.rstrip("/")


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder, so that a lost executor costs no recomputation."""
    spark = df.sparkSession
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


def least_hashed(rows: DataFrame, column: str, most: int) -> DataFrame:
    """The ``most`` rows of least hash of a column that is unique in ``rows``, equal hashes by the column.

    A sort with a limit brings that many rows of every partition to one task; so rows under a hash that some four times as many
    as are wanted are under go first, which leaves the result as it is.
    """
    hashed, n = F.xxhash64(column), rows.count()
    if n > 8 * most:
        low = rows.where(hashed <= F.lit(int(-(2**63) + 2**64 * 4 * most / n)))
        if low.count() >= most:
            rows = low
    return rows.orderBy(hashed, column).limit(most)


def document_keys(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``docs(doc_id, text)`` as ``(key, text)`` with a long key in the order of ids that names one text, and the ids of keys.

    The key is the id itself where ids are whole numbers, unique and not null; there is then no table of ids.  Otherwise each
    pair of id and text gets a key, in the order of ids (null first) and then of a hash of the text, so that repeated rows
    share one, and ``(key, doc_id, mark)`` comes with it, with the hash as ``mark``.
    """
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    if docs.schema["doc_id"].dataType.simpleString() in ("bigint", "int", "smallint", "tinyint"):
        odd = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 OR doc_id IS NULL")
        if odd.isEmpty():
            return docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("key"), "text"), None
    docs = docs.withColumn("mark", F.xxhash64("text"))
    pairs = docs.select("doc_id", "mark").distinct().repartitionByRange("doc_id", "mark").sortWithinPartitions("doc_id", "mark")
    keys = checkpointed(pairs.withColumn("key", F.monotonically_increasing_id()))
    joined = docs.alias("d").join(keys.alias("k"), F.expr("d.doc_id <=> k.doc_id AND d.mark = k.mark"))
    return joined.select("k.key", "d.text"), keys.select("key", "doc_id", "mark")


def with_ids(found: DataFrame, ids: DataFrame | None, kind: str, name: str = "doc_id") -> DataFrame:
    """``found(key, ...)`` with the id of each key in the key's place."""
    rest = [c for c in found.columns if c != "key"]
    if ids is None:
        return found.select(F.col("key").cast(kind).alias(name), *rest)
    return found.join(ids, "key").select(F.col("doc_id").alias(name), *rest)
