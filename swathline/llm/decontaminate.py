"""Benchmark decontamination by size-partitioned MinHash containment search.

A test item is contained in a document when the document holds at least ``THRESHOLD`` of its distinct shingles of five
words (lower-cased runs of anything but ASCII punctuation and white space).  As wholes, a long document and a short item have hardly any
Jaccard similarity, so both sides are partitioned by size: items by powers of two of their shingle count and, for each
size class, documents into windows of twice the class's largest size that overlap by half.  A passage as long as an item of the class lies within one window.  Containment t of an item of q shingles in a window of w then means a
Jaccard similarity of at least t q / (w + q - t q); from that bound, taken for half the threshold so that an item split
in two is found as well, follows how many hash functions (bands of one row) find it with probability ``RECALL``.  Every
candidate pair is verified by exact containment of the item's shingles in the whole document.

Where the benchmark's signatures and texts are within ``BROADCAST_BYTES``, they are sent to all tasks, and documents are
searched and verified where they are read, without a shuffle.  A larger benchmark is joined by signature and verified
after joins by document and item; of the windows' signatures just those that pass a filter of the benchmark's are shuffled.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textkit import Chunk, checkpointed, chunks, document_keys, mix, released, with_ids

SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.999
#: Shingles of a block, the least stride of a window.
BLOCK = 16
BROADCAST_BYTES = 64 << 20
#: Bits of the filter that most windows' hashes fail before they are looked up.
FILTER_BITS = 21
NOT_WORD = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"
_WORD = re.compile(f"[^{NOT_WORD}]+")
_SPACE = np.zeros(256, bool)
_SPACE[[b for b in range(128) if not chr(b).isalnum()]] = True
#: Bits of the filter that goes to all tasks where the benchmark itself is too large for it (16 MB).
WIDE_BITS = 27
_FACTORS = np.random.default_rng(77).integers(0, 2**63, 4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: str | None, n: int = SHINGLE) -> set[str]:
    """Distinct shingles of a lower-cased text; none where it has fewer than n words."""
    words = _WORD.findall(text or "")
    return {" ".join(words[i : i + n]) for i in range(len(words) - n + 1)}


def lowered(column: pa.Array) -> pa.Array:
    return pc.utf8_lower(column.cast(pa.string()))


def size_class(q: int) -> int:
    """The class of an item of q shingles: the power of two at most q."""
    return 1 << (q.bit_length() - 1)


def stride(size: int) -> int:
    """Shingles of half a window of a class: more than its items have, and whole blocks."""
    return max(BLOCK, 2 * size)


def hashes_for(size: int, threshold: float = THRESHOLD, recall: float = RECALL) -> int:
    """How many hash functions find half the threshold's share of the class's smallest item with probability ``recall``.

    A threshold so low, or a recall so high, that it takes more functions than there are is an error.
    """
    shared = threshold / 2 * size
    needed = math.ceil(math.log(1 - recall) / math.log(1 - shared / (2 * stride(size) + size - shared)))
    if needed > len(_FACTORS):
        raise ValueError(f"a threshold of {threshold} needs {needed} hash functions; there are {len(_FACTORS)}")
    return needed


def _signature(minimum: np.ndarray, size: int, k: int) -> np.ndarray:
    return mix(minimum ^ np.uint64((size << 16) + k))


def item_signatures(items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(item, size, signature)`` for ``items(item, text)``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            for chunk in chunks(lowered(batch.column(1)), space=_SPACE):
                words = chunk.word_hashes()
                grams, whole = chunk.gram_hashes(words, SHINGLE), chunk.whole(SHINGLE)
                for doc in range(len(chunk)):
                    span = slice(chunk.first[doc], chunk.first[doc + 1])
                    own = np.unique(grams[span][whole[span]])
                    if not len(own):
                        continue
                    size = size_class(len(own))
                    found = [int(_signature((own * _FACTORS[k]).min(keepdims=True), size, k)[0]) for k in range(hashes_for(size, threshold))]
                    ids = batch.column(0).slice(chunk.row + doc, 1).take(pa.array([0] * len(found)))
                    yield pa.RecordBatch.from_arrays([ids, pa.array([size] * len(found), pa.int64()), pa.array(np.array(found, np.uint64).view(np.int64))], ["item", "size", "signature"])

    kind = items.schema["item"].dataType.simpleString()
    return items.mapInArrow(work, f"item {kind}, size long, signature long")


def window_signatures(chunk: Chunk, sizes: list[int], threshold: float, passes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(document, signature) of the windows of a chunk, as far as ``passes`` (a test of signatures) lets them."""
    words = chunk.word_hashes()
    grams, whole = chunk.gram_hashes(words, SHINGLE), chunk.whole(SHINGLE)
    per_doc = np.maximum(np.diff(chunk.first) - SHINGLE + 1, 0)
    blocks = -(-per_doc // BLOCK)
    if not blocks.sum():
        return
    doc = np.repeat(np.arange(len(chunk)), blocks)
    inner = np.arange(len(doc)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    # a document's last block is filled up with its last shingle, which changes no minimum
    at = chunk.first[doc] + np.minimum(inner * BLOCK + np.arange(BLOCK)[:, None], per_doc[doc] - 1)
    laid = grams[at]
    product, n = np.empty_like(laid), max(hashes_for(s, threshold) for s in sizes)
    least = np.stack([np.multiply(laid, _FACTORS[k], out=product).min(axis=0) for k in range(n)])
    for size in sizes:
        heads = np.flatnonzero(inner % (stride(size) // BLOCK) == 0)
        halves = np.minimum.reduceat(least[: hashes_for(size, threshold)], heads, axis=1)
        of = doc[heads]
        joined = halves.copy()
        same = of[1:] == of[:-1]
        joined[:, :-1] = np.where(same, np.minimum(halves[:, :-1], halves[:, 1:]), halves[:, :-1])
        for k in range(len(joined)):
            signature = _signature(joined[k], size, k)
            hit = passes(signature)
            yield of[hit], signature[hit]


def _verified(text: str, wanted: list[tuple], threshold: float) -> Iterator[tuple]:
    own = shingles(text)
    for item, needed in wanted:
        shared = len(needed & own)
        if shared and shared >= threshold * len(needed) - 1e-9:
            yield item, shared, len(needed)


_OUT = "key long, item {kind}, n_shared long, n_item long"


def _broadcast_search(docs: DataFrame, items: list[tuple], table: list[tuple], threshold: float, kind: str) -> DataFrame:
    by_signature: dict[int, list] = defaultdict(list)
    for item, _, signature in table:
        by_signature[signature].append(item)
    keys = np.array(sorted(by_signature), np.int64)
    light = np.zeros(1 << FILTER_BITS, bool)
    light[keys.view(np.uint64) >> np.uint64(64 - FILTER_BITS)] = True
    sizes = sorted({size for _, size, _ in table})
    texts = {item: shingles(pc.utf8_lower(pa.scalar(text)).as_py()) for item, text in items}
    sent = docs.sparkSession.sparkContext.broadcast((dict(by_signature), keys, light, texts))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_signature, keys, light, texts = sent.value

        def passes(signature: np.ndarray) -> np.ndarray:
            maybe = np.flatnonzero(light[signature >> np.uint64(64 - FILTER_BITS)])
            own = signature[maybe].view(np.int64)
            return maybe[keys[np.minimum(np.searchsorted(keys, own), len(keys) - 1)] == own]

        for batch in released(batches):
            out: list[list] = [[], [], [], []]
            for chunk in chunks(lowered(batch.column(1)), space=_SPACE):
                near: dict[int, set] = defaultdict(set)
                for doc, signature in window_signatures(chunk, sizes, threshold, passes):
                    for d, s in zip(doc.tolist(), signature.view(np.int64).tolist(), strict=True):
                        near[d].update(by_signature[s])
                for d, candidates in sorted(near.items()):
                    for found in _verified(chunk.text(d), [(i, texts[i]) for i in sorted(candidates)], threshold):
                        for column, value in zip(out, (batch.column(0)[chunk.row + d].as_py(), *found), strict=True):
                            column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], ["key", "item", "n_shared", "n_item"])

    types = [pa.int64(), {"bigint": pa.int64(), "int": pa.int32()}.get(kind, pa.string()), pa.int64(), pa.int64()]
    return docs.mapInArrow(work, _OUT.format(kind=kind))


def _joined_search(docs: DataFrame, items: DataFrame, table: DataFrame, sizes: list[int], threshold: float, kind: str) -> DataFrame:
    # of a bounded size whatever the benchmark's: a bit for each value of a signature's first bits
    place = F.shiftrightunsigned("signature", 64 - WIDE_BITS)
    words = table.groupBy(F.shiftright(place, 3).cast("int").alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1, CAST(shiftrightunsigned(signature, {64 - WIDE_BITS}) & 7 AS INT))")).alias("bits")).toArrow()
    light = np.zeros(1 << (WIDE_BITS - 3), np.uint8)
    light[words["word"].to_numpy()] = words["bits"].to_numpy()
    sent = docs.sparkSession.sparkContext.broadcast(light)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        light = sent.value

        def passes(signature: np.ndarray) -> np.ndarray:
            at = signature >> np.uint64(64 - WIDE_BITS)
            return np.flatnonzero(light[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1)

        for batch in released(batches):
            for chunk in chunks(lowered(batch.column(1)), space=_SPACE):
                for doc, signature in window_signatures(chunk, sizes, threshold, passes):
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(doc + chunk.row)), pa.array(signature.view(np.int64))], ["key", "signature"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            out: list[list] = [[], [], [], []]
            texts, tests = lowered(batch.column(1)), lowered(batch.column(3))
            for row in range(len(batch)):
                for found in _verified(texts[row].as_py() or "", [(batch.column(2)[row].as_py(), shingles(tests[row].as_py()))], threshold):
                    for column, value in zip(out, (batch.column(0)[row].as_py(), *found), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], ["key", "item", "n_shared", "n_item"])

    types = [pa.int64(), {"bigint": pa.int64(), "int": pa.int32()}.get(kind, pa.string()), pa.int64(), pa.int64()]
    pairs = docs.mapInArrow(sign, "key long, signature long").distinct().join(table.select("item", "signature"), "signature").select("key", "item").distinct()
    rows = pairs.join(docs, "key").join(items.withColumnRenamed("text", "test"), "item").select("key", "text", "item", "test")
    return rows.mapInArrow(verify, _OUT.format(kind=kind))


def _search(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", threshold: float = THRESHOLD, broadcast_bytes: int = BROADCAST_BYTES) -> tuple[DataFrame, DataFrame | None, DataFrame]:
    """``(key, item, n_shared, n_item)`` by the keys of ``document_keys`` and of distinct test texts, and the ids of both."""
    rows = benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text).cast("string").alias("text")).where("text IS NOT NULL").distinct()
    items = checkpointed(rows.select("text").distinct().select(F.monotonically_increasing_id().alias("item"), "text"))
    names, kind = rows.join(items, "text").select("item", "item_id"), "bigint"
    table = checkpointed(item_signatures(items, threshold).distinct())
    weight = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0] * 8 + table.count() * 64
    keyed, ids = document_keys(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    if ids is not None:
        keyed = keyed.dropDuplicates(["key"])
    if weight <= broadcast_bytes:
        rows = [tuple(r) for r in table.collect()]
        found = _broadcast_search(keyed, [tuple(r) for r in items.collect()], rows, threshold, kind) if rows else None
    else:
        sizes = sorted(r.size for r in table.select("size").distinct().collect())
        found = _joined_search(keyed, items, table, sizes, threshold, kind)
    if found is None:
        found = docs.sparkSession.createDataFrame([], _OUT.format(kind=kind))
    return found, ids, names


def contained(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``(doc_id, item_id, n_shared, n_item, containment)`` for each document and item it contains to ``threshold``.

    An empty table of either kind gives no rows.  Items with fewer than five words are too short to tell and match nothing, as do null and empty texts.  Repeated
    items and rows that repeat id and text count once; an id with several texts is found through any of them.  An item with
    several texts is found through any of them as well, each with its own counts, and an item without id has a null ``item_id``.
    """
    found, ids, names = _search(docs, benchmark, id_col, text_col, **options)
    found = found.join(names, "item").drop("item")
    found = with_ids(found, ids, docs.schema[id_col].dataType.simpleString()).distinct()
    return found.select("doc_id", "item_id", "n_shared", "n_item", (F.col("n_shared") / F.col("n_item")).alias("containment"))


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that contain no test item; rows with a null id are judged as a group and stay."""
    hit = contained(docs, benchmark, id_col, text_col, **options).select(F.col("doc_id").alias(id_col)).distinct()
    return docs.join(hit, id_col, "left_anti")


def clean_rows(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` whose own text contains no test item, whatever other rows share their id."""
    found, ids, _ = _search(docs, benchmark, id_col, text_col, **options)
    if ids is None:
        return docs.join(found.select(F.col("key").cast(docs.schema[id_col].dataType).alias(id_col)).distinct(), id_col, "left_anti")
    hit = found.select("key").distinct().join(ids, "key")
    same = docs[id_col].eqNullSafe(hit["doc_id"]) & (F.xxhash64(docs[text_col].cast("string")) == hit["mark"])
    return docs.join(hit, same, "left_anti")
