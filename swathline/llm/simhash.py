"""SimHash near-duplicate classes found with BK-trees.

Fingerprints that differ in few bits must agree in some block of bits (pigeonhole), so the distinct fingerprints are
dealt to shards by block.  Each shard is one BK-tree: a child hangs on the edge that carries its integer Hamming
distance to the parent, and a search follows only the edges within the radius of the distance at hand.  A shard with
more than ``SHARD`` fingerprints is dealt again by blocks of its remaining bits; after the last level a shard is
bounded by the number of values of the ten bits that are left at most (1,024).  Hence every tree has a proven bound whatever the
data.  A broadcast is built from what the driver holds, and all trees together hold every fingerprint, so a tree reaches its
searches through the shuffle of its shard instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .textkit import Chunk, checkpointed, chunks, document_keys, released

RADIUS = 2
SHINGLE = 3
SHARD = 1024
LEVELS = 5


class BKTree:
    """A metric tree over 64-bit integers under Hamming distance."""

    def __init__(self):
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> int:
        """The node of ``value``, which is new unless it was there."""
        new = len(self.values)
        node = 0
        while new:
            distance = (self.values[node] ^ value).bit_count()
            if not distance:
                return node
            child = self.children[node].get(distance)
            if child is None:
                self.children[node][distance] = new
                break
            node = child
        self.values.append(value)
        self.children.append({})
        return new

    def within(self, value: int, radius: int) -> list[int]:
        """The nodes at most ``radius`` from ``value``."""
        found, stack = [], [0] if self.values else []
        while stack:
            node = stack.pop()
            distance = (self.values[node] ^ value).bit_count()
            if distance <= radius:
                found.append(node)
            for edge, child in self.children[node].items():
                if distance - radius <= edge <= distance + radius:
                    stack.append(child)
        return found


def fingerprints_of(chunk: Chunk, shingle: int = SHINGLE) -> np.ndarray:
    """The fingerprint of each document of a lower-cased chunk, as unsigned 64-bit integers."""
    result = np.zeros(len(chunk), np.uint64)
    n = np.diff(chunk.first)
    shingles = np.where(n >= shingle, n - shingle + 1, np.minimum(n, 1))
    has = np.flatnonzero(shingles)
    if not len(has):
        return result
    text, starts, ends, _ = chunk.spaced()
    offsets = np.zeros(len(has) + 1, np.int64)
    np.cumsum(shingles[has], out=offsets[1:])
    begin = np.arange(offsets[-1]) - np.repeat(offsets[:-1], shingles[has]) + np.repeat(chunk.first[:-1][has], shingles[has])
    end = begin + np.repeat(np.minimum(n[has], shingle), shingles[has]) - 1
    digest, view = xxhash.xxh64_intdigest, memoryview(text)
    hashes = np.fromiter((digest(view[a:b], 42) for a, b in zip(starts[begin].tolist(), ends[end].tolist(), strict=True)), np.uint64, len(begin))
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)
    set_bits = np.add.reduceat(bits, offsets[:-1], axis=0, dtype=np.int32)
    result[has] = np.packbits(2 * set_bits > shingles[has][:, None], axis=1).view(np.uint64).ravel()
    return result


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, fingerprint)`` of each row, the fingerprint as a signed long; a text without words (or null) has 0."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            found = [fingerprints_of(c, shingle) for c in chunks(batch.column(1), lower=True)]
            if found:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(found).view(np.int64))], ["doc_id", "fingerprint"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(work, f"doc_id {kind}, fingerprint long")


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def next_masks(mask: int, parts: int) -> list[int]:
    """``mask`` with each of ``parts`` nearly equal blocks of its clear bits set."""
    clear = [b for b in range(64) if not mask >> b & 1]
    cuts = [len(clear) * i // parts for i in range(parts + 1)]
    return [mask | sum(1 << b for b in clear[x:y]) for x, y in zip(cuts, cuts[1:], strict=False)]


def _stars(radius: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            ends: tuple[list[int], list[int]] = ([], [])
            for members in batch.column(0).to_pylist():
                tree, parent = BKTree(), list(range(len(members)))

                def root(x: int, parent=parent) -> int:
                    while parent[x] != x:
                        parent[x] = x = parent[parent[x]]
                    return x

                for value in members:
                    value &= (1 << 64) - 1
                    near = {root(x) for x in tree.within(value, radius)}
                    near.add(root(tree.add(value)))
                    least = min(near)
                    for x in near:
                        parent[x] = least
                for node, value in enumerate(tree.values):
                    if (top := root(node)) != node:
                        ends[0].append(_signed(value))
                        ends[1].append(_signed(tree.values[top]))
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in ends], ["a", "b"])

    return work


def links(distinct: DataFrame, radius: int = RADIUS, shard: int = SHARD, levels: int = LEVELS) -> DataFrame:
    """Links ``(a, b)`` between the fingerprints of ``distinct(fingerprint)`` that join the same classes as all links do.

    Within a shard each fingerprint is linked to one member of its class there, never to every other.
    """
    parts, masks, found = radius + 1, {0: next_masks(0, radius + 1)}, None
    rows = distinct.select("fingerprint", F.lit(0).cast("long").alias("mask"))
    for level in range(levels):
        if level:
            masks = {m: next_masks(m, parts) for after in masks.values() for m in after}
        choices: Column = F.create_map(*[x for m, after in masks.items() for x in (F.lit(_signed(m)), F.array(*[F.lit(_signed(a)) for a in after]))])
        rows = rows.select("fingerprint", F.explode(choices[F.col("mask")]).alias("mask"))
        rows = rows.withColumn("key", F.col("fingerprint").bitwiseAND(F.col("mask")))
        sizes = rows.groupBy("mask", "key").agg(F.count("*").alias("n")).where("n > 1")
        sized = checkpointed(rows.join(sizes, ["mask", "key"]))
        last = level == levels - 1
        trees = (sized if last else sized.where(F.col("n") <= shard)).groupBy("mask", "key").agg(F.collect_list("fingerprint").alias("members"))
        stars = trees.select("members").mapInArrow(_stars(radius), "a long, b long")
        found = stars if found is None else found.union(stars)
        rows = sized.where(F.col("n") > shard).select("fingerprint", "mask")
        if last or rows.isEmpty():
            return found
    raise AssertionError("unreachable")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, fingerprint, component_id)``, one row for each row of ``docs``.

    ``fingerprint``: 16 lowercase hex digits of the SimHash of the lower-cased words' shingles.  ``component_id``: the
    smallest id reachable over links of at most ``radius`` bits, the row's own included.  Null and empty texts have
    fingerprint zero and are linked like any others; repeated rows give repeated results; ids that are null never name
    a class unless the class has no other.  Other columns of ``docs`` are not read.
    """
    prints = checkpointed(fingerprints(docs, id_col, text_col, shingle))
    distinct = checkpointed(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least")))
    labels = components(links(distinct, radius)).select(F.col("node").alias("fingerprint"), "label")
    classed = checkpointed(distinct.join(labels, "fingerprint", "left").select("fingerprint", "least", F.coalesce("label", "fingerprint").alias("label")))
    named = classed.groupBy("label").agg(F.min("least").alias("component_id"))
    by_print = classed.join(named, "label").select("fingerprint", "component_id")
    text = F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint")
    return prints.join(by_print, "fingerprint").select("doc_id", text, "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each class: that of the smallest id, null last, and of rows that share it the least hash of the text."""
    keyed, ids = document_keys(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    if ids is None:
        lost = near_duplicates(docs, id_col, text_col).where("doc_id <> component_id").select(F.col("doc_id").alias(id_col)).distinct()
        return docs.join(lost, id_col, "left_anti")
    classes = near_duplicates(keyed.dropDuplicates(["key"]), "key").withColumnRenamed("doc_id", "key").join(ids, "key")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "mark")).alias("first")
    kept = classes.groupBy("component_id").agg(first).select("first.doc_id", "first.mark")
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col).cast("string")).alias("mark"))
    rows = rows.dropDuplicates(["doc_id", "mark"]).alias("r")
    return rows.join(kept.alias("k"), F.expr("r.doc_id <=> k.doc_id AND r.mark = k.mark"), "left_semi").select("row.*")
