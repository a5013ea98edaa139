"""Checksummed record files of array bundles, as a Spark data source.

A file is frames of ``u64 length | u32 masked crc of the length | payload | u32 masked crc of the payload``, little-endian.
The first payload is a JSON manifest ``{"kind": "metadata", ...}``, each other one a JSON chunk.  Frames cannot be split, so a file is one input partition.
"""

from __future__ import annotations

import hashlib
import io
import json
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from swathline.functions.checksum import masked

from .arrays import packed


def frame(payload: bytes) -> bytes:
    size = struct.pack("<Q", len(payload))
    return size + struct.pack("<I", masked(size)) + payload + struct.pack("<I", masked(payload))


def frames(data: bytes) -> Iterator[bytes]:
    """The payloads of a file; EOFError where it ends within a frame, ValueError where a checksum is wrong."""
    at = 0
    while at < len(data):
        if at + 12 > len(data):
            raise EOFError("the file ends within a frame's head")
        size, crc = struct.unpack_from("<QI", data, at)
        if masked(data[at : at + 8]) != crc:
            raise ValueError(f"wrong checksum of a length at byte {at}")
        end = at + 12 + size
        if end + 4 > len(data):
            raise EOFError("the file ends within a frame")
        payload = data[at + 12 : end]
        if masked(payload) != struct.unpack_from("<I", data, end)[0]:
            raise ValueError(f"wrong checksum of a payload at byte {at}")
        yield payload
        at = end + 4


def bundle(rows: list[dict], chunk_size: int | None = None, attrs: dict | None = None) -> bytes:
    """A file of ``rows``: a manifest and chunks of ``chunk_size`` rows (all in one by default)."""
    n = len(rows)
    size = max(1, min(chunk_size or n, n)) if n else 1
    chunks = [rows[i : i + size] for i in range(0, n, size)]
    manifest = {"kind": "metadata", "schema_version": 1, "chunk_size": size, "n_chunks": len(chunks), "n": n, "attrs": attrs or {}}
    out = frame(json.dumps(manifest, sort_keys=True).encode())
    for i, chunk in enumerate(chunks):
        out += frame(json.dumps({"kind": "chunk", "chunk_index": i, "start": i * size, "stop": i * size + len(chunk), "rows": chunk}, sort_keys=True).encode())
    return out


def array_bundle(arrays: dict[str, np.ndarray], dims: dict[str, tuple[str, ...]], chunk_dim: str | None = None, chunk_size: int | None = None, attrs: dict | None = None) -> bytes:
    """A file of arrays: a manifest, and chunks along a dimension, each an ``.npz`` payload after its own JSON head.

    Arrays without the dimension are in the first chunk alone.  A payload is ``u32 length of the head | head | npz``.
    """
    sizes = {d: n for name, shape in dims.items() for d, n in zip(shape, arrays[name].shape, strict=True)}
    for name, shape in dims.items():
        if tuple(sizes[d] for d in shape) != arrays[name].shape:
            raise ValueError(f"{name} has another shape than its dimensions")
    n = sizes[chunk_dim] if chunk_dim else 1
    size = max(1, min(chunk_size or n, n)) if n else 1
    limits = [(i, min(i + size, n)) for i in range(0, max(n, 1), size)]
    manifest = {"kind": "metadata", "schema_version": 2, "chunk_dim": chunk_dim, "chunk_size": size, "n_chunks": len(limits), "dims": sizes, "data_vars": {k: list(v) for k, v in dims.items()}, "attrs": attrs or {}}
    out = frame(json.dumps(manifest, sort_keys=True).encode())
    for number, (start, stop) in enumerate(limits):
        part = {}
        for name, shape in dims.items():
            if chunk_dim in shape:
                part[name] = np.take(arrays[name], range(start, stop), axis=shape.index(chunk_dim))
            elif not number:
                part[name] = arrays[name]
        head = json.dumps({"kind": "chunk", "chunk_index": number, "start": start, "stop": stop}, sort_keys=True).encode()
        out += frame(struct.pack("<I", len(head)) + head + packed(part))
    return out


def array_bundle_of(data: bytes) -> tuple[dict, dict[str, np.ndarray]]:
    """The manifest and the arrays of a file, whatever the order of its chunks; a chunk that lacks or is there twice is an error."""
    payloads = list(frames(data))
    if not payloads or (manifest := json.loads(payloads[0])).get("kind") != "metadata":
        raise ValueError("the first record is not a manifest")
    chunks = {}
    for payload in payloads[1:]:
        (size,) = struct.unpack_from("<I", payload)
        head = json.loads(payload[4 : 4 + size])
        if head["kind"] != "chunk" or head["chunk_index"] in chunks:
            raise ValueError("a record is no chunk, or one that was there before")
        with np.load(io.BytesIO(payload[4 + size :]), allow_pickle=False) as bundle:
            chunks[head["chunk_index"]] = {name: bundle[name] for name in bundle.files}
    if sorted(chunks) != list(range(manifest["n_chunks"])):
        raise ValueError("chunks are missing")
    arrays = {}
    for name, shape in manifest["data_vars"].items():
        parts = [chunks[i][name] for i in sorted(chunks) if name in chunks[i]]
        arrays[name] = np.concatenate(parts, axis=shape.index(manifest["chunk_dim"])) if manifest["chunk_dim"] in shape else parts[0]
    return manifest, arrays


def write_bundles(bundles: DataFrame, folder: str, name: str = "tile") -> DataFrame:
    """Write ``bundles(<name>, content)`` as ``<folder>/<name>.tfrecord``, each from the task that holds it, and return ``(<name>, path, n_bytes, sha256)``.

    A file appears under its name only when it is whole, so a task that runs again replaces it.  The folder's scheme can be any that pyarrow opens.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        files, root = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        files.create_dir(root, recursive=True)
        for batch in batches:
            paths, sizes, digests = [], [], []
            for key, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                path = f"{root}/{key}.tfrecord"
                part = f"{path}.{uuid.uuid4().hex}.part"
                with files.open_output_stream(part) as out:
                    out.write(content)
                files.move(part, path)
                paths.append(path)
                sizes.append(len(content))
                digests.append(hashlib.sha256(content).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(paths, pa.string()), pa.array(sizes, pa.int64()), pa.array(digests, pa.string())], [name, "path", "n_bytes", "sha256"])

    kind = bundles.schema[name].dataType.simpleString()
    return bundles.select(name, "content").mapInArrow(write, f"{name} {kind}, path string, n_bytes long, sha256 string")


class _Reader(DataSourceReader):
    def __init__(self, paths: list[str]):
        self.paths = paths

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(p) for p in self.paths]

    def read(self, partition: InputPartition):
        with open(partition.value, "rb") as file:
            for number, payload in enumerate(frames(file.read())):
                record = json.loads(payload)
                if (number == 0) != (record["kind"] == "metadata"):
                    raise ValueError("the first record, and no other, is the manifest")
                yield partition.value, record["kind"], record.get("chunk_index", -1), payload.decode()


class RecordSource(DataSource):
    """``spark.read.format("records").option("paths", json list)``: ``(path, kind, chunk_index, payload)``."""

    @classmethod
    def name(cls) -> str:
        return "records"

    def schema(self) -> str:
        return "path string, kind string, chunk_index int, payload string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(json.loads(self.options["paths"]))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(RecordSource)
