"""Array bundles (``.npz``): every array of a file as a row, checks of their shapes, and bundles built from rows."""

from __future__ import annotations

import io
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "path string, name string, dtype string, shape array<bigint>, integers array<bigint>, numbers array<double>, texts array<string>"


def _opened(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"], strict=True):
            rows = []
            with np.load(io.BytesIO(content), allow_pickle=False) as bundle:
                for name in bundle.files:
                    array = bundle[name]
                    kind = array.dtype.kind
                    integers = array.astype(np.int64).ravel().tolist() if kind in "biu" else None
                    numbers = array.astype(float).ravel().tolist() if kind == "f" else None
                    texts = None if kind in "biuf" else array.astype(str).ravel().tolist()
                    rows.append((path, name, str(array.dtype), list(array.shape), integers, numbers, texts))
            yield pd.DataFrame(rows, columns=[f.split()[0] for f in SCHEMA.split(", ")])


def bundles(spark: SparkSession, path: str) -> DataFrame:
    """One row an array, in row-major order: integers (times too) and booleans in ``integers``, floats in ``numbers``, all else in ``texts``.  NaN reads as null, as everywhere in the engine.  Pickled objects are refused."""
    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(_opened, SCHEMA)


def faults(arrays: DataFrame, axes: dict[str, Sequence[str]]) -> DataFrame:
    """``(path, reason)`` for each array of ``axes`` that a file lacks, or whose lengths disagree with those of the coordinate arrays.

    ``axes`` names the coordinate of every dimension of an array; a coordinate names itself.
    """
    shapes = arrays.groupBy("path").agg(F.map_from_entries(F.collect_list(F.struct("name", "shape"))).alias("s"))
    shape = F.col("s")
    checks = []
    for name, dims in axes.items():
        want = F.flatten(F.array(*[shape[d] for d in dims])) if dims else F.array().cast("array<bigint>")
        checks.append(F.when(shape[name].isNull(), F.lit(f"{name} is missing")).when(~shape[name].eqNullSafe(want), F.lit(f"{name} has another shape than {', '.join(dims)}")))
    return shapes.select("path", F.explode(F.array_compact(F.array(*checks))).alias("reason"))


def packed(arrays: dict[str, np.ndarray]) -> bytes:
    """A bundle of arrays, without objects; texts become fixed-width ones."""
    out = io.BytesIO()
    for name, array in arrays.items():
        if np.asarray(array).dtype.kind == "O":
            raise TypeError(f"{name} holds objects")
    np.savez_compressed(out, **arrays)
    return out.getvalue()


def scene_bundles(cells: DataFrame, bands: Sequence[str], height: int, width: int) -> DataFrame:
    """``(tile, content)``: for each tile a bundle of a ``(time, y, x, band)`` cube from ``cells(tile, item_id, time_ns, orbit, band, y, x, value)``.

    A tile's cube is bounded by its grid and its scenes, which are in the order of time and id.  What no scene covers is NaN; a missing orbit is -1
    and a missing id an empty text, in the files alone.
    """
    names = list(bands)

    def build(table: pd.DataFrame) -> pd.DataFrame:
        scenes = table[["item_id", "time_ns", "orbit"]].drop_duplicates("item_id").sort_values(["time_ns", "item_id"], ignore_index=True)
        place = {item: i for i, item in enumerate(scenes["item_id"])}
        cube = np.full((len(scenes), height, width, len(names)), np.nan, np.float32)
        inside = table[table["band"].isin(names) & table["y"].between(0, height - 1) & table["x"].between(0, width - 1)]
        at = inside["item_id"].map(place).to_numpy(np.int64), inside["y"].to_numpy(np.int64), inside["x"].to_numpy(np.int64), inside["band"].map(names.index).to_numpy(np.int64)
        cube[at] = inside["value"].to_numpy(np.float32)
        content = packed(
            {
                "values": cube,
                "valid": np.isfinite(cube),
                "time": scenes["time_ns"].to_numpy(np.int64),
                "band": np.array(names, "U2"),
                "orbit": scenes["orbit"].fillna(-1).to_numpy(np.int64),
                "item_id": np.array(scenes["item_id"].fillna("").astype(str).tolist(), "U120"),
            }
        )
        return pd.DataFrame({"tile": [table["tile"].iloc[0]], "content": [content]})

    kept = cells.select("tile", F.col("item_id").cast("string").alias("item_id"), "time_ns", "orbit", "band", "y", "x", "value")
    return kept.groupBy("tile").applyInPandas(build, f"tile {cells.schema['tile'].dataType.simpleString()}, content binary")
