"""Averages on a projected grid of rasters that are located by ground control points."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swathline.functions.projection import forward
from swathline.functions.radiometry import finite

#: Cell coordinates are rounded to so many places, so that edges which fall together do so in spite of rounding.
PLACES = 6


def _terms(u, v) -> list:
    return [u**0, u, v, u * u, u * v, v * v]


def fitted(points: DataFrame, keys: Sequence[str], epsg: int) -> DataFrame:
    """For each raster of ``points(pixel, line, lon, lat)``, polynomials from pixel and line to a zone's metres.

    ``(keys, offsets, spans, fx, fy)``: of second degree with six points or more, else of first; points with a null count for nothing, and a
    raster of under three, or of points on one line, is an error.  A raster has a few hundred points, which one task fits.
    """
    metres = points.select(*keys, F.col("pixel").cast("double"), F.col("line").cast("double"), forward(F.col("lon"), F.col("lat"), F.lit(epsg)).alias("p")).select(*keys, "pixel", "line", "p.x", "p.y").dropna(subset=["pixel", "line", "x", "y"])

    def fit(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        at = rows[["pixel", "line"]].to_numpy()
        offsets = at.mean(axis=0)
        spans = np.maximum(np.abs(at - offsets).max(axis=0), 1.0)
        u, v = ((at - offsets) / spans).T
        degree = 6 if len(at) >= 6 else 3
        design = np.stack(_terms(u, v)[:degree], axis=1)
        middle = rows[["x", "y"]].to_numpy().mean(axis=0)
        solved, _, rank, _ = np.linalg.lstsq(design, rows[["x", "y"]].to_numpy() - middle, rcond=None)
        if rank < degree:
            raise ValueError(f"control points of {key} don't place a raster")
        factors = np.zeros((6, 2))
        factors[:degree] = solved
        factors[0] += middle
        return pd.DataFrame([(*key, offsets.tolist(), spans.tolist(), factors[:, 0].tolist(), factors[:, 1].tolist())], columns=[*keys, "offsets", "spans", "fx", "fy"])

    types = {f.name: f.dataType.simpleString() for f in metres.schema}
    schema = ", ".join([*[f"`{k}` {types[k]}" for k in keys], *[f"{c} array<double>" for c in ("offsets", "spans", "fx", "fy")]])
    return metres.groupBy(*keys).applyInPandas(fit, schema)


def _extent(factors: Column, u: Column, v: Column, spans: Column, origin: float, step: float) -> tuple[Column, Column]:
    """Where the box around a pixel begins and ends along an axis of the grid, in cells."""
    at = factors[0] + factors[1] * u + factors[2] * v + factors[3] * u * u + factors[4] * u * v + factors[5] * v * v
    by_pixel, by_line = (factors[1] + factors[3] * 2 * u + factors[4] * v) / spans[0], (factors[2] + factors[4] * u + factors[5] * 2 * v) / spans[1]
    centre, half = (at - origin) / step, (F.abs(by_pixel) + F.abs(by_line)) / (2 * abs(step))
    return F.round(centre - half, PLACES), F.round(centre + half, PLACES)


def _shares(low: Column, high: Column, size: int, cell: str, weight: str) -> Column:
    """The cells of a grid that an extent overlaps, each with the overlapping length; none outside."""
    first, last = F.greatest(F.floor(low), F.lit(0)), F.least(F.ceil(high) - 1, F.lit(size - 1))
    cells = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))
    return F.transform(cells, lambda c: F.struct(c.alias(cell), (F.least(high, c + 1) - F.greatest(low, c.cast("double"))).alias(weight)))


def warped(rows: DataFrame, fits: DataFrame, keys: Sequence[str], by: Sequence[str], transform: Sequence[float], height: int, width: int, column: str = "values") -> DataFrame:
    """Averages of raster ``rows(keys, by, row, values)`` on a grid without rotation of affine terms (a, 0, c, 0, e, f).

    ``(by, y, x, value, fraction)`` as of ``raster.averaged``: a pixel weighs by what the box around it shares with a cell, pixels that are null or
    not finite have no value, and cells that no pixel reaches are absent.  Fits join whole rows, before they are exploded, and sums combine on
    the map side.  A row of a raster without fit is left out, as a raster without place.
    """
    a, b, c, d, e, f = transform
    if b or d or not a or not e:
        raise ValueError("the grid must not be rotated, and its cells need a size")
    placed = rows.select(*dict.fromkeys([*keys, *by]), "row", F.col(column).alias("_values")).join(fits, list(keys))
    pixels = placed.select(*by, "row", "offsets", "spans", "fx", "fy", F.posexplode("_values").alias("_col", "_value"))
    u, v = (F.col("_col") + 0.5 - F.col("offsets")[0]) / F.col("spans")[0], (F.col("row") + 0.5 - F.col("offsets")[1]) / F.col("spans")[1]
    across, down = _extent(F.col("fx"), u, v, F.col("spans"), c, a), _extent(F.col("fy"), u, v, F.col("spans"), f, e)
    boxes = pixels.select(*by, "_value", F.explode(F.array(F.struct(*[x.alias(n) for x, n in zip((*across, *down), ("x0", "x1", "y0", "y1"), strict=True)]))).alias("_b"))
    spread = boxes.withColumn("_y", F.explode(_shares(F.col("_b.y0"), F.col("_b.y1"), height, "y", "w"))).withColumn("_x", F.explode(_shares(F.col("_b.x0"), F.col("_b.x1"), width, "x", "w")))
    weight, valid = F.col("_y.w") * F.col("_x.w"), F.when(finite(F.col("_value")), F.col("_value").cast("double"))
    sums = spread.groupBy(*by, F.col("_y.y").alias("y"), F.col("_x.x").alias("x")).agg(F.sum(weight * valid).alias("_v"), F.sum(F.when(valid.isNotNull(), weight)).alias("_w"), F.sum(weight).alias("_all"))
    return sums.select(*by, "y", "x", (F.col("_v") / F.nullif(F.col("_w"), F.lit(0.0))).alias("value"), (F.coalesce("_w", F.lit(0.0)) / F.col("_all")).alias("fraction"))
