"""Pixels as rows: statistics, area-weighted resampling, masks and cubes.

A source is ``(item_id, band, row, values array<float>)``; grids are in long form ``(item_id, band, y, x, value)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swathline.functions.radiometry import decibels, finite


def pixels(rows: DataFrame, keys: Sequence[str], column: str = "values") -> DataFrame:
    return rows.select(*keys, "row", F.posexplode(column).alias("col", "value"))


def strips(rows: DataFrame, height: int) -> DataFrame:
    """``strip``: the window of full rows a row belongs to."""
    return rows.withColumn("strip", F.floor(F.col("row") / height))


def finite_summary(table: DataFrame, keys: Sequence[str], column: str = "value") -> DataFrame:
    """Finite and other values counted, and range, mean and median of the finite ones; nulls where there are none."""
    good = F.when(finite(F.col(column)), F.col(column).cast("double"))
    found = table.groupBy(*keys) if keys else table
    return found.agg(F.count(good).alias("n_finite"), (F.count("*") - F.count(good)).alias("n_other"), F.min(good).alias("lowest"), F.max(good).alias("highest"), F.avg(good).alias("mean"), F.median(good).alias("median"))


def _shares(at: str, scale: float, size: int, cell: str, weight: str) -> Column:
    """The destination cells a source pixel of unit length overlaps, each with the overlapping length."""
    low, high = F.col(at) / F.lit(scale), (F.col(at) + 1) / F.lit(scale)
    first, last = F.floor(low), F.least(F.ceil(high) - 1, F.lit(size - 1))
    return F.transform(F.sequence(first, F.greatest(first, last)), lambda c: F.struct(c.alias(cell), ((F.least(high, c + 1) - F.greatest(low, c.cast("double"))) * F.lit(scale)).alias(weight)))


def averaged(table: DataFrame, keys: Sequence[str], scale: float, height: int, width: int) -> DataFrame:
    """Area-weighted means on a grid whose cells are ``scale`` source pixels wide and high.

    ``(y, x, value, fraction)``: ``value`` averages the valid pixels (those not null), ``fraction`` is the share of the cell they
    cover.  The sums combine on the map side, so what is shuffled is grids and not pixels.
    """
    spread = table.withColumn("ys", F.explode(_shares("row", scale, height, "y", "wy"))).withColumn("xs", F.explode(_shares("col", scale, width, "x", "wx")))
    weight = F.col("ys.wy") * F.col("xs.wx")
    valid = F.when(finite(F.col("value")), F.col("value").cast("double"))
    cells = spread.groupBy(*keys, F.col("ys.y").alias("y"), F.col("xs.x").alias("x"))
    sums = cells.agg(F.sum(weight * valid).alias("v"), F.sum(F.when(valid.isNotNull(), weight)).alias("w"), F.sum(weight).alias("all"))
    return sums.select(*keys, "y", "x", (F.col("v") / F.nullif(F.col("w"), F.lit(0.0))).alias("value"), (F.coalesce("w", F.lit(0.0)) / F.col("all")).alias("fraction"))


def to_decibels(grid: DataFrame) -> DataFrame:
    """Averages are taken of linear power; only then come decibels."""
    return grid.withColumns({"db": decibels(F.col("value")), "valid": F.coalesce(F.col("value") > 0, F.lit(False))})


def area_summary(grid: DataFrame, keys: Sequence[str]) -> DataFrame:
    return grid.groupBy(*keys).agg(F.avg("fraction").alias("area_mean"), F.avg((F.col("fraction") > 0).cast("int")).alias("occupied"), F.avg((F.abs(F.col("fraction") - 1) <= 1e-6).cast("int")).alias("full"))


def combined_masks(grid: DataFrame) -> DataFrame:
    """By item, the shares of cells that all bands and that any band see."""
    cells = grid.groupBy("item_id", "y", "x").agg(F.bool_and("valid").alias("every"), F.bool_or("valid").alias("some"))
    return cells.groupBy("item_id").agg(F.avg(F.col("every").cast("int")).alias("joint"), F.avg(F.col("some").cast("int")).alias("either"))


def bands(scenes: DataFrame, layout: str, column: str = "band") -> list[str]:
    """Output bands in order: all known ones, or those seen (at most four rows reach the driver)."""
    from swathline.functions.text import POLARISATIONS

    if layout == "canonical":
        return list(POLARISATIONS)
    if layout != "union":
        raise ValueError(f"unknown band layout {layout!r}")
    seen = {r[0] for r in scenes.where(F.col(column).isin(*POLARISATIONS)).select(column).distinct().collect()}
    return [p for p in POLARISATIONS if p in seen]


def cube(grid: DataFrame, names: Sequence[str]) -> DataFrame:
    """A row ``(item_id, y, x)`` with a column of values and of masks for every band: missing ones null and false."""
    wide = grid.groupBy("item_id", "y", "x").pivot("band", list(names)).agg(F.first("value"))
    return wide.select("item_id", "y", "x", *[F.col(b).alias(b.lower()) for b in names], *[F.col(b).isNotNull().alias(f"{b.lower()}_valid") for b in names])


def all_close(left: DataFrame, right: DataFrame, keys: Sequence[str], relative: float, absolute: float) -> DataFrame:
    """Rows of two grids that differ by more than ``absolute + relative * |right|``, or that only one has."""
    joined = left.alias("l").join(right.alias("r"), list(keys), "full")
    near = F.abs(F.col("l.value") - F.col("r.value")) <= absolute + relative * F.abs(F.col("r.value"))
    return joined.where(~F.coalesce(near, F.col("l.value").eqNullSafe(F.col("r.value"))))


def stage_counts(pixels: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What each stage of calibration left of ``pixels(source_valid, noise_power, denoised_power, calibrated_linear)``, by key."""
    return pixels.groupBy(*keys).agg(
        F.count("*").alias("n"), F.count_if("source_valid").alias("source_valid"), F.count_if(F.col("noise_power") > 0).alias("noise_valid"),
        F.count_if(F.col("source_valid") & F.col("denoised_power").isNull()).alias("nonpositive"), F.count_if(F.col("calibrated_linear") > 0).alias("final_valid"),
    )


def validated(grid: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The statistics of each output grid; one without a valid cell is an error."""
    found = finite_summary(grid, keys)
    return found.withColumn("n_finite", F.when(F.col("n_finite") > 0, F.col("n_finite")).otherwise(F.raise_error(F.lit("no valid cells")).cast("long")))
