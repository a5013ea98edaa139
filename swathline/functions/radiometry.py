"""Radiometric math on columns: each step in double precision, rounded to float, invalid values null.

Arrays at a sink write NaN for null; within the engine null keeps comparisons two-valued and sums clean.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NOISE_POLICIES = ("error", "assume_uncorrected", "assume_corrected")
NONPOSITIVE_POLICIES = ("nan", "floor")
CALIBRATION_LUTS = ("sigmaNought", "betaNought", "gamma", "dn")


def finite(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))


def single(value: Column) -> Column:
    return value.cast("float")


def source_valid(value: Column, mask: Column, nodata: Column) -> Column:
    """A sample counts if its mask is set, it is finite and it isn't the no-data value."""
    return F.coalesce(mask & finite(value) & (value.cast("float") != nodata.cast("float")), F.lit(False))


def power(magnitude: Column) -> Column:
    return single(magnitude.cast("double") * magnitude.cast("double"))


def noise(legacy: Column, ranged: Column, azimuth: Column) -> Column:
    """One noise value: the legacy table, or range times azimuth.

    Both kinds at once, range without azimuth, azimuth without range, none at all, and a value that is negative or not finite are errors.
    """
    fault = lambda why: F.raise_error(F.lit(why)).cast("double")
    value = (
        F.when(legacy.isNotNull() & (ranged.isNotNull() | azimuth.isNotNull()), fault("legacy noise excludes range and azimuth noise"))
        .when(legacy.isNotNull(), legacy.cast("double"))
        .when(ranged.isNull() | azimuth.isNull(), fault("noise needs a legacy value, or range and azimuth values"))
        .otherwise(ranged.cast("double") * azimuth.cast("double"))
    )
    return single(F.when(finite(value) & (value >= 0), value).otherwise(fault("noise is negative or not finite")))


def subtracts_noise(corrected: Column, policy: str) -> Column:
    """Whether noise is still to be taken off, from the product's flag; ``policy`` decides where the flag is null."""
    if policy not in NOISE_POLICIES:
        raise ValueError(f"unknown noise policy {policy!r}")
    unknown = F.raise_error(F.lit("thermal noise correction is unknown")).cast("boolean") if policy == "error" else F.lit(policy == "assume_uncorrected")
    return F.when(corrected.isNotNull(), ~corrected).otherwise(unknown)


def denoised(source: Column, noise_power: Column, valid: Column, subtract: Column, nonpositive: str = "nan", floor: float = 1e-5) -> Column:
    """Power less noise.  A noise of zero is no estimate, so the sample is invalid; what isn't positive is null or the floor."""
    if nonpositive not in NONPOSITIVE_POLICIES:
        raise ValueError(f"unknown policy {nonpositive!r}")
    domain = valid & finite(source) & F.when(subtract, finite(noise_power) & (noise_power > 0)).otherwise(True)
    left = single(source.cast("double") - F.when(subtract, noise_power.cast("double")).otherwise(0.0))
    low = F.lit(None).cast("float") if nonpositive == "nan" else single(F.lit(floor))
    return F.when(domain, F.when(left > 0, left).otherwise(low))


def calibrated(source: Column, lut: Column) -> Column:
    """Power over the squared calibration value, where that is positive."""
    wide = lut.cast("double")
    return F.when(finite(source) & (wide > 0), single(source.cast("double") / F.nullif(wide * wide, F.lit(0.0))))


def decibels(linear: Column) -> Column:
    return F.when(finite(linear) & (linear > 0), single(10.0 * F.log10(linear.cast("double"))))


def chain(magnitude: Column, valid: Column, lut: Column, noise_power: Column, corrected: Column, policy: str = "error", nonpositive: str = "nan") -> dict[str, Column]:
    """All stages of a detected magnitude, by name; ``valid`` is the final mask."""
    source = power(magnitude)
    left = denoised(source, noise_power, valid, subtracts_noise(corrected, policy), nonpositive)
    linear = calibrated(left, lut)
    return {"source_power": source, "denoised_power": left, "calibrated_linear": linear, "calibrated_db": decibels(linear), "valid": F.coalesce(linear > 0, F.lit(False))}
