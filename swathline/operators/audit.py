"""Audits of valid coverage: what each scene's grids cover, alone and together, and what that means at each threshold.

Grids are ``(item_id, band, y, x, fraction, valid)``: the share of a cell that source samples cover, and whether the cell has a value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swathline.functions.text import iso

from .jobs import numbered

#: Grids whose fractions differ by no more are one grid.
SAME = 1e-6
#: The columns of the audit's table for each threshold.  Fixed values.
PASSES = {"geometric_pass": "geometric_pass", "joint_pass": "joint_pass", "any_pass": "any_polarisation_pass", "joint_changed": "geometric_vs_joint_changed"}


def acceptance_metrics(grids: DataFrame, minimum: float) -> DataFrame:
    """``(item_id, band, source_fraction, calibrated_fraction, passed)``; a band passes by what its sources cover and not by what calibration left."""
    found = grids.groupBy("item_id", "band").agg(F.avg("fraction").alias("source_fraction"), F.avg(F.col("valid").cast("int")).alias("calibrated_fraction"))
    return found.withColumn("passed", F.coalesce(F.col("source_fraction") >= minimum, F.lit(False)))


def audit_records(grids: DataFrame, expected: DataFrame) -> DataFrame:
    """One row an item of ``expected(item_id, bands)``: fractions by band, of all and of any band, and whether it is complete.

    Complete is an item with a grid for each band that is expected, and one at least.  The area of the joint grid is known only where all bands'
    grids are the same.  Sums combine by cell and then by item.
    """
    cells = grids.groupBy("item_id", "y", "x").agg(F.min("fraction").alias("low"), F.max("fraction").alias("high"), F.bool_and("valid").alias("every"), F.bool_or("valid").alias("a_few"), F.count("*").alias("n"))
    share = lambda c: F.avg(F.col(c).cast("int"))
    joint = cells.groupBy("item_id").agg((F.max(F.col("high") - F.col("low")) <= SAME).alias("same"), F.avg("high").alias("area"), share("every").alias("joint"), share("a_few").alias("either"), (F.min("n") == F.max("n")).alias("whole"))
    bands = grids.groupBy("item_id", "band").agg(F.avg("fraction").alias("f")).groupBy("item_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("band", "f")))).alias("fractions"))
    rows = expected.join(joint, "item_id", "left").join(bands, "item_id", "left")
    have = F.coalesce(F.map_keys("fractions"), F.array().cast("array<string>"))
    complete = (F.size("bands") > 0) & (F.size(F.array_except("bands", have)) == 0)
    return rows.select("item_id", "bands", "fractions", complete.alias("complete"), F.when(F.col("same") & F.col("whole"), F.col("area")).alias("joint_area"), F.when(complete, F.col("joint")).alias("joint"), F.when(complete, F.col("either")).alias("either"))


def threshold_status(records: DataFrame, thresholds: Sequence[float]) -> DataFrame:
    """``records(item_id, coverage, fractions, joint, either, complete)`` at each threshold; passes are null where an item isn't complete or a fraction is missing."""
    rows = records.select("*", F.explode(F.array(*[F.lit(float(t)) for t in thresholds])).alias("threshold"))
    t = F.col("threshold")
    known = F.col("complete") & (F.coalesce(F.size("fractions"), F.lit(0)) > 0)
    over: Column = F.filter(F.map_values("fractions"), lambda f: f >= t)
    geometric = F.col("coverage") >= t
    every, any_, joint, either = F.when(known, F.size(over) == F.size("fractions")), F.when(known, F.size(over) > 0), F.when(F.col("complete"), F.col("joint") >= t), F.when(F.col("complete"), F.col("either") >= t)
    bands = F.transform_values("fractions", lambda k, f: F.when(F.col("complete"), f >= t))
    return rows.withColumns({"geometric_pass": geometric, "band_pass": bands, "all_pass": every, "any_pass": any_, "joint_pass": joint, "either_pass": either, "joint_changed": geometric != joint, "any_changed": geometric != any_})


def wide(status: DataFrame, thresholds: Sequence[float], keys: Sequence[str] = ("item_id",)) -> DataFrame:
    """One row an item with four columns a threshold, named by it in percent."""
    at = lambda t, c: F.bool_or(F.when(F.col("threshold") == F.lit(float(t)), F.col(c)))
    return status.groupBy(*keys).agg(*[at(t, c).alias(f"{name}_{100 * t:05.2f}") for t in thresholds for c, name in PASSES.items()])


def band_order(accepted: DataFrame, layout: str, known: Sequence[str]) -> list[str]:
    """The bands of an output: all known ones, or those of accepted scenes in the known order.  At most one row a band comes to the driver."""
    if layout not in ("canonical", "union"):
        raise ValueError(f"unknown band layout {layout!r}")
    if layout == "canonical":
        return list(known)
    seen = {r.band for r in accepted.where(F.col("band").isin(*known)).select("band").distinct().collect()}
    return [b for b in known if b in seen]


def cube_attributes(scenes: DataFrame) -> DataFrame:
    """Scene attributes as a cube's arrays hold them: missing text is blank, missing orbits are -1, places in the order of time (null last) and id."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    orbit = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(-1)).alias(c)
    placed = numbered(scenes, F.asc_nulls_last("datetime_utc"), "item_id")
    return placed.select("place", F.col("item_id").cast("string").alias("item_id"), F.coalesce(iso(F.col("datetime_utc")), F.lit("")).alias("time"), text("platform"), text("orbit_state"), orbit("relative_orbit"), orbit("absolute_orbit"))
