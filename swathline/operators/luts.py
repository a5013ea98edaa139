"""Sparse calibration and noise tables, interpolated in the sample direction and then in the line direction.

Vectors are rows ``(line, pixels array<bigint>, lut array<double>)`` of one raster (plus key columns ``by``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .jobs import numbered


def increasing(values: Column) -> Column:
    """Whether an array is strictly increasing."""
    n = F.size(values)
    pairs = F.zip_with(F.slice(values, 2, F.greatest(n - 1, F.lit(0))), F.slice(values, 1, F.greatest(n - 1, F.lit(0))), lambda b, a: b > a)
    return F.forall(pairs, lambda ok: ok)


def faults(vectors: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Vectors that break a rule: equal lengths, increasing samples and lines, two vectors at least."""
    order = Window.partitionBy(*by).orderBy("line")
    alone = F.count("*").over(Window.partitionBy(*by)) < 2
    reason = (
        F.when(F.size("pixels") != F.size("lut"), "lengths differ")
        .when(~increasing(F.col("pixels")), "samples do not increase")
        .when(F.lag("line").over(order) == F.col("line"), "lines do not increase")
        .when(alone, "a single vector cannot be interpolated")
    )
    return vectors.withColumn("reason", reason).where("reason IS NOT NULL")


def checked(vectors: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``vectors``, where a broken rule is an error."""
    wrong = faults(vectors, by).agg(F.min("reason").alias("reason"))
    stop = F.when(F.col("reason").isNotNull(), F.raise_error(F.col("reason")).cast("boolean"))
    return vectors.crossJoin(F.broadcast(wrong.select(stop.alias("_stop")))).where("_stop IS NULL").drop("_stop")


def window(vectors: DataFrame, rows: tuple[int, int], samples: tuple[int, int], by: Sequence[str] = ()) -> DataFrame:
    """``(row, values)`` for the rows and samples ``[start, stop)`` of each raster; vectors that don't cover them are an error, as nothing is extrapolated."""
    reach = vectors.groupBy(*by).agg(F.min("line").alias("top"), F.max("line").alias("bottom"), F.max(F.get("pixels", F.lit(0))).alias("left"), F.min(F.element_at("pixels", -1)).alias("right"))
    covered = (F.col("top") <= rows[0]) & (F.col("bottom") >= rows[1] - 1) & (F.col("left") <= samples[0]) & (F.col("right") >= samples[1] - 1)
    reach = reach.select(*by, F.when(~covered, F.raise_error(F.lit("the vectors do not cover the window")).cast("boolean")).alias("_stop"))
    bounded = vectors.join(F.broadcast(reach), list(by)) if by else vectors.crossJoin(F.broadcast(reach))
    found = interpolated(bounded.where("_stop IS NULL").drop("_stop"), samples[1], by)
    return found.where((F.col("row") >= rows[0]) & (F.col("row") < rows[1])).withColumn("values", F.slice("values", samples[0] + 1, samples[1] - samples[0]))


def knots(vectors: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Segments between neighbouring samples of each vector."""
    rows = vectors.select(*by, "line", F.posexplode(F.arrays_zip("pixels", "lut")).alias("at", "k"), "pixels", "lut")
    nxt = F.col("at") + 1
    rows = rows.where(nxt < F.size("pixels"))
    return rows.select(*by, "line", F.col("k.pixels").alias("p0"), F.col("k.lut").alias("v0"), F.get("pixels", nxt).alias("p1"), F.get("lut", nxt).alias("v1"))


def lerp(lo: Column, hi: Column, weight: Column) -> Column:
    return lo + (hi - lo) * weight


def across(vectors: DataFrame, samples: int, by: Sequence[str] = ()) -> DataFrame:
    """Each vector at every sample from 0 to ``samples - 1``, as ``(line, values array<double>)``.

    Array functions only: the knots of a vector are few, and no row leaves its task.  Samples outside the knots are null.
    """
    last = F.size("pixels") - 1

    def value(x: Column) -> Column:
        # the segment that holds x; the last knot belongs to the last segment
        at = F.greatest(F.lit(0), F.least(last - 1, F.size(F.filter("pixels", lambda p: p <= x)) - 1))
        p0, p1 = F.get("pixels", at), F.get("pixels", at + 1)
        inside = (x >= F.get("pixels", F.lit(0))) & (x <= F.get("pixels", last))
        return F.when(inside, lerp(F.get("lut", at), F.get("lut", at + 1), (x - p0).cast("double") / (p1 - p0)))

    return vectors.select(*by, "line", F.transform(F.sequence(F.lit(0), F.lit(samples - 1)), value).alias("values"))


def segments(vectors: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Neighbouring lines ``(line, values, line1, values1, last)``."""
    order = Window.partitionBy(*by).orderBy("line")
    rows = vectors.withColumns({"line1": F.lead("line").over(order), "values1": F.lead("values").over(order), "after": F.lead("line", 2).over(order)})
    return rows.where("line1 IS NOT NULL").withColumn("last", F.col("after").isNull()).drop("after")


def down(vectors: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Every line between the first and the last vector, as ``(row, values array<double>)``: each segment generates its own lines.

    No range join is needed, as the lines a segment covers follow from its ends; the last line belongs to the last segment.
    """
    end = F.when(F.col("last"), F.col("line1")).otherwise(F.col("line1") - 1)
    rows = segments(vectors, by).withColumn("row", F.explode(F.sequence("line", end)))
    weight = (F.col("row") - F.col("line")).cast("double") / (F.col("line1") - F.col("line"))
    return rows.select(*by, "row", F.zip_with("values", "values1", lambda a, b: lerp(a, b, weight)).alias("values"))


def interpolated(vectors: DataFrame, samples: int, by: Sequence[str] = ()) -> DataFrame:
    return down(across(vectors, samples, by), by)


def azimuth(sections: DataFrame, rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Azimuth noise by row from ``sections(first_line, last_line, first_sample, last_sample, lines, lut)``.

    ``(row, first_sample, last_sample, value)``: each row's sections with the noise interpolated along lines.  Sections are few
    a raster, so rows meet them by a join on the raster and a range of rows.
    """
    joined = rows.join(F.broadcast(sections), list(by)) if by else rows.join(F.broadcast(sections), (F.col("row") >= F.col("first_line")) & (F.col("row") <= F.col("last_line")))
    inside = joined.where((F.col("row") >= F.col("first_line")) & (F.col("row") <= F.col("last_line")))
    last = F.size("lines") - 1
    at = F.greatest(F.lit(0), F.least(last - 1, F.size(F.filter("lines", lambda p: p <= F.col("row"))) - 1))
    lo, hi = F.get("lines", at), F.get("lines", at + 1)
    weight = F.when(hi > lo, (F.col("row") - lo).cast("double") / (hi - lo)).otherwise(0.0)
    covered = (F.col("row") >= F.get("lines", F.lit(0))) & (F.col("row") <= F.get("lines", last))
    return inside.select(*by, "row", "first_sample", "last_sample", F.when(covered, lerp(F.get("lut", at), F.coalesce(F.get("lut", at + 1), F.get("lut", at)), weight)).alias("value"))


def azimuth_lines(sections: DataFrame, rows: tuple[int, int], samples: tuple[int, int], by: Sequence[str] = ()) -> DataFrame:
    """``(row, values)``: the azimuth noise of each row over the samples ``[start, stop)``.

    Sections may overlap where they agree (to one part in a million); a sample that none covers, and one where they conflict, is an error.
    """
    spread = sections.sparkSession.range(*rows).withColumnRenamed("id", "row")
    if by:
        spread = sections.select(*by).distinct().crossJoin(F.broadcast(spread))
    parts = azimuth(sections, spread, by).where((F.col("first_sample") < samples[1]) & (F.col("last_sample") >= samples[0]) & F.col("value").isNotNull())
    each = spread.join(parts.groupBy(*by, "row").agg(F.collect_list(F.struct("first_sample", "last_sample", "value")).alias("parts")), [*by, "row"], "left")

    def at(sample: Column) -> Column:
        here = F.transform(F.filter("parts", lambda p: (p["first_sample"] <= sample) & (p["last_sample"] >= sample)), lambda p: p["value"])
        low, high = F.array_min(here), F.array_max(here)
        fault = lambda why: F.raise_error(F.lit(why)).cast("double")
        return F.when(low.isNull(), fault("no azimuth section covers a sample")).when(high - low > 1e-6 * F.abs(high), fault("azimuth sections conflict")).otherwise(low)

    return each.select(*by, "row", F.transform(F.sequence(F.lit(samples[0]), F.lit(samples[1] - 1)), at).alias("values"))


def noise_anchors(noise: DataFrame, height: int, width: int, window: int) -> DataFrame:
    """Places of positive noise ``(line, pixel, noise)`` with their ``rank`` from 0: whole windows, nearness to the centre, more noise."""
    half = window // 2
    inside = noise.where((F.col("noise") > 0) & F.col("line").between(0, height - 1) & F.col("pixel").between(0, width - 1))
    best = inside.groupBy("line", "pixel").agg(F.max("noise").alias("noise"))
    interior = F.col("line").between(half, height - half - 1) & F.col("pixel").between(half, width - half - 1)
    distance = F.pow(F.col("line") - (height - 1) / 2, 2) + F.pow(F.col("pixel") - (width - 1) / 2, 2)
    return numbered(best.withColumns({"interior": interior, "distance": distance}), F.desc("interior"), F.asc("distance"), F.desc("noise"), "line", "pixel", name="rank")
