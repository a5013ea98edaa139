"""Annotation XML: calibration, noise and product documents, whatever their namespace prefixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swathline.operators.luts import increasing

_VECTOR = "array<struct<line: string, azimuthTime: string, pixel: string, {}>>"
CALIBRATION = "absoluteCalibrationConstant string, calibrationVectorList struct<calibrationVector: " + _VECTOR.format("sigmaNought: string, betaNought: string, gamma: string, dn: string") + ">"
NOISE = (
    "noiseVectorList struct<noiseVector: " + _VECTOR.format("noiseLut: string") + ">, noiseRangeVectorList struct<noiseRangeVector: " + _VECTOR.format("noiseRangeLut: string") + ">, "
    "noiseAzimuthVectorList struct<noiseAzimuthVector: array<struct<firstAzimuthLine: string, firstRangeSample: string, lastAzimuthLine: string, lastRangeSample: string, line: string, noiseAzimuthLut: string>>>"
)
SCALARS = {"productType": "string", "mode": "string", "polarisation": "string", "pixelValue": "string", "numberOfSamples": "bigint", "numberOfLines": "bigint"}


def without_prefixes(document: Column) -> Column:
    """A document whose tags have no namespace prefix, so that names match by their local part."""
    return F.regexp_replace(F.regexp_replace(document, r"(</?)[A-Za-z_][\w.-]*:", "$1"), r"""\sxmlns(:[\w.-]+)?=("[^"]*"|'[^']*')""", "")


def numbers(value: Column, kind: str) -> Column:
    """An array from text separated by white space."""
    return F.transform(F.filter(F.split(F.trim(value), r"\s+"), lambda s: s != ""), lambda s: s.cast(kind))


def _text(document: Column, name: str) -> Column:
    return F.nullif(F.trim(F.xpath_string(document, F.lit(f"//*[local-name()='{name}'][1]"))), F.lit(""))


def calibration(documents: DataFrame, lut: str = "sigmaNought", column: str = "document") -> DataFrame:
    """One row a calibration vector: ``(line, azimuth_time, pixels, lut)`` and the other columns of ``documents``.

    A document that isn't well formed is an error, as is a vector whose samples and values differ in number or whose samples don't increase.
    Rules between vectors (``luts.checked``) need the raster's key.
    """
    if lut not in ("sigmaNought", "betaNought", "gamma", "dn"):
        raise ValueError(f"unknown table {lut!r}")
    found = documents.withColumn("x", F.from_xml(without_prefixes(F.col(column)), CALIBRATION, {"mode": "FAILFAST"})).withColumn("v", F.explode("x.calibrationVectorList.calibrationVector"))
    rest = [c for c in documents.columns if c != column]
    rows = found.select(*rest, F.col("v.line").cast("bigint").alias("line"), F.col("v.azimuthTime").alias("azimuth_time"), numbers(F.col("v.pixel"), "bigint").alias("pixels"), numbers(F.col(f"v.{lut}"), "double").alias("lut"))
    right = (F.size("pixels") == F.size("lut")) & increasing(F.col("pixels"))
    return rows.withColumn("lut", F.when(right, F.col("lut")).otherwise(F.raise_error(F.lit("a calibration vector's samples do not fit its values")).cast("array<double>")))


def noise(documents: DataFrame, column: str = "document") -> DataFrame:
    """Legacy vectors, or range vectors and azimuth sections, as nullable arrays, and the format's name.

    Both formats at once, and azimuth without range, are errors.
    """
    x = F.from_xml(without_prefixes(F.col(column)), NOISE, {"mode": "FAILFAST"})
    found = documents.withColumn("x", x).withColumns({"legacy": F.col("x.noiseVectorList.noiseVector"), "ranged": F.col("x.noiseRangeVectorList.noiseRangeVector"), "azimuth": F.col("x.noiseAzimuthVectorList.noiseAzimuthVector")})
    name = (
        F.when(F.col("legacy").isNotNull() & (F.col("ranged").isNotNull() | F.col("azimuth").isNotNull()), F.raise_error(F.lit("legacy and range noise in one document")).cast("string"))
        .when(F.col("azimuth").isNotNull() & F.col("ranged").isNull(), F.raise_error(F.lit("azimuth noise without range noise")).cast("string"))
        .when(F.col("legacy").isNotNull(), "legacy_noise_vector")
        .when(F.col("ranged").isNotNull(), "range_azimuth_vectors")
        .otherwise("none")
    )
    return found.withColumn("format_name", name).drop("x", column)


def product(documents: DataFrame, column: str = "document") -> DataFrame:
    """The product's scalars; what is absent or blank is null."""
    flag = F.lower(_text(F.col(column), "thermalNoiseCorrectionPerformed"))
    truth = F.when(flag == "true", True).when(flag == "false", False).when(flag.isNotNull(), F.raise_error(F.lit("not a boolean")).cast("boolean"))
    fields = [_text(F.col(column), n).cast(kind).alias(n) for n, kind in SCALARS.items()]
    return documents.select(*[c for c in documents.columns if c != column], *fields, truth.alias("thermalNoiseCorrectionPerformed"))


def consistent(product_rows: DataFrame, other: DataFrame, keys: list[str], fields: tuple[str, ...] = ("polarisation", "productType", "mode")) -> DataFrame:
    """Keys whose documents disagree in a field that both have."""
    joined = product_rows.alias("a").join(other.alias("b"), keys)
    wrong = [F.when(F.col(f"a.{f}") != F.col(f"b.{f}"), F.lit(f)) for f in fields]
    return joined.select(*keys, F.array_compact(F.array(*wrong)).alias("disagree")).where(F.size("disagree") > 0)
