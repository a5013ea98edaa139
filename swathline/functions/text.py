"""Column functions over catalogue text: polarisations, tiles, keys, lenient readers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Polarisations in output order.  Fixed values.
POLARISATIONS = ("VV", "VH", "HH", "HV")


def blank_to_null(value: Column) -> Column:
    return F.nullif(F.trim(value), F.lit(""))


def known_order(values: Column) -> Column:
    """Distinct values, the known polarisations first in their order and any others after them by name."""
    known = F.array(*map(F.lit, POLARISATIONS))
    distinct = F.array_distinct(values)
    return F.concat(F.filter(known, lambda p: F.array_contains(distinct, p)), F.array_sort(F.array_except(distinct, known)))


def polarisations(values: Column) -> Column:
    """A list of polarisation names: trimmed, upper case, without blanks, distinct, in known order; null gives an empty list."""
    clean = F.filter(F.transform(values, lambda v: F.upper(F.trim(v))), lambda v: v != "")
    return F.coalesce(known_order(clean), F.array().cast("array<string>"))


def product_type(current: Column, deprecated: Column) -> Column:
    """The product type and its warnings: the current field wins, blank counts as missing."""
    new, old = blank_to_null(F.upper(current)), blank_to_null(F.upper(deprecated))
    warnings = F.array_compact(
        F.array(
            F.when(new.isNotNull() & old.isNotNull() & (new != old), F.lit("product_type_fields_disagree")),
            F.when(new.isNull() & old.isNotNull(), F.lit("using_deprecated_product_type")),
            F.when(new.isNull() & old.isNull(), F.lit("missing_product_type")),
        )
    )
    return F.struct(F.coalesce(new, old).alias("product_type"), warnings.alias("warnings"))


def tile(value: Column) -> Column:
    """A tile name as five characters: trimmed, upper case, a leading T of six dropped; null where that leaves another length."""
    upper = F.upper(F.trim(value))
    bare = F.when((F.length(upper) == 6) & upper.startswith("T"), F.substring(upper, 2, 5)).otherwise(upper)
    return F.when(F.length(bare) == 5, bare)


def tile_zone(name: Column) -> Column:
    return F.substring(name, 1, 2).try_cast("int")


def tile_epsg(name: Column) -> Column:
    """The UTM zone's code: north from band N on."""
    return F.when(F.substring(name, 3, 1) >= "N", 32600).otherwise(32700) + tile_zone(name)


def iso(value: Column) -> Column:
    """A timestamp as ISO text in UTC with ``Z``; a fraction of a second only where there is one."""
    fraction = F.date_format(value, "SSSSSS")
    return F.concat(F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss"), F.when(fraction != "000000", F.concat(F.lit("."), fraction)).otherwise(""), F.lit("Z"))


def acquisition_key(platform: Column, start: Column, end: Column, mode: Column, orbit: Column, polarisations: Column) -> Column:
    """Platform, whole start and end times, mode, absolute orbit and polarisations joined by bars; what is null, blank or orbit 0 is ``missing``."""
    parts = (platform, iso(start), iso(end), mode, F.nullif(orbit, F.lit(0)).cast("string"), F.array_join(polarisations, "+"))
    return F.concat_ws("|", *[F.coalesce(F.nullif(p, F.lit("")), F.lit("missing")) for p in parts])


def missing_or(value: Column) -> Column:
    """A group's name as text, ``missing`` where it is null or empty."""
    return F.coalesce(F.nullif(value.cast("string"), F.lit("")), F.lit("missing"))


def output_key(prefix: str, name: Column, start: str, end: str, lut: str) -> Column:
    folder = F.concat(F.lit(f"{prefix.rstrip('/')}/T"), name, F.lit(f"/{start}_to_{end}/S1_GRD_DB/"))
    return F.concat(folder, F.lit("s1_grd_tile_T"), name, F.lit(f"_{start}_to_{end}_{lut}_db.tfrecord"))


def thresholds(text: str) -> list[float]:
    """Sorted distinct fractions of a comma list; at least one, all within 0 and 1."""
    found = sorted({float(x) for x in text.split(",") if x.strip()})
    if not found or not all(0 <= x <= 1 for x in found):
        raise ValueError(f"fractions between 0 and 1 are needed, not {text!r}")
    return found


def with_threshold(values: list[float], extra: float) -> list[float]:
    """Thresholds with one more, in order, each once."""
    return sorted({*values, extra})


def distance_micros(later: Column, earlier: Column) -> Column:
    """Microseconds between two timestamps without zone."""
    return F.timestamp_diff("MICROSECOND", earlier, later)


def upper_list(values: Column) -> Column:
    """Upper case alone: nothing is trimmed, dropped or sorted; null gives an empty list."""
    return F.coalesce(F.transform(values, F.upper), F.array().cast("array<string>"))


def tile_parts(name: Column) -> Column:
    """``struct<zone int, band, square>`` of a tile name; any other text is an error."""
    good = tile(name)
    checked = F.when(good.rlike("^[0-9]{2}[A-Z]{3}$"), good).otherwise(F.raise_error(F.concat(F.lit("not a tile: "), F.coalesce(name, F.lit("null")))).cast("string"))
    return F.struct(F.substring(checked, 1, 2).cast("int").alias("zone"), F.substring(checked, 3, 1).alias("band"), F.substring(checked, 4, 2).alias("square"))


def report_tile(*candidates: Column, path: Column) -> Column:
    """The first candidate that is a tile with its T, else what stands before the first underscore in the name of the path's folder; null if that is none."""
    folder = F.substring_index(F.regexp_extract(path, "([^/]*)/[^/]*$", 1), "_", 1)
    upper = [F.upper(F.trim(c)) for c in (*candidates, folder)]
    return F.coalesce(*[F.when(c.rlike("^T[0-9]{2}[A-Z]{3}$"), c) for c in upper])


def optional_integer(value: Column) -> Column:
    """Text of a whole number as that number; anything else is null.  Numbers go through ``truncated``."""
    return F.trim(value).try_cast("bigint")


def truncated(value: Column) -> Column:
    """A number without its fraction; null and what isn't finite are null."""
    return F.when(~F.isnan(value.cast("double")), value).try_cast("bigint")


def datetime_or_null(value: Column) -> Column:
    """A time from ISO text with or without ``Z``; null where it is none."""
    return F.try_to_timestamp(F.trim(value))


def nanoseconds(value: Column) -> Column:
    """ISO text as nanoseconds since 1970, as array bundles hold times: all nine digits count, blank is null and any other text is an error."""
    bare = F.regexp_replace(F.trim(value), "Z$", "")
    whole, fraction = F.substring_index(bare, ".", 1), F.regexp_extract(bare, r"\.([0-9]{1,9})$", 1)
    seconds = F.unix_micros(F.to_timestamp(F.replace(whole, F.lit("T"), F.lit(" ")), "yyyy-MM-dd HH:mm:ss")) * 1000
    return F.when(bare != "", seconds + F.rpad(fraction, 9, "0").cast("bigint"))


def vsi_path(href: Column) -> Column:
    """``s3://bucket/key`` as the raster library's path; any other text stays."""
    return F.regexp_replace(href, "^s3://", "/vsis3/")


def href_of(path: Column) -> Column:
    """The reverse of ``vsi_path``."""
    return F.regexp_replace(path, "^/vsis3/", "s3://")


def percentage_points(fraction: Column) -> Column:
    return fraction * 100.0
