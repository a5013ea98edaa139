"""Catalogue items with their assets: what each polarisation has, the inspection record of an item, and choices among records.

Items are rows ``(item_id, collection, datetime_utc, start_datetime_utc, end_datetime_utc, platform, constellation, instrument_mode, product_type_field,
deprecated_product_type, orbit_state, relative_orbit, absolute_orbit, declared array<string>, assets map<string, string>)``, where assets
are the hrefs by key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swathline.functions import text

from .catalogue import PLATFORMS, eligibility, normalised
from .inspection import MANIFEST, SCHEMAS, polarisation_warnings

#: The columns of the items' CSV file, and those of them that are lists.  Fixed values.
ITEM_COLUMNS = (
    "item_id datetime_utc end_datetime_utc year platform instrument_mode product_type orbit_state relative_orbit absolute_orbit declared_polarisations available_polarisations "
    "polarisation_combination tile_coverage_fraction tile_coverage_pct scene_overlap_fraction scene_overlap_pct eligible_before_coverage eligibility_rejection_reasons warnings "
    "missing_metadata_assets provisional_acquisition_key"
).split()
ITEM_LISTS = ("declared_polarisations", "available_polarisations", "eligibility_rejection_reasons", "warnings", "missing_metadata_assets")


def href(assets: Column, key: str) -> Column:
    """The href of an asset whose key is ``key`` in any case; blank is null, and of several the last counts."""
    found = F.filter(F.map_entries(assets), lambda e: F.lower(e["key"]) == key)
    return text.blank_to_null(F.try_element_at(found, F.lit(-1))["value"])


def polarisation_assets(assets: Column) -> Column:
    """``array<struct<polarisation, measurement_href, product_href, calibration_href, noise_href, missing>>`` of the known polarisations that have a measurement."""

    def one(name: str) -> Column:
        low = name.lower()
        keys = {schema: f"schema-{schema}-{low}" for schema in SCHEMAS}
        hrefs = {schema: href(assets, key) for schema, key in keys.items()}
        missing = F.array_compact(F.array(*[F.when(hrefs[schema].isNull(), F.lit(key)) for schema, key in keys.items()]))
        parts = F.struct(F.lit(name).alias("polarisation"), href(assets, low).alias("measurement_href"), *[hrefs[schema].alias(f"{schema}_href") for schema in SCHEMAS], missing.alias("missing"))
        return F.when(href(assets, low).isNotNull(), parts)

    return F.array_compact(F.array(*map(one, text.POLARISATIONS)))


def unpivoted(items: DataFrame) -> DataFrame:
    """One row an item and polarisation that it has a measurement of."""
    return items.select("item_id", F.inline(polarisation_assets(F.col("assets"))))


def measurement_assets(parts: Column) -> Column:
    """Measurement hrefs by polarisation, of ``polarisation_assets``."""
    return F.map_from_entries(F.transform(parts, lambda p: F.struct(p["polarisation"], p["measurement_href"])))


def metadata_assets(parts: Column) -> Column:
    """``struct<product, calibration, noise>`` hrefs by polarisation."""
    return F.map_from_entries(F.transform(parts, lambda p: F.struct(p["polarisation"], F.struct(*[p[f"{schema}_href"].alias(schema) for schema in SCHEMAS]))))


def inspection_records(items: DataFrame, coverage: DataFrame, platforms: Sequence[str] | None = PLATFORMS) -> DataFrame:
    """The inspection record of each item, with ``coverage(item_id, area, coverage, overlap, failure)`` joined by id.

    An item whose geometry failed, or that has no row of coverage, has coverage 0 and the failure among its reasons.
    """
    # an array of one: the assets are looked through once, and not again for each field made of them
    rows = items.join(coverage, "item_id", "left").withColumn("parts", F.explode(F.array(polarisation_assets(F.col("assets")))))
    kind = text.product_type(F.col("product_type_field"), F.col("deprecated_product_type"))
    rows = rows.withColumns({"polarisations": F.transform("parts", lambda p: p["polarisation"]), "_kind": kind, "declared": text.polarisations(F.col("declared"))}).withColumn("product_type", F.col("_kind.product_type"))
    failed = F.when(F.col("failure").isNotNull() | F.col("coverage").isNull(), F.concat(F.lit("geometry_processing_failed:"), F.coalesce("failure", F.lit("no coverage"))))
    number = lambda c: F.when(failed.isNull(), F.col(c)).otherwise(0.0)
    found = eligibility(normalised(rows), platforms)
    return found.select(
        "item_id", "collection", text.iso(F.col("datetime_utc")).alias("datetime_utc"), text.iso(F.col("start_datetime_utc")).alias("start_datetime_utc"), text.iso(F.col("end_datetime_utc")).alias("end_datetime_utc"), "year", "platform",
        "constellation", "instrument_mode", "product_type", "orbit_state", "relative_orbit", "absolute_orbit", F.col("declared").alias("declared_polarisations"), F.col("polarisations").alias("available_polarisations"),
        F.col("combination").alias("polarisation_combination"), measurement_assets(F.col("parts")).alias("measurement_assets"), metadata_assets(F.col("parts")).alias("metadata_assets"), F.col("parts").alias("polarisation_assets"),
        href(F.col("assets"), MANIFEST).alias("safe_manifest_href"), F.array_sort(F.array_distinct(F.flatten(F.transform("parts", lambda p: p["missing"])))).alias("missing_metadata_assets"),
        number("area").alias("intersection_area_projected_units"), number("coverage").alias("tile_coverage_fraction"), text.percentage_points(number("coverage")).alias("tile_coverage_pct"), number("overlap").alias("scene_overlap_fraction"),
        text.percentage_points(number("overlap")).alias("scene_overlap_pct"), (F.col("eligible") & failed.isNull()).alias("eligible_before_coverage"), F.when(failed.isNull(), F.col("reasons")).otherwise(F.array_append("reasons", failed)).alias("eligibility_rejection_reasons"),
        F.concat("_kind.warnings", polarisation_warnings(F.col("declared"), F.col("polarisations"))).alias("warnings"), F.col("acquisition_key").alias("provisional_acquisition_key"),
    )


def items_table(records: DataFrame) -> DataFrame:
    """The 22 columns of the items' CSV file, lists as JSON."""
    return records.select(*[F.to_json(c).alias(c) if c in ITEM_LISTS else c for c in ITEM_COLUMNS])


def radiometry_candidates(records: DataFrame, minimum: float, ids: DataFrame | None = None, most: int | None = None) -> DataFrame:
    """Eligible records of enough coverage in the order of ids, at most ``most``."""
    found = records.where(F.col("eligible_before_coverage") & (F.col("tile_coverage_fraction") >= minimum))
    if ids is not None:
        found = found.join(ids, "item_id", "left_semi")
    found = found.orderBy("item_id")
    return found.limit(most) if most else found


def audit_eligible(records: DataFrame) -> DataFrame:
    """Eligible records that have a measurement's href; blank ones don't count."""
    return records.where(F.col("eligible_before_coverage") & F.exists(F.map_values("measurement_assets"), lambda v: text.blank_to_null(v).isNotNull()))


def best_candidate(records: DataFrame, item_id: object = None) -> DataFrame:
    """The record of an id, or of the largest coverage (the least ordinal of equal ones); a null coverage comes last."""
    if item_id is not None:
        return records.where(F.col("item_id") == F.lit(item_id)).orderBy("ordinal").limit(1)
    return records.orderBy(F.desc_nulls_last("tile_coverage_fraction"), "ordinal").limit(1)


def usable_pairs(pairs: DataFrame, scenes: DataFrame, item_id: object = None, polarisation: str | None = None) -> DataFrame:
    """Usable pairs ``(item_id, polarisation, usable)`` with their scene; a scene or a pair that is there more than once is an error.

    A polarisation can be asked for only together with an item.
    """
    if polarisation is not None and item_id is None:
        raise ValueError("a polarisation needs an item")
    wanted = pairs.where("usable")
    for column, value in (("item_id", item_id), ("polarisation", polarisation)):
        wanted = wanted if value is None else wanted.where(F.col(column) == F.lit(value))
    once = lambda rows, *keys: rows.groupBy(*keys).agg(F.count("*").alias("_n"), *[F.first(c).alias(c) for c in rows.columns if c not in keys])
    joined = once(wanted, "item_id", "polarisation").join(once(scenes, "item_id").withColumnRenamed("_n", "_m"), "item_id")
    alone = F.when((F.col("_n") == 1) & (F.col("_m") == 1), F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("not exactly once: "), F.col("item_id").cast("string"))).cast("boolean"))
    return joined.where(alone).drop("_n", "_m")


def tile_matches(matches: DataFrame, most: int) -> DataFrame:
    """Matches by falling coverage, tile and item, of the tiles that were scanned before ``most`` were found.

    ``matches(scan, tile, item_id, coverage)``: a scan ends between tiles, so the last tile's matches are all there.  Tiles are few
    (one row each in the window).
    """
    tiles = matches.groupBy("scan").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("scan").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    reached = tiles.select("scan", before.alias("before")).where(F.col("before") < most)
    return matches.join(F.broadcast(reached), "scan").drop("before").orderBy(F.desc("coverage"), F.desc("tile"), F.desc("item_id"))


def scan(catalogue: DataFrame, collection: str, start: str, end: str, box: tuple[float, float, float, float] | None = None, most: int | None = None) -> DataFrame:
    """Items of a collection between two days (both whole) whose box meets another, by time (null last) and id, at most ``most``.

    The filters are on plain columns, so they reach the scan of a landed catalogue table.
    """
    found = catalogue.where((F.col("collection") == collection) & (F.col("datetime_utc") >= F.lit(start).cast("date")) & (F.col("datetime_utc") < F.date_add(F.lit(end).cast("date"), 1)))
    if box is not None:
        left, low, right, high = box
        found = found.where((F.col("minx") <= right) & (F.col("maxx") >= left) & (F.col("miny") <= high) & (F.col("maxy") >= low))
    found = found.orderBy(F.asc_nulls_last("datetime_utc"), "item_id")
    return found.limit(most) if most else found


def noise_usability(parts: DataFrame, noise: DataFrame) -> DataFrame:
    """Which polarisations can test noise removal: ``parts(item_id, polarisation, corrected, error)`` with ``noise(item_id, polarisation, values)`` joined.

    Usable is a product whose noise wasn't removed, with a positive value in its tables and no error; all others say no, with what is known of them.
    """
    sums = noise.groupBy("item_id", "polarisation").agg(
        F.min(F.array_min("values")).alias("noise_minimum"), F.max(F.array_max("values")).alias("noise_maximum"), F.sum(F.size(F.filter("values", lambda v: v > 0))).cast("long").alias("n_positive")
    )
    joined = parts.join(sums, ["item_id", "polarisation"], "left").withColumn("n_positive", F.coalesce("n_positive", F.lit(0).cast("long")))
    usable = F.col("error").isNull() & F.coalesce(~F.col("corrected"), F.lit(False)) & (F.col("n_positive") > 0) & F.coalesce(F.col("noise_maximum") > 0, F.lit(False))
    return joined.withColumn("usable", usable)
