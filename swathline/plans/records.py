"""Registered queries of items, audits, windows of tables and lenient readers, and their SQL."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from swathline.functions import radiometry, text
from swathline.operators import audit, catalogue, items, luts, raster
from swathline.operators.jobs import numbered
from swathline.sources import records as record_files

from . import adapters
from .adapters import SCENE_SQL, coverages, iso_sql, scenes, table
from .queries import _BANDS, _CHAIN, _GRID, _SCENES, THRESHOLDS, _calibrated, _eligible, _grid, _two_bands, query

_KNOWN = "(VALUES ('VV', 1), ('VH', 2), ('HH', 3), ('HV', 4)) k(p, o)"
_ASSETS = f"""
WITH raw AS ({SCENE_SQL}), e AS (SELECT *, list_filter(string_split(pols, ','), lambda x: x <> '') AS l FROM raw),
pa AS (SELECT item_id, p AS polarisation, 'm/' || item_id || '/' || lower(p) AS measurement_href, 'product/' || item_id || '/' || lower(p) AS product_href,
  CASE WHEN item_id % 3 <> 0 THEN 'calibration/' || item_id || '/' || lower(p) END AS calibration_href, CASE WHEN item_id % 7 <> 0 THEN 'noise/' || item_id || '/' || lower(p) END AS noise_href, o
  FROM e, {_KNOWN} WHERE list_contains(l, p) AND NOT (item_id % 5 = 0 AND p = 'VV'))"""


@query(
    f"""{_ASSETS} SELECT item_id, polarisation, measurement_href, product_href, calibration_href, noise_href,
concat_ws(',', CASE WHEN calibration_href IS NULL THEN 'schema-calibration-' || lower(polarisation) END, CASE WHEN noise_href IS NULL THEN 'schema-noise-' || lower(polarisation) END) AS missing FROM pa"""
)
def polarisation_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return items.unpivoted(adapters.items(spark, sf_dir)).withColumn("missing", F.array_join("missing", ","))


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return items.inspection_records(adapters.items(spark, sf_dir), coverages(spark, sf_dir))


_RECORDS = f"""{_ASSETS},
av AS (SELECT item_id, string_agg(polarisation, '+' ORDER BY o) AS a, string_agg(polarisation, ',' ORDER BY polarisation) AS sorted FROM pa GROUP BY item_id),
ms AS (SELECT item_id, string_agg(x, ',' ORDER BY x) AS missing FROM (SELECT item_id, 'schema-calibration-' || lower(polarisation) AS x FROM pa WHERE calibration_href IS NULL UNION ALL
  SELECT item_id, 'schema-noise-' || lower(polarisation) FROM pa WHERE noise_href IS NULL) GROUP BY item_id),
t AS (SELECT *, CASE WHEN item_id % 6 = 0 THEN NULL ELSE product_type END AS new, CASE WHEN item_id % 12 <> 0 THEN product_type END AS old FROM e LEFT JOIN av USING (item_id) LEFT JOIN ms USING (item_id)),
r AS (SELECT *, coalesce(new, old) AS kind, item_id % 31 = 0 AS broken, CASE WHEN item_id % 31 = 0 THEN 0 ELSE coverage END AS c FROM t),
rec AS (SELECT item_id, {iso_sql('datetime_utc')} AS datetime_utc, CAST(year(datetime_utc) AS INT) AS year, kind AS product_type, coalesce(a, 'NONE') AS polarisation_combination, coalesce(missing, '') AS missing_metadata_assets,
  CASE WHEN item_id % 4 <> 0 THEN 's/' || item_id || '/x' END AS safe_manifest_href, c AS tile_coverage_fraction, c * 100 AS tile_coverage_pct, CASE WHEN broken THEN 0 ELSE coverage * 400 END AS intersection_area_projected_units,
  CASE WHEN broken THEN 0 ELSE coverage / 2 END AS scene_overlap_fraction,
  concat_ws(',', CASE WHEN instrument_mode <> 'IW' THEN 'instrument_mode_is_EW' END, CASE WHEN platform IS NULL OR platform NOT IN ('sentinel-1a', 'sentinel-1b') THEN 'platform_is_' || coalesce(platform, 'missing') END,
    CASE WHEN kind IS NULL OR kind <> 'GRD' THEN 'product_type_is_' || coalesce(kind, 'missing') END, CASE WHEN a IS NULL THEN 'no_supported_measurement_assets' END,
    CASE WHEN broken THEN 'geometry_processing_failed:ValueError:bad ring' END) AS reasons,
  concat_ws(' ', CASE WHEN new IS NULL AND old IS NOT NULL THEN 'using_deprecated_product_type' WHEN new IS NULL THEN 'missing_product_type' END,
    CASE WHEN item_id % 5 = 0 AND list_contains(l, 'VV') THEN 'declared_polarisations_without_measurement_assets:VV' END) AS warnings,
  concat_ws('|', coalesce(platform, 'missing'), coalesce({iso_sql('datetime_utc')}, 'missing'), coalesce({iso_sql('end_datetime_utc')}, 'missing'), instrument_mode,
    CASE WHEN absolute_orbit = 0 THEN 'missing' ELSE CAST(absolute_orbit AS VARCHAR) END, coalesce(a, 'missing')) AS key FROM r)"""


@query(
    f"""{_RECORDS} SELECT item_id, datetime_utc, year, product_type, polarisation_combination, missing_metadata_assets, safe_manifest_href, CAST(tile_coverage_fraction AS DOUBLE) AS tile_coverage_fraction,
round(tile_coverage_pct, 9) AS tile_coverage_pct, round(intersection_area_projected_units, 9) AS intersection_area_projected_units, CAST(scene_overlap_fraction AS DOUBLE) AS scene_overlap_fraction,
reasons = '' AS eligible_before_coverage, reasons AS eligibility_rejection_reasons, warnings, key AS provisional_acquisition_key FROM rec"""
)
def inspection_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _records(spark, sf_dir)
    joined = {c: F.array_join(c, sign) for c, sign in (("missing_metadata_assets", ","), ("eligibility_rejection_reasons", ","), ("warnings", " "))}
    rounded = {c: F.round(c, 9) for c in ("tile_coverage_pct", "intersection_area_projected_units")}
    return found.withColumns(joined | rounded).select(
        "item_id", "datetime_utc", "year", "product_type", "polarisation_combination", "missing_metadata_assets", "safe_manifest_href", "tile_coverage_fraction", "tile_coverage_pct", "intersection_area_projected_units",
        "scene_overlap_fraction", "eligible_before_coverage", "eligibility_rejection_reasons", "warnings", "provisional_acquisition_key",
    )


@query(f"{_RECORDS} SELECT item_id FROM rec WHERE reasons = '' AND tile_coverage_fraction >= 0.8 ORDER BY item_id")
def radiometry_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return items.radiometry_candidates(_records(spark, sf_dir), 0.8).select("item_id")


@query(f"{_RECORDS} SELECT item_id FROM rec WHERE reasons = ''")
def audit_eligible(spark: SparkSession, sf_dir: str) -> DataFrame:
    return items.audit_eligible(_records(spark, sf_dir)).select("item_id")


@query(f"{_RECORDS} SELECT item_id, CAST(tile_coverage_fraction AS DOUBLE) AS tile_coverage_fraction FROM rec WHERE reasons = '' ORDER BY tile_coverage_fraction DESC, item_id LIMIT 1")
def best_candidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = items.audit_eligible(_records(spark, sf_dir)).withColumn("ordinal", F.col("item_id"))
    return items.best_candidate(found).select("item_id", "tile_coverage_fraction")


@query(f"{_ASSETS} SELECT item_id, polarisation, orbit_state FROM pa JOIN e USING (item_id) WHERE calibration_href IS NOT NULL AND noise_href IS NOT NULL")
def usable_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = items.unpivoted(adapters.items(spark, sf_dir)).select("item_id", "polarisation", (F.size("missing") == 0).alias("usable"))
    return items.usable_pairs(pairs, scenes(spark, sf_dir).select("item_id", "orbit_state")).select("item_id", "polarisation", "orbit_state")


_MATCHES = f"WITH raw AS ({SCENE_SQL}), m AS (SELECT item_id % 40 AS scan, 'T' || (item_id % 40) AS tile, item_id, coverage FROM raw WHERE coverage >= 0.9), s AS (SELECT scan, sum(count(*)) OVER (ORDER BY scan) - count(*) AS before FROM m GROUP BY scan)"


@query(f"{_MATCHES} SELECT scan, tile, item_id, coverage FROM m JOIN s USING (scan) WHERE before < 20")
def tile_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scenes(spark, sf_dir).where("coverage >= 0.9").select((F.col("item_id") % 40).alias("scan"), F.concat(F.lit("T"), (F.col("item_id") % 40).cast("string")).alias("tile"), "item_id", "coverage")
    return items.tile_matches(rows, 20)


_GAP = "u AS (SELECT threshold, acquisition_key, min(datetime_utc) AS d FROM g JOIN t ON coverage >= threshold GROUP BY ALL), w AS (SELECT threshold, (epoch_us(d) - epoch_us(lag(d) OVER (PARTITION BY threshold ORDER BY d))) / 86400e6 AS gap FROM u)"
_MAPS = {"year": "coalesce(CAST(year(datetime_utc) AS VARCHAR), 'missing')", "platform": "platform", "orbit_state": "orbit_state", "relative_orbit": "CAST(relative_orbit AS VARCHAR)", "polarisation_combination": "combination"}
_MAP_SQL = ", ".join(
    f"coalesce((SELECT '{{' || string_agg('\"' || v || '\":' || n, ',' ORDER BY v) || '}}' FROM (SELECT {e} AS v, count(*) AS n FROM g WHERE coverage >= t.threshold GROUP BY 1)), '{{}}') AS counts_by_{k}" for k, e in _MAPS.items()
)


@query(
    f"""{_SCENES}, {_GAP}, gaps AS (SELECT threshold, round(min(gap), 9) AS minimum_gap_days, round(median(gap), 9) AS median_gap_days, round(avg(gap), 9) AS mean_gap_days, round(max(gap), 9) AS maximum_gap_days FROM w GROUP BY threshold),
s AS (SELECT threshold, count(item_id) AS n, count(DISTINCT acquisition_key) AS k, {iso_sql('min(datetime_utc)')} AS first_datetime_utc, {iso_sql('max(datetime_utc)')} AS last_datetime_utc,
  '{{' || concat_ws(',', {', '.join(f"'\"{p}\":' || count(*) FILTER (list_contains(l, '{p}'))" for p in ('HH', 'HV', 'VH', 'VV'))}) || '}}' AS counts_by_polarisation FROM t LEFT JOIN g ON coverage >= threshold GROUP BY threshold)
SELECT t.threshold AS threshold_fraction, t.threshold * 100 AS threshold_pct, n AS retained_stac_item_count, k AS retained_provisional_acquisition_count, n / CAST((SELECT count(*) FROM g) AS DOUBLE) AS retained_fraction_of_eligible_items,
first_datetime_utc, last_datetime_utc, minimum_gap_days, median_gap_days, mean_gap_days, maximum_gap_days, {_MAP_SQL}, counts_by_polarisation FROM t JOIN s USING (threshold) LEFT JOIN gaps USING (threshold)"""
)
def threshold_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = catalogue.threshold_table(_eligible(spark, sf_dir), THRESHOLDS)
    return found.withColumns({c: F.round(c, 9) for c in found.columns if c.endswith("_gap_days")})


_AUDIT = f"""{_BANDS}, full_ AS (SELECT item_id, band, y, x, fraction, valid FROM (SELECT t.*, g.fraction FROM two t JOIN grid g ON g.item_id = 2 * t.item_id + (t.band = 'VH')::INT AND g.y = t.y AND g.x = t.x)),
bf AS (SELECT item_id, band, avg(fraction) AS f, avg(valid::INT) AS v FROM full_ GROUP BY ALL),
cells AS (SELECT item_id, y, x, max(fraction) AS hi, min(fraction) AS lo, bool_and(valid) AS every, bool_or(valid) AS few FROM full_ GROUP BY ALL),
j AS (SELECT item_id, max(hi - lo) <= 1e-6 AS same, avg(hi) AS area, avg(every::INT) AS joint, avg(few::INT) AS either FROM cells GROUP BY item_id),
ex AS (SELECT item_id, max(CASE WHEN band = 'VV' THEN f END) AS vv, max(CASE WHEN band = 'VH' THEN f END) AS vh FROM bf GROUP BY item_id),
au AS (SELECT item_id, vv, vh, vv IS NOT NULL AND vh IS NOT NULL AND item_id % 9 <> 0 AS complete, CASE WHEN same THEN area END AS joint_area, joint, either, CAST(item_id % 101 AS DOUBLE) / 100 AS coverage FROM ex JOIN j USING (item_id))"""


def _grids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _two_bands(spark, sf_dir, "fraction")


@query(f"{_AUDIT} SELECT item_id, band, round(f, 9) AS source_fraction, round(v, 9) AS calibrated_fraction, f >= 0.8725 AS passed FROM bf")
def acceptance_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = audit.acceptance_metrics(_grids(spark, sf_dir), 0.8725)
    return found.withColumns({c: F.round(c, 9) for c in ("source_fraction", "calibrated_fraction")})


def _audited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audits in which every ninth item should have had a third band."""
    grids = _grids(spark, sf_dir)
    both = F.array(F.lit("VV"), F.lit("VH"))
    expected = grids.select("item_id").distinct().select("item_id", F.when(F.col("item_id") % 9 == 0, F.array_append(both, "HH")).otherwise(both).alias("bands"))
    return audit.audit_records(grids, expected).withColumn("coverage", (F.col("item_id") % 101).cast("double") / 100)


@query(f"{_AUDIT} SELECT item_id, complete, round(vv, 9) AS vv, round(vh, 9) AS vh, round(joint_area, 9) AS joint_area, CASE WHEN complete THEN round(joint, 9) END AS joint, CASE WHEN complete THEN round(either, 9) END AS either FROM au")
def audit_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _audited(spark, sf_dir)
    band = lambda b: F.round(F.try_element_at("fractions", F.lit(b)), 9).alias(b.lower())
    return found.select("item_id", "complete", band("VV"), band("VH"), *[F.round(c, 9).alias(c) for c in ("joint_area", "joint", "either")])


#: Away from values that grids often have, which rounding could put on either side.
_AT = (0.4725, 0.8725)


@query(
    f"""{_AUDIT}, at_ AS (SELECT * FROM au, (VALUES {', '.join(f'({t}::DOUBLE)' for t in _AT)}) h(threshold)),
b AS (SELECT item_id, threshold, coverage >= threshold AS geometric_pass, CASE WHEN complete THEN coalesce(vv >= threshold, true) AND coalesce(vh >= threshold, true) END AS all_pass,
  CASE WHEN complete THEN coalesce(vv >= threshold, false) OR coalesce(vh >= threshold, false) END AS any_pass, CASE WHEN complete THEN joint >= threshold END AS joint_pass, CASE WHEN complete THEN either >= threshold END AS either_pass FROM at_)
SELECT *, geometric_pass <> joint_pass AS joint_changed, geometric_pass <> any_pass AS any_changed FROM b"""
)
def audit_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = audit.threshold_status(_audited(spark, sf_dir), _AT)
    return found.select("item_id", "threshold", "geometric_pass", "all_pass", "any_pass", "joint_pass", "either_pass", "joint_changed", "any_changed")


@query(
    f"""{_AUDIT} SELECT item_id, {', '.join(f'''coverage >= {t} AS "geometric_pass_{100 * t:05.2f}", CASE WHEN complete THEN joint >= {t} END AS "joint_pass_{100 * t:05.2f}",
CASE WHEN complete THEN coalesce(vv >= {t}, false) OR coalesce(vh >= {t}, false) END AS "any_polarisation_pass_{100 * t:05.2f}", CASE WHEN complete THEN (coverage >= {t}) <> (joint >= {t}) END AS "geometric_vs_joint_changed_{100 * t:05.2f}"''' for t in _AT)} FROM au"""
)
def audit_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.wide(audit.threshold_status(_audited(spark, sf_dir), _AT), _AT)


@query(
    f"""{_SCENES} SELECT row_number() OVER (ORDER BY datetime_utc NULLS LAST, item_id) - 1 AS place, CAST(item_id AS VARCHAR) AS item_id, coalesce({iso_sql('datetime_utc')}, '') AS time, coalesce(platform, '') AS platform, orbit_state,
relative_orbit, CASE WHEN absolute_orbit = 0 THEN -1 ELSE absolute_orbit END AS absolute_orbit FROM e"""
)
def cube_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.cube_attributes(scenes(spark, sf_dir).withColumn("absolute_orbit", F.nullif(F.col("absolute_orbit"), F.lit(0))))


@query(f"WITH {adapters.lut_sql('200')} SELECT row, col, round(lut, 9) AS lut FROM lut WHERE row BETWEEN 37 AND 150 AND col BETWEEN 5 AND 58")
def lut_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calibration values of a window of rows 37 to 150 and samples 5 to 58 of a raster of 200 rows."""
    rows = luts.window(luts.checked(adapters.vectors(spark, 200)), (37, 151), (5, 59))
    return rows.select("row", F.posexplode("values").alias("place", "lut")).select("row", (F.col("place") + 5).cast("long").alias("col"), F.round("lut", 9).alias("lut"))


@query(
    """WITH s AS (SELECT i * 16 AS a, i * 16 + 15 AS b, i FROM range(0, 4) t(i)), r AS (SELECT unnest(range(0, 50)) AS row)
SELECT row, c AS col, round(1 + i + (row / 49.0) * 2, 9) AS noise FROM r, s, range(0, 64) y(c) WHERE c BETWEEN a AND b"""
)
def azimuth_noise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Azimuth noise of 50 rows from four sections side by side; the last one is there twice, which agrees with itself."""
    i = F.col("id")
    section = spark.range(4).select((i * 16).alias("first_sample"), (i * 16 + 15).alias("last_sample"), F.lit(0).cast("long").alias("first_line"), F.lit(49).cast("long").alias("last_line"), F.array(F.lit(0), F.lit(49)).cast("array<bigint>").alias("lines"), F.array(1.0 + i, 3.0 + i).alias("lut"))
    rows = luts.azimuth_lines(section.union(section.where("first_sample = 48")), (0, 50), (0, 64))
    return rows.select("row", F.posexplode("values").alias("col", "noise")).select("row", F.col("col").cast("long").alias("col"), F.round("noise", 9).alias("noise"))


@query(
    """WITH p AS (SELECT l_orderkey AS k, l_linenumber AS n, CAST(l_quantity AS DOUBLE) AS m, CASE l_orderkey % 3 WHEN 0 THEN true WHEN 1 THEN false END AS flag FROM lineitem),
q AS (SELECT k, n, m, flag, policy, CASE WHEN flag IS NOT NULL THEN NOT flag ELSE policy = 'assume_uncorrected' END AS off, CASE WHEN k % 2 = 0 THEN 30.0 ELSE 4.0 * n END AS noise FROM p, (VALUES ('assume_uncorrected'), ('assume_corrected')) v(policy))
SELECT policy, count(*) AS n, count(*) FILTER (off) AS n_subtracted, count(*) FILTER (m * m - CASE WHEN off THEN noise ELSE 0 END > 0) AS n_positive,
round(sum(greatest(m * m - CASE WHEN off THEN noise ELSE 0 END, 0)), 6) AS total FROM q GROUP BY policy"""
)
def noise_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Power less noise under both policies for products that don't say whether noise was removed; noise from legacy values or range times azimuth."""
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), F.col("l_quantity").cast("double").alias("m"))
    flag = F.when(F.col("k") % 3 == 0, True).when(F.col("k") % 3 == 1, False)
    legacy = F.when(F.col("k") % 2 == 0, 30.0)
    noise = radiometry.noise(legacy, F.when(legacy.isNull(), F.col("n").cast("double")), F.when(legacy.isNull(), 4.0))
    found = None
    for policy in ("assume_uncorrected", "assume_corrected"):
        off = radiometry.subtracts_noise(flag, policy)
        left = radiometry.denoised(radiometry.power(F.col("m")), noise, F.lit(True), off)
        each = rows.select(F.lit(policy).alias("policy"), off.alias("off"), left.cast("double").alias("left"))
        found = each if found is None else found.union(each)
    return found.groupBy("policy").agg(F.count("*").alias("n"), F.count_if("off").alias("n_subtracted"), F.count("left").alias("n_positive"), F.round(F.coalesce(F.sum("left"), F.lit(0.0)), 6).alias("total"))


@query(
    """SELECT event_id, CASE WHEN event_id % 4 = 0 THEN 'T30UXC' WHEN event_id % 4 = 1 THEN 'T31UDA' WHEN event_id % 4 = 2 THEN 'T26SKG' END AS tile,
CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 5 = 1 THEN event_id END AS number, CAST(trunc(value) AS BIGINT) AS whole,
CASE WHEN event_id % 3 = 0 THEN epoch_us(ts) * 1000 + 123 END AS nanoseconds, event_id % 3 = 0 AS is_time, CASE WHEN event_id % 2 = 0 THEN '/vsis3/b/' || event_id ELSE 'http://h/' || event_id END AS path FROM events"""
)
def lenient_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles of reports, whole numbers, times and paths from text that may be something else."""
    k = F.col("event_id")
    rows = table(spark, sf_dir, "events")
    folder = F.when(k % 4 == 2, "/r/T26SKG_2025-06-01_to_2025-06-30/report.json").otherwise("/r/other/report.json")
    tile = text.report_tile(F.when(k % 4 == 0, " t30uxc "), F.when(k % 4 == 1, "T31UDA").otherwise("T1"), path=folder)
    number = F.when(k % 5 == 0, "").when(k % 5 == 1, F.concat(F.lit(" "), k.cast("string"))).when(k % 5 == 2, "abc").otherwise("3.7")
    time = F.when(k % 3 == 0, F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("123Z"))).otherwise(" ")
    href = F.when(k % 2 == 0, F.concat(F.lit("s3://b/"), k.cast("string"))).otherwise(F.concat(F.lit("http://h/"), k.cast("string")))
    is_time = text.datetime_or_null(F.when(k % 3 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise("soon")).isNotNull()
    return rows.select("event_id", tile.alias("tile"), text.optional_integer(number).alias("number"), text.truncated(F.col("value")).alias("whole"), text.nanoseconds(time).alias("nanoseconds"), is_time.alias("is_time"), text.vsi_path(href).alias("path"))


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1 AS place FROM orders")
def numbered_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return numbered(rows, F.desc("o_totalprice"), "o_orderkey").select("o_orderkey", "place")


@query(f"{_SCENES} SELECT item_id FROM e WHERE datetime_utc >= TIMESTAMP '2024-01-05' AND datetime_utc < TIMESTAMP '2024-02-01' AND item_id % 1000 <= 700 AND item_id % 1000 + 35 >= 300")
def catalogue_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of January 2024 whose boxes meet another."""
    left = (F.col("item_id") % 1000).cast("double")
    boxed = adapters.items(spark, sf_dir).withColumns({"minx": left, "maxx": left + 35, "miny": F.lit(0.0), "maxy": F.lit(35.0)})
    return items.scan(boxed, "grd", "2024-01-05", "2024-01-31", (300.0, 10.0, 700.0, 20.0)).select("item_id")


@query(
    f"""{_ASSETS}, v AS (SELECT vec_id, min(CAST(v AS DOUBLE)) AS lo, max(CAST(v AS DOUBLE)) AS hi, count(*) FILTER (v > 0) AS n FROM (SELECT vec_id, unnest(embedding) AS v FROM embeddings) GROUP BY vec_id)
SELECT item_id, polarisation, round(lo, 9) AS noise_minimum, round(hi, 9) AS noise_maximum, coalesce(n, 0) AS n_positive, noise_href IS NOT NULL AND item_id % 3 = 1 AND coalesce(n, 0) > 0 AS usable
FROM pa LEFT JOIN v ON vec_id = item_id"""
)
def noise_usability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polarisations with the embedding of their item's number as noise values; items beyond the embeddings have none."""
    parts = items.unpivoted(adapters.items(spark, sf_dir))
    corrected = F.when(F.col("item_id") % 3 == 0, True).when(F.col("item_id") % 3 == 1, False)
    parts = parts.select("item_id", "polarisation", corrected.alias("corrected"), F.when(F.col("noise_href").isNull(), F.lit("no noise document")).alias("error"))
    row = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("item_id"), F.transform("embedding", lambda v: v.cast("double")).alias("values"))
    found = items.noise_usability(parts, row.join(parts.select("item_id", "polarisation"), "item_id"))
    return found.select("item_id", "polarisation", F.round("noise_minimum", 9).alias("noise_minimum"), F.round("noise_maximum", 9).alias("noise_maximum"), "n_positive", "usable")


@query(
    """WITH v AS (SELECT label, vec_id, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS time, embedding FROM embeddings)
SELECT label, time, k AS sample, CAST(embedding[k + 1] AS DOUBLE) AS value FROM v, range(0, 64) r(k)"""
)
def record_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each label's embeddings as a cube in a checksummed record file of chunks of 16, built in tasks and read back from its bytes."""
    rows = table(spark, sf_dir, "embeddings").select("label", "vec_id", F.col("embedding").cast("array<float>").alias("embedding"))

    def build(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("vec_id")
        cube = np.stack(part["embedding"].to_numpy()).astype(np.float32)
        content = record_files.array_bundle({"values": cube, "time": part["vec_id"].to_numpy(np.int64)}, {"values": ("time", "sample"), "time": ("time",)}, "time", 16)
        return pd.DataFrame({"label": [part["label"].iloc[0]], "content": [content]})

    def read(batches):
        for batch in batches:
            for label, content in zip(batch["label"], batch["content"], strict=True):
                _, arrays = record_files.array_bundle_of(bytes(content))
                cube = arrays["values"]
                time, sample = np.indices(cube.shape)
                yield pd.DataFrame({"label": label, "time": time.ravel(), "sample": sample.ravel(), "value": cube.ravel().astype(float)})

    files = rows.groupBy("label").applyInPandas(build, "label int, content binary")
    return files.mapInPandas(read, "label int, time long, sample long, value double")


@query(f"{_GRID} SELECT item_id, count(value) AS n_finite, round(min(value), 9) AS lowest, round(max(value), 9) AS highest, round(avg(value), 9) AS mean, round(median(value), 9) AS median FROM grid GROUP BY item_id HAVING count(value) > 0")
def validated_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of each calibrated grid that has a valid cell; the validator refuses the others, which are left out before it."""
    grid = _grid(spark, sf_dir)
    some = grid.groupBy("item_id").agg(F.count("value").alias("n")).where("n > 0")
    found = raster.validated(grid.join(some, "item_id", "left_semi"), ["item_id"])
    return found.select("item_id", "n_finite", *[F.round(c, 9).alias(c) for c in ("lowest", "highest", "mean", "median")])


@query(f"{_CHAIN} SELECT item_id, count(*) AS n, count(*) FILTER (ok) AS source_valid, count(*) FILTER (noise > 0) AS noise_valid, count(*) FILTER (ok AND NOT left_ > 0) AS nonpositive, count(*) FILTER (linear > 0) AS final_valid FROM c GROUP BY item_id")
def stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _calibrated(spark, sf_dir)
    # what the chain was given, from its own first stage and the place of the pixel
    given = rows.withColumns({"source_valid": (F.col("col") % 13 != 0) & (F.col("source_power") != 0), "noise_power": (F.lit(20.0) + F.col("col")).cast("float")})
    return raster.stage_counts(given, ["item_id"])


@query(
    """WITH i AS (SELECT label AS item_id, vec_id % 64 AS y, k AS x, CASE WHEN vec_id % 2 = 0 THEN 'VV' ELSE 'VH' END AS band, CAST(abs(CAST(embedding[k + 1] AS DOUBLE) * 1000) AS FLOAT) AS v FROM embeddings, range(0, 64) r(k))
SELECT item_id, y, x, round(max(CASE WHEN band = 'VV' THEN CAST(v AS DOUBLE) END), 6) AS vv, round(max(CASE WHEN band = 'VH' THEN CAST(v AS DOUBLE) END), 6) AS vh, bool_or(band = 'VV') AS vv_valid, bool_or(band = 'VH') AS vh_valid FROM i GROUP BY item_id, y, x"""
)
def uncalibrated_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detected magnitudes as a cube without radiometry; of several samples of a cell the largest."""
    pixels = raster.pixels(adapters.source_rows(spark, sf_dir), ["item_id"])
    band = F.when(F.col("row") % 2 == 0, "VV").otherwise("VH")
    cells = pixels.select("item_id", band.alias("band"), (F.col("row") % 64).alias("y"), F.col("col").cast("long").alias("x"), F.col("value").cast("double").alias("value"))
    grid = cells.groupBy("item_id", "band", "y", "x").agg(F.max("value").alias("value"))
    return raster.cube(grid, ["VV", "VH"]).withColumns({c: F.round(c, 6) for c in ("vv", "vh")})
