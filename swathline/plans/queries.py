"""The registered queries over the driver's tables, and the SQL each should agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from swathline.functions import geometry, radiometry, text
from swathline.functions.checksum import masked_crc
from swathline.operators import catalogue, jobs, luts, raster, spatial
from swathline.sources import annotations

from . import adapters
from .adapters import FOOTPRINT, FOOTPRINT_SIDE, PIXEL_SQL, SCENE_SQL, TILE, TILE_NAME, TILE_SIDE, boxes, iso_sql, scenes, source_rows, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
THRESHOLDS = (0.5, 0.6, 0.7, 0.75, 0.8, 0.85, 0.9)
CONFIG = {"mode": "IW", "product_level": "GRD", "output_format": "tfrecord", "start_date": "2018-03-15", "end_date": "2018-03-16", "calibration_lut": "sigmaNought"}
PREFIX = "radar"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return register


def _eligible(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.eligibility(catalogue.normalised(scenes(spark, sf_dir)))


_LIST = ", ".join(f"({t})" for t in THRESHOLDS)
_SCENES = f"""
WITH raw AS ({SCENE_SQL}),
n AS (SELECT *, string_split(pols, ',') AS l, replace(pols, ',', '+') AS joined FROM raw),
e AS (SELECT *, CASE WHEN joined = '' THEN 'NONE' ELSE joined END AS combination,
  concat_ws('|', coalesce(platform, 'missing'), coalesce({iso_sql('datetime_utc')}, 'missing'), coalesce({iso_sql('end_datetime_utc')}, 'missing'), instrument_mode,
    CASE WHEN absolute_orbit = 0 THEN 'missing' ELSE CAST(absolute_orbit AS VARCHAR) END, CASE WHEN joined = '' THEN 'missing' ELSE joined END) AS acquisition_key,
  list_filter([CASE WHEN instrument_mode <> 'IW' THEN 'instrument_mode_is_' || instrument_mode END,
    CASE WHEN platform IS NULL OR platform NOT IN ('sentinel-1a', 'sentinel-1b') THEN 'platform_is_' || coalesce(platform, 'missing') END,
    CASE WHEN product_type <> 'GRD' THEN 'product_type_is_' || product_type END, CASE WHEN pols = '' THEN 'no_supported_measurement_assets' END], lambda x: x IS NOT NULL) AS reasons FROM n),
g AS (SELECT * FROM e WHERE len(reasons) = 0), t AS (SELECT CAST(x AS DOUBLE) AS threshold FROM (VALUES {_LIST}) v(x))"""


@query(f"{_SCENES} SELECT item_id, platform, instrument_mode, combination, CAST(CASE WHEN pols = '' THEN 0 ELSE len(l) END AS INT) AS n_pols, acquisition_key, CAST(year(datetime_utc) AS INT) AS year FROM e")
def scene_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = catalogue.normalised(scenes(spark, sf_dir))
    return found.select("item_id", "platform", "instrument_mode", "combination", F.size("polarisations").alias("n_pols"), "acquisition_key", "year")


@query(f"{_SCENES} SELECT item_id, array_to_string(reasons, ',') AS reasons, len(reasons) = 0 AS eligible FROM e")
def eligibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _eligible(spark, sf_dir).select("item_id", F.array_join("reasons", ",").alias("reasons"), "eligible")


@query(
    f"""{_SCENES} SELECT item_id, array_to_string(list_filter([CASE WHEN platform IS NULL OR platform NOT IN ('sentinel-1a', 'sentinel-1b') THEN 'platform_is_' || coalesce(platform, 'missing') END,
CASE WHEN instrument_mode <> 'IW' THEN 'instrument_mode_is_' || instrument_mode END, CASE WHEN NOT list_contains(l, 'VV') THEN 'missing_vv' END, CASE WHEN NOT list_contains(l, 'VH') THEN 'missing_vh' END,
CASE WHEN coverage < 0.8 THEN 'coverage_below_threshold' END], lambda x: x IS NOT NULL), ',') AS reasons FROM e"""
)
def dual_eligibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.dual_eligibility(catalogue.normalised(scenes(spark, sf_dir)), 0.8).select("item_id", F.array_join("reasons", ",").alias("reasons"))


@query(f"{_SCENES} SELECT reason, count(*) AS n FROM (SELECT unnest(reasons) AS reason FROM e) GROUP BY reason")
def reason_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.reason_counts(_eligible(spark, sf_dir))


@query(f"{_SCENES} SELECT coalesce(platform, 'missing') AS value, count(*) AS n FROM e GROUP BY 1")
def platform_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.counts(catalogue.normalised(scenes(spark, sf_dir)), "platform")


@query(f"{_SCENES} SELECT polarisation, CAST(coalesce(n, 0) AS BIGINT) AS n FROM (VALUES ('VV'), ('VH'), ('HH'), ('HV')) p(polarisation) LEFT JOIN (SELECT unnest(l) AS polarisation, count(*) AS n FROM e GROUP BY 1) USING (polarisation)")
def polarisation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.polarisation_counts(catalogue.normalised(scenes(spark, sf_dir)))


@query(
    f"""{_SCENES} SELECT threshold, count(item_id) AS item_count, count(DISTINCT acquisition_key) AS acquisition_count, count(item_id) / CAST((SELECT count(*) FROM g) AS DOUBLE) AS fraction,
strftime(min(datetime_utc), '%Y-%m-%d') AS first_day, strftime(max(datetime_utc), '%Y-%m-%d') AS last_day FROM t LEFT JOIN g ON coverage >= threshold GROUP BY threshold"""
)
def threshold_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.threshold_summary(_eligible(spark, sf_dir), THRESHOLDS)


_UNIQUE = "u AS (SELECT threshold, acquisition_key, min(datetime_utc) AS d FROM g JOIN t ON coverage >= threshold GROUP BY ALL), w AS (SELECT threshold, (epoch_us(d) - epoch_us(lag(d) OVER (PARTITION BY threshold ORDER BY d))) / 86400e6 AS gap FROM u)"


@query(f"{_SCENES}, {_UNIQUE} SELECT threshold, count(gap) AS gap_count, round(min(gap), 9) AS min_gap, round(median(gap), 9) AS median_gap, round(avg(gap), 9) AS mean_gap, round(max(gap), 9) AS max_gap FROM t LEFT JOIN w USING (threshold) GROUP BY threshold")
def threshold_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = catalogue.gap_statistics(_eligible(spark, sf_dir), THRESHOLDS)
    return found.select("threshold", "gap_count", *[F.round(c, 9).alias(c) for c in ("min_gap", "median_gap", "mean_gap", "max_gap")])


@query(
    f"""{_SCENES} SELECT count(*) AS n, min(coverage) AS lowest, max(coverage) AS highest, round(avg(coverage), 9) AS mean,
{', '.join(f'round(quantile_cont(coverage, {q}), 9) AS {a}' for q, a in ((0.05, 'p05'), (0.25, 'p25'), (0.5, 'median'), (0.75, 'p75'), (0.95, 'p95')))} FROM g"""
)
def coverage_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = catalogue.coverage_distribution(_eligible(spark, sf_dir).where("eligible"))
    return found.select("n", "lowest", "highest", *[F.round(c, 9).alias(c) for c in ("mean", "p05", "p25", "median", "p75", "p95")])


@query(f"{_SCENES} SELECT acquisition_key, n, item_id FROM (SELECT acquisition_key, item_id, count(*) OVER (PARTITION BY acquisition_key) AS n FROM g) WHERE n > 1")
def duplicate_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.duplicates(_eligible(spark, sf_dir).where("eligible"))


@query(f"{_SCENES} SELECT acquisition_key, item_id FROM (SELECT *, row_number() OVER (PARTITION BY acquisition_key ORDER BY datetime_utc NULLS LAST, item_id) AS k FROM g) WHERE k = 1")
def unique_acquisitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.acquisitions(_eligible(spark, sf_dir).where("eligible")).select("acquisition_key", "item_id")


@query(f"{_SCENES} SELECT item_id, coverage FROM g WHERE abs(coverage - 0.8) <= 0.02")
def near_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.near_threshold(_eligible(spark, sf_dir).where("eligible"), 0.8, 0.02).select("item_id", "coverage")


@query(
    f"""{_SCENES} SELECT before_id, item_id, round(gap, 9) AS gap_days FROM (SELECT *, lag(item_id) OVER w AS before_id, (epoch_us(datetime_utc) - epoch_us(lag(datetime_utc) OVER w)) / 86400e6 AS gap
FROM g WHERE coverage >= 0.8 AND datetime_utc IS NOT NULL WINDOW w AS (ORDER BY datetime_utc, item_id)) WHERE before_id IS NOT NULL ORDER BY gap DESC, datetime_utc, item_id LIMIT 1"""
)
def longest_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.longest_gap(_eligible(spark, sf_dir).where("eligible"), 0.8).withColumn("gap_days", F.round("gap_days", 9))


_CLOSEST = """c AS (SELECT *, row_number() OVER (PARTITION BY threshold, side ORDER BY abs(coverage - threshold), datetime_utc NULLS LAST, item_id) AS k FROM
(SELECT *, CASE WHEN coverage >= threshold THEN 'above' ELSE 'below' END AS side FROM g, t))"""


@query(f"{_SCENES}, {_CLOSEST} SELECT threshold, side, CAST(k AS INT) AS rank, item_id FROM c WHERE k <= 3")
def closest_sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.closest(_eligible(spark, sf_dir).where("eligible"), THRESHOLDS, 3).select("threshold", "side", "rank", "item_id")


@query(
    f"""{_SCENES}, {_CLOSEST}, p AS (SELECT before_id, item_id FROM (SELECT *, lag(item_id) OVER w AS before_id, epoch_us(datetime_utc) - epoch_us(lag(datetime_utc) OVER w) AS gap
FROM g WHERE coverage >= 0.8 AND datetime_utc IS NOT NULL WINDOW w AS (ORDER BY datetime_utc, item_id)) WHERE before_id IS NOT NULL ORDER BY gap DESC, datetime_utc, item_id LIMIT 1),
a AS (SELECT item_id, 'closest_' || side || '_' || printf('%.2f', threshold) AS reason FROM c WHERE k <= 2 UNION SELECT before_id, 'longest_gap' FROM p UNION SELECT item_id, 'longest_gap' FROM p)
SELECT item_id, array_to_string(list_sort(list(reason)), ',') AS reasons FROM a GROUP BY item_id"""
)
def audit_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.audit_selection(_eligible(spark, sf_dir), THRESHOLDS, 2, 0.8).select("item_id", F.array_join("reasons", ",").alias("reasons"))


@query(f"{_SCENES} SELECT item_id FROM g WHERE coverage >= 0.8 ORDER BY datetime_utc NULLS LAST, item_id LIMIT 50")
def first_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.candidates(_eligible(spark, sf_dir), 0.8, 50).select("item_id")


@query(f"{_SCENES} SELECT item_id FROM g WHERE coverage >= 0.8 ORDER BY datetime_utc NULLS LAST, item_id")
def all_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate in order; ``first_candidates`` is its head."""
    return catalogue.candidates(_eligible(spark, sf_dir), 0.8).select("item_id")


@query(f"{_SCENES}, r AS (SELECT o_orderkey AS item_id FROM orders) SELECT item_id, EXISTS (SELECT 1 FROM e WHERE e.item_id = r.item_id) AS present FROM r")
def requested_all_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which order keys are the ids of scenes."""
    return _present(spark, sf_dir, table(spark, sf_dir, "orders"))


def _present(spark: SparkSession, sf_dir: str, orders: DataFrame) -> DataFrame:
    wanted, have = orders.select(F.col("o_orderkey").alias("item_id")), scenes(spark, sf_dir)
    there = wanted.join(have, "item_id", "left_semi").withColumn("present", F.lit(True))
    return there.union(catalogue.absent(wanted, have).withColumn("present", F.lit(False)))


@query(
    f"""{_SCENES}, m AS (SELECT item_id, coverage, coverage * 0.97 AS joint, item_id % 11 <> 0 AS complete FROM g), s AS (SELECT threshold, CASE WHEN complete THEN (coverage >= threshold) <> (joint >= threshold) END AS changed FROM m, t)
SELECT threshold, count(*) FILTER (changed) AS changed, count(*) FILTER (NOT changed) AS unchanged, count(*) FILTER (changed IS NULL) AS unknown, count(changed) AS known FROM s GROUP BY threshold"""
)
def threshold_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _eligible(spark, sf_dir).where("eligible").select("item_id", "coverage", (F.col("coverage") * 0.97).alias("joint"), (F.col("item_id") % 11 != 0).alias("complete"))
    return catalogue.outcomes(catalogue.threshold_status(records, THRESHOLDS))


@query(f"{_SCENES} SELECT item_id, bool_or(p) AS any_pass, bool_and(p) AS all_pass FROM (SELECT item_id, coverage >= 0.5 + 0.2 * k AS p FROM g, (VALUES (0), (1)) v(k)) GROUP BY item_id")
def scene_acceptance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _eligible(spark, sf_dir).where("eligible")
    passes = rows.select("item_id", F.explode(F.array(*[F.col("coverage") >= 0.5 + 0.2 * k for k in (0, 1)])).alias("passed"))
    either, every = (catalogue.acceptance(passes, rule).withColumnRenamed("accepted", f"{rule}_pass") for rule in ("any", "all"))
    return either.join(every, "item_id")


@query(f"{_SCENES}, s AS (SELECT threshold, count(item_id) AS item_count FROM t LEFT JOIN g ON coverage >= threshold GROUP BY 1), b AS (SELECT *, lag(item_count) OVER (ORDER BY threshold) AS before FROM s) SELECT threshold, item_count, before FROM b WHERE item_count > before")
def summary_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.invariants(catalogue.threshold_summary(_eligible(spark, sf_dir), THRESHOLDS))


@query(
    f"""{_SCENES}, c AS (SELECT threshold, CASE WHEN threshold = 0.75 THEN 2 * count(item_id) ELSE count(item_id) END AS item_count FROM t LEFT JOIN g ON coverage >= threshold GROUP BY threshold),
b AS (SELECT *, lag(item_count) OVER (ORDER BY threshold) AS before FROM c)
SELECT 'counts' AS fault, threshold AS place, CAST(item_count AS DOUBLE) AS value FROM b WHERE item_count > before UNION ALL SELECT 'coverage', CAST(item_id AS DOUBLE), coverage + 0.1 FROM g WHERE coverage + 0.1 > 1"""
)
def violated_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the invariants say of a summary with a count doubled and of coverages made too large."""
    rows = _eligible(spark, sf_dir)
    doubled = catalogue.threshold_summary(rows, THRESHOLDS).withColumn("item_count", F.when(F.col("threshold") == 0.75, 2 * F.col("item_count")).otherwise(F.col("item_count")))
    counts = catalogue.invariants(doubled).select(F.lit("counts").alias("fault"), F.col("threshold").alias("place"), F.col("item_count").cast("double").alias("value"))
    larger = catalogue.coverage_faults(rows.where("eligible").withColumn("coverage", F.col("coverage") + F.lit(0.1)))
    return counts.union(larger.select(F.lit("coverage"), F.col("item_id").cast("double"), "coverage"))


@query(
    f"""WITH a AS (SELECT {', '.join(f'{e} AS {c}' for c, e in TILE.items())} FROM supplier), b AS (SELECT {', '.join(f'{e} AS {c}' for c, e in FOOTPRINT.items())} FROM customer),
p AS (SELECT tile_id, scene_id, greatest(0, least(a.minx + {TILE_SIDE}, b.minx + {FOOTPRINT_SIDE}) - greatest(a.minx, b.minx)) * greatest(0, least(a.miny + {TILE_SIDE}, b.miny + {FOOTPRINT_SIDE}) - greatest(a.miny, b.miny)) AS area FROM a, b)
SELECT tile_id, scene_id, CAST(area AS DOUBLE) AS area, CAST(area / {TILE_SIDE**2} AS DOUBLE) AS coverage FROM p WHERE area > 0"""
)
def spatial_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    tiles = boxes(table(spark, sf_dir, "supplier"), TILE, TILE_SIDE)
    footprints = boxes(table(spark, sf_dir, "customer"), FOOTPRINT, FOOTPRINT_SIDE)
    return spatial.tile_scenes(tiles, footprints, 50.0).select("tile_id", "scene_id", "area", "coverage")


@query(
    f"""WITH a AS (SELECT {', '.join(f'{e} AS {c}' for c, e in FOOTPRINT.items())} FROM customer),
p AS (SELECT scene_id, greatest(0, least(minx + {FOOTPRINT_SIDE}, 520.0) - greatest(minx, 400.0)) * greatest(0, least(miny + {FOOTPRINT_SIDE}, 520.0) - greatest(miny, 400.0)) AS area FROM a)
SELECT scene_id, round(area / 14400.0, 9) AS coverage, round(area / {FOOTPRINT_SIDE**2}, 9) AS overlap FROM p"""
)
def polygon_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = boxes(table(spark, sf_dir, "customer"), FOOTPRINT, FOOTPRINT_SIDE)
    point = lambda x, y: F.array(x, y)
    ring = F.array(point(F.col("minx"), F.col("miny")), point(F.col("maxx"), F.col("miny")), point(F.col("maxx"), F.col("maxy")), point(F.col("minx"), F.col("maxy")))
    tile = F.array(*[point(F.lit(x), F.lit(y)) for x, y in ((400.0, 400.0), (520.0, 400.0), (520.0, 520.0), (400.0, 520.0))])
    measured = rows.select("scene_id", ring.alias("scene"), tile.alias("tile")).withColumn("m", geometry.coverage("tile", "scene"))
    return measured.select("scene_id", F.round("m.coverage", 9).alias("coverage"), F.round("m.overlap", 9).alias("overlap"))


@query(f"WITH a AS (SELECT {', '.join(f'{e} AS {c}' for c, e in TILE.items())} FROM supplier) SELECT tile_id, i AS place, minx + (20.0 / 8) * (CAST(i AS DOUBLE) + 0.5) AS x, miny + 20.0 - (20.0 / 8) * (CAST(i AS DOUBLE) + 0.5) AS y FROM a, range(0, 8) r(i)")
def grid_axes(spark: SparkSession, sf_dir: str) -> DataFrame:
    tiles = boxes(table(spark, sf_dir, "supplier"), TILE, TILE_SIDE)
    native = F.array(F.lit(1.0), F.lit(0.0), F.col("minx"), F.lit(0.0), F.lit(-1.0), F.col("maxy"))
    grid = tiles.withColumn("g", geometry.output_transform(native, F.lit(20), F.lit(20), 8))
    axes = grid.select("tile_id", F.posexplode(F.arrays_zip(geometry.axis(F.col("g")[2], F.col("g")[0], 8).alias("x"), geometry.axis(F.col("g")[5], F.col("g")[4], 8).alias("y"))).alias("place", "p"))
    return axes.select("tile_id", F.col("place").cast("long").alias("place"), "p.x", "p.y")


_LINES = "(SELECT max(vec_id) FROM embeddings)"
_LUT = adapters.lut_sql(_LINES)


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the last line of the raster, a number from the files' statistics
    return adapters.vectors(spark, table(spark, sf_dir, "embeddings").agg(F.max("vec_id")).first()[0])


@query(f"WITH {_LUT}, z AS (SELECT max(line) AS line FROM k) SELECT row, col, round(lut, 9) AS lut FROM lut UNION ALL SELECT line, col, round(v, 9) FROM a JOIN z USING (line)")
def lut_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line from the first calibration vector to the last."""
    rows = luts.interpolated(_vectors(spark, sf_dir), adapters.SAMPLES)
    return rows.select("row", F.posexplode("values").alias("col", "lut")).select("row", F.col("col").cast("long").alias("col"), F.round("lut", 9).alias("lut"))


def _calibrated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pixels with every stage of the chain; the calibration lines are joined as arrays, before anything is exploded."""
    lines = luts.interpolated(_vectors(spark, sf_dir), adapters.SAMPLES).withColumnRenamed("values", "lut")
    zipped = source_rows(spark, sf_dir).join(lines, "row").withColumn("z", F.arrays_zip("values", "lut"))
    pixels = zipped.select("item_id", "band", "row", F.posexplode("z").alias("col", "p"))
    magnitude, lut = F.col("p.values"), F.col("p.lut").cast("float")
    valid = radiometry.source_valid(magnitude, F.col("col") % 13 != 0, F.lit(0.0))
    noise = (F.lit(20.0) + F.col("col")).cast("float")
    stages = radiometry.chain(magnitude, valid, lut, noise, F.lit(False))
    return pixels.select("item_id", "band", "row", F.col("col").cast("long").alias("col"), *[c.alias(n) for n, c in stages.items()])


_CHAIN = f"""
WITH {_LUT}, px AS ({PIXEL_SQL}),
p AS (SELECT item_id, row, col, value AS m, CAST(lut AS FLOAT) AS lut, col % 13 <> 0 AND value <> 0 AS ok, CAST(20.0 + col AS FLOAT) AS noise FROM px JOIN lut USING (row, col)),
q AS (SELECT *, CAST(CAST(m AS DOUBLE) * CAST(m AS DOUBLE) AS FLOAT) AS source_power FROM p),
d AS (SELECT *, CASE WHEN ok THEN CAST(CAST(source_power AS DOUBLE) - CAST(noise AS DOUBLE) AS FLOAT) END AS left_ FROM q),
c AS (SELECT *, CASE WHEN left_ > 0 THEN CAST(CAST(left_ AS DOUBLE) / (CAST(lut AS DOUBLE) * CAST(lut AS DOUBLE)) AS FLOAT) END AS linear FROM d)"""


@query(f"{_CHAIN} SELECT item_id, row, col, CAST(source_power AS DOUBLE) AS source_power, CAST(linear AS DOUBLE) AS calibrated_linear, CASE WHEN linear > 0 THEN round(10 * log10(CAST(linear AS DOUBLE)), 4) END AS calibrated_db, coalesce(linear > 0, false) AS valid FROM c")
def radiometric_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = F.round(10.0 * F.log10(F.col("calibrated_linear").cast("double")), 4)
    return _calibrated(spark, sf_dir).select("item_id", "row", "col", F.col("source_power").cast("double").alias("source_power"), F.col("calibrated_linear").cast("double").alias("calibrated_linear"), F.when(F.col("calibrated_db").isNotNull(), wide).alias("calibrated_db"), "valid")


@query(f"{_CHAIN} SELECT CAST(floor(row / 256) AS BIGINT) AS strip, count(linear) AS n_finite, count(*) - count(linear) AS n_other, round(min(CAST(linear AS DOUBLE)), 9) AS lowest, round(max(CAST(linear AS DOUBLE)), 9) AS highest, round(avg(CAST(linear AS DOUBLE)), 9) AS mean, round(median(CAST(linear AS DOUBLE)), 9) AS median FROM c GROUP BY 1")
def strip_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = raster.finite_summary(raster.strips(_calibrated(spark, sf_dir), 256), ["strip"], "calibrated_linear")
    return found.select("strip", "n_finite", "n_other", *[F.round(c, 9).alias(c) for c in ("lowest", "highest", "mean", "median")])


def _grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector of 64 samples as an image of 8 by 8, averaged onto cells of two and a half pixels."""
    rows = _calibrated(spark, sf_dir).select(F.col("row").alias("item_id"), "band", F.floor(F.col("col") / 8).alias("row"), (F.col("col") % 8).alias("col"), F.col("calibrated_linear").alias("value"))
    return raster.averaged(rows, ["item_id", "band"], 2.5, 4, 4)


_GRID = f"""{_CHAIN}, i AS (SELECT row AS item_id, col // 8 AS r, col % 8 AS k, CAST(linear AS DOUBLE) AS v FROM c), cell AS (SELECT unnest(range(0, 4)) AS n),
o AS (SELECT item_id, y.n AS y, x.n AS x, v, (least((r + 1) / 2.5, y.n + 1) - greatest(r / 2.5, y.n)) * 2.5 * ((least((k + 1) / 2.5, x.n + 1) - greatest(k / 2.5, x.n)) * 2.5) AS w
FROM i JOIN cell y ON r / 2.5 < y.n + 1 AND (r + 1) / 2.5 > y.n JOIN cell x ON k / 2.5 < x.n + 1 AND (k + 1) / 2.5 > x.n),
grid AS (SELECT item_id, y, x, sum(w * v) / sum(CASE WHEN v IS NOT NULL THEN w END) AS value, coalesce(sum(CASE WHEN v IS NOT NULL THEN w END), 0) / sum(w) AS fraction FROM o GROUP BY ALL)"""


@query(f"{_GRID} SELECT item_id, y, x, round(value, 9) AS value, round(fraction, 9) AS fraction FROM grid")
def average_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _grid(spark, sf_dir).select("item_id", "y", "x", F.round("value", 9).alias("value"), F.round("fraction", 9).alias("fraction"))


@query(f"{_GRID} SELECT item_id, round(avg(fraction), 9) AS area_mean, round(avg((fraction > 0)::INT), 9) AS occupied, round(avg((abs(fraction - 1) <= 1e-6)::INT), 9) AS \"full\" FROM grid GROUP BY item_id")
def valid_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = raster.area_summary(_grid(spark, sf_dir), ["item_id"])
    return found.select("item_id", *[F.round(c, 9).alias(c) for c in ("area_mean", "occupied", "full")])


def _two_bands(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """Even vectors as VV and odd ones as VH of the item they share."""
    grid = raster.to_decibels(_grid(spark, sf_dir))
    band = F.when(F.col("item_id") % 2 == 0, "VV").otherwise("VH")
    return grid.select(F.floor(F.col("item_id") / 2).alias("item_id"), band.alias("band"), "y", "x", "value", *more, (F.col("valid") & (F.col("fraction") > 0.9)).alias("valid"))


_BANDS = f"{_GRID}, two AS (SELECT item_id // 2 AS item_id, CASE WHEN item_id % 2 = 0 THEN 'VV' ELSE 'VH' END AS band, y, x, value, coalesce(value > 0, false) AND fraction > 0.9 AS valid FROM grid)"


@query(f"{_BANDS}, m AS (SELECT item_id, y, x, bool_and(valid) AS every, bool_or(valid) AS a_few FROM two GROUP BY ALL) SELECT item_id, round(avg(every::INT), 9) AS joint, round(avg(a_few::INT), 9) AS either FROM m GROUP BY item_id")
def combined_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raster.combined_masks(_two_bands(spark, sf_dir)).select("item_id", F.round("joint", 9).alias("joint"), F.round("either", 9).alias("either"))


@query(
    f"""{_BANDS} SELECT item_id, y, x, round(max(CASE WHEN band = 'VV' THEN value END), 9) AS vv, round(max(CASE WHEN band = 'VH' THEN value END), 9) AS vh, CAST(NULL AS DOUBLE) AS hh,
max(CASE WHEN band = 'VV' THEN value END) IS NOT NULL AS vv_valid, max(CASE WHEN band = 'VH' THEN value END) IS NOT NULL AS vh_valid, false AS hh_valid FROM two GROUP BY item_id, y, x"""
)
def band_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = raster.cube(_two_bands(spark, sf_dir), ["VV", "VH", "HH"])
    return wide.withColumns({c: F.round(c, 9) for c in ("vv", "vh")}).withColumn("hh", F.col("hh").cast("double"))


_TILES = f"j AS (SELECT min(o_orderkey) AS ordinal, {TILE_NAME.format(text='VARCHAR')} AS tile FROM orders GROUP BY tile)"
_KEY = f"'{PREFIX}/T' || tile || '/2018-03-15_to_2018-03-16/S1_GRD_DB/s1_grd_tile_T' || tile || '_2018-03-15_to_2018-03-16_sigmaNought_db.tfrecord'"


def _inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("ordinal"), F.concat(F.lit(" t"), F.expr(TILE_NAME.format(text="STRING"))).alias("tile"))


@query(f"WITH {_TILES} SELECT ordinal, tile, {_KEY} AS output_key FROM j WHERE ordinal % 3 <> 0")
def enqueue_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    inventory = _inventory(spark, sf_dir)
    done = jobs.enqueue(inventory, None, CONFIG, PREFIX).where("ordinal % 3 = 0")
    return jobs.enqueue(inventory, done, CONFIG, PREFIX).select("ordinal", "tile", "output_key")


@query(f"WITH {_TILES} SELECT tile, CAST(CASE WHEN CAST(substr(tile, 3, 1) AS VARCHAR) >= 'N' THEN 32600 ELSE 32700 END + CAST(substr(tile, 1, 2) AS INT) AS INT) AS epsg FROM j")
def tile_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jobs.distinct_in_order(_inventory(spark, sf_dir))
    return found.select("tile", text.tile_epsg(F.col("tile")).alias("epsg"))


@query(
    f"""SELECT o_orderkey, CASE WHEN o_orderkey % 6 >= 3 THEN NULL ELSE {TILE_NAME.format(text='VARCHAR')} END AS tile,
CASE WHEN o_orderkey % 6 >= 3 THEN 'no_tile' WHEN o_orderkey % 12 = 0 THEN 'mode_mismatch' ELSE '' END AS faults FROM orders"""
)
def message_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects, quoted and bare names, and messages that name no tile: an empty object, a number, a list."""
    name = F.concat(F.lit("T"), F.expr(TILE_NAME.format(text="STRING")))
    mode = F.when(F.col("o_orderkey") % 12 == 0, "EW").otherwise("IW")
    whole = F.to_json(F.struct(name.alias("mgrs_tile"), mode.alias("mode")))
    kind = F.col("o_orderkey") % 6
    body = F.when(kind == 0, whole).when(kind == 1, F.concat(F.lit('"'), name, F.lit('"'))).when(kind == 2, F.lower(name)).when(kind == 3, "{}").when(kind == 4, "12345").otherwise("[1, 2]")
    return jobs.parsed(table(spark, sf_dir, "orders").select("o_orderkey", body.alias("body")), CONFIG).select("o_orderkey", "tile", F.array_join("faults", ",").alias("faults"))


@query(
    """WITH l AS (SELECT event_id % 3 AS code, event_id % 5 <> 0 AS written, event_type IN ('view', 'purchase', 'error', 'signup') AS nothing FROM events),
e AS (SELECT CASE WHEN code = 0 AND written THEN 'complete' WHEN nothing THEN 'no_data' ELSE 'failed' END AS state, code FROM l)
SELECT state, CASE WHEN state = 'no_data' THEN 'no_sentinel1_data' WHEN state = 'failed' AND code <> 0 THEN 'processor_exit_' || code WHEN state = 'failed' THEN 'unknown_failure' END AS reason,
CASE WHEN state = 'failed' THEN 'keep' ELSE 'delete' END AS action, count(*) AS n FROM e GROUP BY ALL"""
)
def failure_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exits by state, reason and what becomes of the message."""
    said = {"view": "Candidate scenes:           0", "purchase": "x\nNo acquisitions\n", "error": "No scenes remained after filtering.", "signup": "No Sentinel-1 scenes here"}
    log = F.create_map(*[F.lit(x) for pair in said.items() for x in pair])[F.col("event_type")]
    ends = table(spark, sf_dir, "events").select(jobs.classified((F.col("event_id") % 3).cast("int"), log, F.col("event_id") % 5 != 0).alias("end"))
    return ends.groupBy("end.state", "end.reason", jobs.action(F.col("end.state")).alias("action")).agg(F.count("*").alias("n"))


@query("SELECT 'T' || (user_id % 500) AS tile, event_id AS sequence, event_type AS state FROM (SELECT *, row_number() OVER (PARTITION BY user_id % 500 ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k = 1")
def job_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(F.concat(F.lit("T"), (F.col("user_id") % 500).cast("string")).alias("tile"), F.col("ts").alias("updated"), F.col("event_id").alias("sequence"), F.col("event_type").alias("state"))
    return jobs.current(rows).select("tile", "sequence", "state")


@query(
    f"""SELECT i * 20 AS line, p AS pixel, CAST(400 + ((i * 20) % 7) * 3 + p AS DOUBLE) AS lut FROM range(0, {_LINES} // 20 + 2) t(i), (VALUES {', '.join(f'({p})' for p in adapters.PIXELS)}) x(p)"""
)
def calibration_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _vectors(spark, sf_dir)
    join = lambda c: F.array_join(F.col(c).cast("array<string>"), " ")
    vector = F.concat(F.lit("<s:calibrationVector><s:line>"), F.col("line").cast("string"), F.lit("</s:line><s:pixel count='5'> "), join("pixels"), F.lit(" </s:pixel><s:sigmaNought>"), join("lut"), F.lit("</s:sigmaNought></s:calibrationVector>"))
    # a document of each hundred lines
    grouped = vectors.withColumn("item_id", F.floor(F.col("line") / 100)).groupBy("item_id").agg(F.array_join(F.collect_list(vector), "").alias("v"))
    documents = grouped.select("item_id", F.concat(F.lit("<s:calibration xmlns:s='urn:x'><s:calibrationVectorList>"), "v", F.lit("</s:calibrationVectorList></s:calibration>")).alias("document"))
    read = annotations.calibration(documents)
    return read.select("line", F.explode(F.arrays_zip("pixels", "lut")).alias("k")).select("line", F.col("k.pixels").alias("pixel"), F.col("k.lut").alias("lut"))


@query("SELECT p_partkey, coalesce(nullif(upper(trim(n)), ''), nullif(upper(trim(o)), '')) AS product_type, CASE WHEN n <> '' AND o <> '' AND n <> o THEN 'product_type_fields_disagree' WHEN n = '' AND o <> '' THEN 'using_deprecated_product_type' WHEN n = '' AND o = '' THEN 'missing_product_type' ELSE '' END AS warnings FROM (SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN '' ELSE 'GRD' END AS n, CASE WHEN p_size % 4 = 0 THEN '' WHEN p_size % 4 = 1 THEN 'SLC' ELSE 'GRD' END AS o FROM part)")
def product_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    new, old = F.when(F.col("p_size") % 3 == 0, " ").otherwise("grd "), F.when(F.col("p_size") % 4 == 0, "").when(F.col("p_size") % 4 == 1, "slc").otherwise("GRD")
    return table(spark, sf_dir, "part").select("p_partkey", text.product_type(new, old).alias("p")).select("p_partkey", "p.product_type", F.array_join("p.warnings", ",").alias("warnings"))


@query()
def record_checksums(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", masked_crc(F.encode("text", "UTF-8")).alias("crc"))


@query(
    f"""{_SCENES}, b AS (SELECT CAST(floor(coverage * 10) AS INT) AS r, CAST(relative_orbit % 64 AS INT) AS k, absolute_orbit AS v FROM g),
m AS (SELECT r AS line, k AS pixel, CAST(max(v) AS DOUBLE) AS noise, r BETWEEN 2 AND 5 AND k BETWEEN 2 AND 61 AS interior FROM b WHERE v > 0 AND r < 8 GROUP BY r, k)
SELECT *, row_number() OVER (ORDER BY interior DESC, pow(line - 3.5, 2) + pow(pixel - 31.5, 2), noise DESC, line, pixel) - 1 AS rank FROM m"""
)
def noise_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _eligible(spark, sf_dir).where("eligible").select(F.floor(F.col("coverage") * 10).cast("int").alias("line"), (F.col("relative_orbit") % 64).cast("int").alias("pixel"), F.col("absolute_orbit").cast("double").alias("noise"))
    return luts.noise_anchors(rows, 8, 64, 4).select("line", "pixel", "noise", "interior", "rank")
