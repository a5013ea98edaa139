"""The driver's tables as catalogue rows, pixels, tables and jobs.  Expressions hold in Spark and in DuckDB alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A scene in three has the time its day begins, as others do, and one in 29 has none.
TIME = "CASE WHEN event_id % 29 = 0 THEN NULL WHEN event_id % 3 = 0 THEN CAST(CAST(ts AS DATE) AS {timestamp}) ELSE ts END"
SCENE = {
    "item_id": "event_id",
    "datetime_utc": TIME,
    "end_datetime_utc": f"{TIME} + INTERVAL '25' SECOND",
    "platform": "CASE CAST(user_id % 4 AS INT) WHEN 0 THEN 'sentinel-1a' WHEN 1 THEN 'sentinel-1b' WHEN 2 THEN 'sentinel-1c' END",
    "instrument_mode": "CASE WHEN event_type = 'error' THEN 'EW' ELSE 'IW' END",
    "product_type": "CASE WHEN event_id % 17 = 0 THEN 'SLC' ELSE 'GRD' END",
    "orbit_state": "CASE WHEN event_id % 2 = 0 THEN 'ascending' ELSE 'descending' END",
    "relative_orbit": "user_id % 175 + 1",
    "absolute_orbit": "user_id % 7",
    "pols": "CASE event_type WHEN 'view' THEN 'VV,VH' WHEN 'click' THEN 'VV' WHEN 'purchase' THEN 'HH,HV' WHEN 'signup' THEN 'HH' ELSE '' END",
    "coverage": "CAST((event_id * 7919) % 1001 AS DOUBLE) / 1000e0",
}
SCENE_SQL = f"SELECT {', '.join(f'{e.format(timestamp='TIMESTAMP')} AS {c}' for c, e in SCENE.items())} FROM events"
TILE = {"tile_id": "s_suppkey", "minx": "CAST((s_suppkey * 37) % 1000 AS DOUBLE)", "miny": "CAST((s_suppkey * 91) % 1000 AS DOUBLE)"}
FOOTPRINT = {"scene_id": "c_custkey", "minx": "CAST((c_custkey * 53) % 1000 AS DOUBLE)", "miny": "CAST((c_custkey * 17) % 1000 AS DOUBLE)"}
TILE_SIDE, FOOTPRINT_SIDE = 20.0, 35.0
TILE_NAME = "concat(lpad(CAST(o_orderkey % 60 + 1 AS {text}), 2, '0'), CASE WHEN o_orderkey % 2 = 0 THEN 'N' ELSE 'H' END, CASE o_orderkey % 3 WHEN 0 THEN 'AB' WHEN 1 THEN 'CD' ELSE 'EF' END)"
SAMPLES, LINE_STEP = 64, 20
PIXELS = (0, 16, 32, 48, 63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").selectExpr(*[f"{e.format(timestamp='TIMESTAMP_NTZ')} AS {c}" for c, e in SCENE.items()])
    return rows.withColumn("polarisations", F.filter(F.split("pols", ","), lambda p: p != "")).drop("pols")


def boxes(rows: DataFrame, columns: dict[str, str], side: float) -> DataFrame:
    found = rows.selectExpr(*[f"{e} AS {c}" for c, e in columns.items()])
    return found.withColumns({"maxx": F.col("minx") + side, "maxy": F.col("miny") + side})


def source_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as raster lines of 64 detected magnitudes; a label is a raster."""
    values = F.transform("embedding", lambda v: F.abs(v.cast("double") * 1000).cast("float"))
    return table(spark, sf_dir, "embeddings").select(F.col("label").cast("bigint").alias("item_id"), F.lit("VV").alias("band"), F.col("vec_id").alias("row"), values.alias("values"))


PIXEL_SQL = "SELECT CAST(label AS BIGINT) AS item_id, vec_id AS row, unnest(range(0, 64)) AS col, unnest(list_transform(embedding, lambda v: CAST(abs(CAST(v AS DOUBLE) * 1000) AS FLOAT))) AS value FROM embeddings"


def vectors(spark: SparkSession, lines: int) -> DataFrame:
    """Calibration vectors every 20 lines that reach past ``lines``."""
    count = lines // LINE_STEP + 2
    pixels = F.array(*[F.lit(p).cast("bigint") for p in PIXELS])
    line = F.col("id") * LINE_STEP
    return spark.range(count).select(line.alias("line"), pixels.alias("pixels"), F.transform(pixels, lambda p: (400 + (line % 7) * 3 + p).cast("double")).alias("lut"))


def lut_sql(lines: str) -> str:
    """The same tables interpolated at every line and sample, as ``(row, col, lut)``."""
    return f"""
k AS (SELECT i * {LINE_STEP} AS line, p AS pixel, CAST(400 + ((i * {LINE_STEP}) % 7) * 3 + p AS DOUBLE) AS v FROM range(0, {lines} // {LINE_STEP} + 2) t(i), (VALUES {', '.join(f'({p})' for p in PIXELS)}) x(p)),
s AS (SELECT line, pixel AS p0, v AS v0, lead(pixel) OVER w AS p1, lead(v) OVER w AS v1 FROM k WINDOW w AS (PARTITION BY line ORDER BY pixel)),
a AS (SELECT line, c AS col, v0 + (v1 - v0) * (CAST(c - p0 AS DOUBLE) / (p1 - p0)) AS v FROM s, range(0, {SAMPLES}) y(c) WHERE p1 IS NOT NULL AND c >= p0 AND (c < p1 OR (c = p1 AND p1 = {PIXELS[-1]}))),
l AS (SELECT line, col, v, lead(line) OVER w AS line1, lead(v) OVER w AS v1 FROM a WINDOW w AS (PARTITION BY col ORDER BY line)),
lut AS (SELECT line + i AS row, col, v + (v1 - v) * (CAST(i AS DOUBLE) / (line1 - line)) AS lut FROM l, range(0, {LINE_STEP}) z(i) WHERE line1 IS NOT NULL)"""


def iso_sql(value: str) -> str:
    return f"(strftime({value}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN microsecond({value}) % 1000000 <> 0 THEN strftime({value}, '.%f') ELSE '' END || 'Z')"


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scenes as catalogue items: some keys in capitals, blank and missing hrefs, two fields for the product type."""
    rows = scenes(spark, sf_dir)
    key = lambda k: F.when(F.col("item_id") % 2 == 0, F.upper(k)).otherwise(k)
    entry = lambda k, v: F.struct(key(k).alias("k"), v.cast("string").alias("v"))
    path = lambda kind, p: F.concat(F.lit(f"{kind}/"), F.col("item_id").cast("string"), F.lit("/"), p)
    low = F.transform("polarisations", F.lower)
    measured = F.transform(low, lambda p: entry(p, F.when((F.col("item_id") % 5 == 0) & (p == "vv"), " ").otherwise(path("m", p))))

    def schema(name: str, there) -> object:
        return F.array_compact(F.transform(low, lambda p: F.when(there, entry(F.concat(F.lit(f"schema-{name}-"), p), path(name, p)))))

    schemas = [schema("product", F.lit(True)), schema("calibration", F.col("item_id") % 3 != 0), schema("noise", F.col("item_id") % 7 != 0)]
    manifest = F.when(F.col("item_id") % 4 != 0, F.array(entry(F.lit("safe-manifest"), path("s", F.lit("x")))))
    assets = F.map_from_entries(F.concat(measured, *schemas, F.coalesce(manifest, F.filter(measured, lambda e: F.lit(False)))))
    return rows.select(
        "item_id", F.lit("grd").alias("collection"), "datetime_utc", F.col("datetime_utc").alias("start_datetime_utc"), "end_datetime_utc", "platform", F.lit("sentinel-1").alias("constellation"), "instrument_mode",
        F.when(F.col("item_id") % 6 == 0, F.lit(None)).otherwise(F.col("product_type")).alias("product_type_field"), F.when(F.col("item_id") % 12 != 0, F.col("product_type")).alias("deprecated_product_type"),
        "orbit_state", "relative_orbit", "absolute_orbit", F.col("polarisations").alias("declared"), assets.alias("assets"),
    )


def coverages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scenes(spark, sf_dir)
    return rows.select("item_id", (F.col("coverage") * 400).alias("area"), "coverage", (F.col("coverage") / 2).alias("overlap"), F.when(F.col("item_id") % 31 == 0, F.lit("ValueError:bad ring")).alias("failure"))
