"""Registered queries of projections, of warps and of the message queue, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from swathline.functions import projection
from swathline.operators import queue, warp

from .adapters import table
from .queries import query

#: Places over both hemispheres and all zones.
LON, LAT = "CAST((c_custkey * 7919) % 35999 AS DOUBLE) / 100e0 - 179.99e0", "CAST((c_custkey * 104729) % 16001 AS DOUBLE) / 100e0 - 80e0"
TIMEOUT, ATTEMPTS, NOW = 90 * 86400, 3, "1996-06-30"
_ACTION = "CASE WHEN l_returnflag = 'R' AND l_linenumber % 2 = 0 THEN 'release' WHEN l_linestatus = 'F' AND l_linenumber = 4 THEN 'delete' WHEN l_linenumber = 3 THEN 'extend' ELSE 'receive' END"


def _sums(factors: tuple[float, ...], first: str, second: str) -> tuple[str, str]:
    terms = [(f"{f!r}::DOUBLE", 2 * i) for i, f in enumerate(factors, 1)]
    return " + ".join(f"{f} * sin({k} * {first}) * cosh({k} * {second})" for f, k in terms), " + ".join(f"{f} * cos({k} * {first}) * sinh({k} * {second})" for f, k in terms)


_MORE = _sums(projection.FORWARD, "xi", "eta")
_PLACES = f"""WITH p AS (SELECT c_custkey AS place_id, {LON} AS lon, {LAT} AS lat FROM customer),
z AS (SELECT *, CAST(least(60, floor((lon + 180) / 6) + 1) AS INT) AS zone FROM p),
t AS (SELECT *, radians(lon - (zone * 6 - 183)) AS l, tan(radians(lat)) AS t FROM z),
b AS (SELECT *, sinh({projection.ECCENTRICITY!r}::DOUBLE * atanh({projection.ECCENTRICITY!r}::DOUBLE * t / sqrt(1 + t * t))) AS s FROM t),
c AS (SELECT *, t * sqrt(1 + s * s) - s * sqrt(1 + t * t) AS q FROM b),
g AS (SELECT *, atan2(q, cos(l)) AS xi, asinh(sin(l) / sqrt(q * q + cos(l) * cos(l))) AS eta FROM c),
u AS (SELECT place_id, CAST(CASE WHEN lat < 0 THEN 32700 ELSE 32600 END + zone AS INT) AS epsg, lon, lat, 500000 + {projection.RADIUS!r}::DOUBLE * (eta + {_MORE[1]}) AS x,
CASE WHEN lat < 0 THEN 1e7::DOUBLE ELSE 0 END + {projection.RADIUS!r}::DOUBLE * (xi + {_MORE[0]}) AS y FROM g)"""


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").selectExpr("c_custkey AS place_id", f"{LON} AS lon", f"{LAT} AS lat")
    return rows.withColumn("epsg", projection.zone_code(F.col("lon"), F.col("lat"))).withColumn("p", projection.forward(F.col("lon"), F.col("lat"), F.col("epsg")))


@query(f"{_PLACES} SELECT place_id, epsg, round(x, 3) AS x, round(y, 3) AS y FROM u")
def projected_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _places(spark, sf_dir).select("place_id", "epsg", F.round("p.x", 3).alias("x"), F.round("p.y", 3).alias("y"))


@query(f"SELECT c_custkey AS place_id, round({LON}, 7) AS lon, round({LAT}, 7) AS lat FROM customer")
def returned_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places projected and back again, which are the places."""
    back = projection.inverse(F.col("p.x"), F.col("p.y"), F.col("epsg"))
    return _places(spark, sf_dir).withColumn("b", back).select("place_id", F.round("b.lon", 7).alias("lon"), F.round("b.lat", 7).alias("lat"))


@query(
    f"""WITH a AS (SELECT l_orderkey AS message_id, CAST(l_shipdate AS TIMESTAMP) AS logged, {_ACTION} AS action FROM lineitem),
k AS (SELECT * FROM a WHERE logged <= TIMESTAMP '{NOW}'), d AS (SELECT message_id FROM k WHERE action = 'delete'),
h AS (SELECT message_id, max(logged) AS held FROM k WHERE action IN ('receive', 'extend') GROUP BY 1),
f AS (SELECT h.message_id, h.held + INTERVAL '90' DAY > TIMESTAMP '{NOW}' AND NOT EXISTS (SELECT 1 FROM k WHERE k.message_id = h.message_id AND k.action = 'release' AND k.logged >= h.held) AS busy FROM h),
n AS (SELECT message_id, count(*) AS n FROM k WHERE action = 'receive' GROUP BY 1)
SELECT o_orderkey AS message_id, coalesce(n, 0) AS attempts, CASE WHEN o_orderkey IN (SELECT message_id FROM d) THEN 'deleted' WHEN coalesce(busy, false) THEN 'in_flight' WHEN coalesce(n, 0) >= {ATTEMPTS} THEN 'dead' ELSE 'visible' END AS state
FROM orders LEFT JOIN f ON f.message_id = o_orderkey LEFT JOIN n ON n.message_id = o_orderkey"""
)
def message_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("message_id"))
    log = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey AS message_id", "CAST(l_shipdate AS TIMESTAMP) AS at", f"{_ACTION} AS action")
    return queue.states(messages, log, F.lit(NOW).cast("timestamp"), TIMEOUT, ATTEMPTS)


def _shift(label: str) -> str:
    return f"(7 * ({label} % 8))"


@query(
    f"""WITH i AS (SELECT vec_id, label, unnest(range(0, 64)) AS n, unnest(embedding) AS e FROM embeddings),
p AS (SELECT vec_id AS item_id, (n // 8) * 10 AS top, (n % 8) * 10 + {_shift('label')} AS side, CASE WHEN (vec_id + n) % 7 <> 0 THEN CAST(e AS DOUBLE) END AS v FROM i),
cell AS (SELECT unnest(range(0, 6)) AS n),
o AS (SELECT item_id, y.n AS y, x.n AS x, v, (least(top + 10, y.n * 25 + 25) - greatest(top, y.n * 25)) * (least(side + 10, x.n * 25 + 25) - greatest(side, x.n * 25)) AS w
FROM p JOIN cell y ON top < y.n * 25 + 25 AND top + 10 > y.n * 25 JOIN cell x ON side < x.n * 25 + 25 AND side + 10 > x.n * 25)
SELECT item_id, y, x, round(sum(w * v) / sum(CASE WHEN v IS NOT NULL THEN w END), 6) AS value, round(coalesce(sum(CASE WHEN v IS NOT NULL THEN w END), 0) / CAST(sum(w) AS DOUBLE), 6) AS fraction FROM o GROUP BY ALL"""
)
def warped_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector as an image of 8 by 8 pixels of ten metres, located by nine control points that its label's images share, on cells of 25 metres."""
    images = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("item_id"), "label", F.transform("embedding", lambda v, n: F.when((F.col("vec_id") + n) % 7 != 0, v.cast("double"))).alias("all"))
    rows = images.select("item_id", "label", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("row"), "all").withColumn("values", F.slice("all", F.col("row") * 8 + 1, 8))
    at = images.select("label").distinct().select("label", F.explode(F.array(F.lit(0), F.lit(4), F.lit(8))).alias("pixel")).select("*", F.explode(F.array(F.lit(0), F.lit(4), F.lit(8))).alias("line"))
    place = projection.inverse(F.expr(f"500000e0 + 10 * pixel + {_shift('label')}"), F.expr("5700000e0 - 10 * line"), F.lit(32631))
    points = at.withColumn("p", place).select("label", "pixel", "line", "p.lon", "p.lat")
    found = warp.warped(rows, warp.fitted(points, ["label"], 32631), ["label"], ["item_id"], (25.0, 0.0, 500000.0, 0.0, -25.0, 5700000.0), 6, 6)
    return found.select("item_id", "y", "x", F.round("value", 6).alias("value"), F.round("fraction", 6).alias("fraction"))
