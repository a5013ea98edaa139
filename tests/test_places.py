"""Projections against another published series, rings that have no area of their own, the queue's states and the instance probes."""

from __future__ import annotations

import json
import math
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from pyspark.sql import functions as F

from swathline.functions import geometry, projection
from swathline.operators import items, queue, warp
from swathline.plans import adapters
from swathline.sources import instance, reports


def meridian_series(lon: float, lat: float, centre: float) -> tuple[float, float]:
    """The older series in powers of the distance from the meridian, good to millimetres within a zone."""
    a, e2 = projection.AXIS, projection.ECCENTRICITY**2
    p, d = math.radians(lat), math.radians(lon - centre)
    second = e2 / (1 - e2)
    n, t, c, w = a / math.sqrt(1 - e2 * math.sin(p) ** 2), math.tan(p) ** 2, second * math.cos(p) ** 2, d * math.cos(p)
    m = a * (
        (1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256) * p - (3 * e2 / 8 + 3 * e2**2 / 32 + 45 * e2**3 / 1024) * math.sin(2 * p)
        + (15 * e2**2 / 256 + 45 * e2**3 / 1024) * math.sin(4 * p) - 35 * e2**3 / 3072 * math.sin(6 * p)
    )
    x = 0.9996 * n * (w + (1 - t + c) * w**3 / 6 + (5 - 18 * t + t * t + 72 * c - 58 * second) * w**5 / 120) + 500000
    y = 0.9996 * (m + n * math.tan(p) * (w * w / 2 + (5 - t + 9 * c + 4 * c * c) * w**4 / 24 + (61 - 58 * t + t * t + 600 * c - 330 * second) * w**6 / 720))
    return x, y + (1e7 if lat < 0 else 0)


def test_projection_agrees_with_another_series(spark):
    places = [(lon, lat) for lon in (0.0, 0.7, 3.0, 5.9) for lat in (-79.0, -33.3, 0.0, 12.5, 51.7, 83.0)]
    rows = spark.createDataFrame(places, "lon double, lat double").withColumn("epsg", projection.zone_code(F.col("lon"), F.col("lat")))
    for r in rows.select("*", projection.forward(F.col("lon"), F.col("lat"), F.col("epsg")).alias("p")).collect():
        assert (r.p.x, r.p.y) == pytest.approx(meridian_series(r.lon, r.lat, 3.0), abs=0.02)


def test_projection_of_a_known_place(spark):
    row = spark.range(1).select(projection.forward(F.lit(-79.387139), F.lit(43.642567), F.lit(32617)).alias("p")).first()
    assert (round(row.p.x), round(row.p.y)) == (630084, 4833439)


def test_projection_of_nulls_and_other_codes(spark):
    rows = spark.createDataFrame([(None, 1.0, 32631), (1.0, None, 32631), (1.0, 1.0, None)], "lon double, lat double, epsg int")
    assert [r.p for r in rows.select(projection.forward(F.col("lon"), F.col("lat"), F.col("epsg")).alias("p")).collect()] == [None] * 3
    assert [r.p for r in rows.select(projection.inverse(F.col("lon"), F.col("lat"), F.col("epsg")).alias("p")).collect()] == [None] * 3
    with pytest.raises(Exception, match="not a transverse Mercator zone: 4326"):
        spark.createDataFrame([(1.0, 1.0, 4326)], "lon double, lat double, epsg int").select(projection.forward(F.col("lon"), F.col("lat"), F.col("epsg"))).collect()


def test_grid_outline_in_both_systems(spark):
    terms = F.array(*[F.lit(v) for v in (10.0, 0.0, 600000.0, 0.0, -10.0, 5700000.0)])
    ring = spark.range(1).select(projection.grid_ring(terms, F.lit(10980), F.lit(10980)).alias("r"))
    rows = ring.select("r", projection.geographic_ring(F.col("r"), F.lit(32630)).alias("g")).select("r", "g", projection.projected_ring(F.col("g"), F.lit(32630)).alias("b")).first()
    assert rows.r == [[600000.0, 5700000.0], [709800.0, 5700000.0], [709800.0, 5590200.0], [600000.0, 5590200.0]]
    assert all(-3 < lon < 1 and 50 < lat < 52 for lon, lat in rows.g)
    assert [v for p in rows.b for v in p] == pytest.approx([v for p in rows.r for v in p], abs=1e-5)


SQUARE = [[0.0, 0.0], [4.0, 0.0], [4.0, 4.0], [0.0, 4.0]]


@pytest.mark.parametrize(
    ("tile", "scene", "coverage", "reason"),
    [
        (SQUARE, [[2.0, 0.0], [2.0, 0.0], [6.0, 0.0], [6.0, 4.0], [2.0, 4.0], [2.0, 0.0]], 0.5, None),
        (SQUARE, [[0.0, 0.0], [4.0, 4.0], [4.0, 0.0], [0.0, 4.0]], 0.0, "geometry: a ring crosses itself"),
        (SQUARE, [[0.0, 0.0], [4.0, 0.0], [float("nan"), 4.0]], 0.0, "geometry: a point is not finite"),
        ([[0.0, 0.0], [4.0, 0.0], [1.0, 1.0], [0.0, 4.0]], SQUARE, 0.0, "geometry: the tile is not convex"),
        ([[2.0, 0.0], [3.2, 3.8], [0.1, 1.5], [3.9, 1.5], [0.8, 3.8]], SQUARE, 0.0, "geometry: a ring crosses itself"),
    ],
)
def test_rings_with_a_fault(spark, tile, scene, coverage, reason):
    rows = spark.createDataFrame([(tile, scene)], "tile array<array<double>>, scene array<array<double>>")
    found = rows.select(geometry.coverage("tile", "scene").alias("m")).first().m
    assert (found.coverage, found.reason) == (coverage, reason)


def test_queue_states(spark):
    at = "2020-01-01 00:0{}:00".format
    log = [
        ("gone", at(0), "receive"), ("gone", at(1), "delete"), ("busy", at(4), "receive"), ("back", at(4), "receive"), ("back", at(4), "release"), ("late", at(0), "receive"),
        ("held", at(0), "receive"), ("held", at(4), "extend"), ("worn", at(0), "receive"), ("worn", at(1), "receive"), ("again", at(3), "release"), ("again", at(4), "receive"),
        ("ahead", at(9), "delete"), ("odd", at(4), "looked"), (None, at(4), "delete"), ("none", None, "delete"),
    ]
    log = spark.createDataFrame(log, "message_id string, at string, action string").withColumn("at", F.col("at").cast("timestamp"))
    messages = spark.createDataFrame([(m,) for m in ("gone", "busy", "back", "late", "held", "worn", "again", "ahead", "odd", "none", "new", None)], "message_id string")
    found = {r.message_id: (r.state, r.attempts) for r in queue.states(messages, log, F.lit(at(5)).cast("timestamp"), 120, 2).collect()}
    assert found == {
        "gone": ("deleted", 1), "busy": ("in_flight", 1), "back": ("visible", 1), "late": ("visible", 1), "held": ("in_flight", 1), "worn": ("dead", 2), "again": ("in_flight", 1),
        "ahead": ("visible", 0), "odd": ("visible", 0), "none": ("visible", 0), "new": ("visible", 0), None: ("visible", 0),
    }
    assert queue.states(messages.limit(0), log, F.lit(at(5)).cast("timestamp"), 120).count() == 0
    done = spark.createDataFrame([("a", "delete"), ("b", "keep"), ("c", "release")], "message_id string, action string")
    assert sorted(r.message_id for r in queue.entries(done, F.current_timestamp()).collect()) == ["a", "c"]


class Metadata(BaseHTTPRequestHandler):
    taken = False

    def _answer(self, text: str | None) -> None:
        self.send_response(200 if text else 404)
        self.end_headers()
        self.wfile.write((text or "").encode())

    def do_PUT(self):
        self._answer("secret")

    def do_GET(self):
        known = self.headers.get("X-aws-ec2-metadata-token") == "secret"
        if known and self.path.endswith("instance-identity/document"):
            return self._answer(json.dumps({"instanceId": "i-1", "region": "r"}))
        self._answer(json.dumps({"action": "terminate"}) if known and Metadata.taken else None)

    def log_message(self, *args):
        pass


def test_instance_probes():
    server = HTTPServer(("127.0.0.1", 0), Metadata)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base, told = f"http://127.0.0.1:{server.server_port}/latest", []
    assert instance.identity(base) == {"instanceId": "i-1", "instanceType": None, "availabilityZone": None, "region": "r"}
    assert instance.notice(base) is None
    watcher = instance.Watcher(base, told.append, seconds=0.05)
    watcher.start()
    Metadata.taken = True
    watcher.join(5)
    watcher.close()
    assert told == [{"action": "terminate"}]
    server.shutdown()
    server.server_close()
    assert instance.identity(base, 0.5) == dict.fromkeys(instance.FIELDS)
    assert instance.notice("not an address") is None


def test_warp_of_a_turned_raster_and_its_edges(spark):
    turn = lambda pixel, line: (500000.0 + 8 * pixel + 6 * line, 5700000.0 + 6 * pixel - 8 * line)
    places = [(1, p, l, *turn(p, l)) for p in (0, 10, 20) for l in (0, 10, 20)]
    points = spark.createDataFrame(places, "scene int, pixel int, line int, x double, y double").withColumn("p", projection.inverse(F.col("x"), F.col("y"), F.lit(32631)))
    points = points.select("scene", "pixel", "line", "p.lon", "p.lat")
    fits = warp.fitted(points.unionByName(spark.createDataFrame([(1, None, 1, 0.0, 0.0)], points.schema)), ["scene"], 32631)
    rows = spark.createDataFrame([(1, 7, r, [float(r), None, float("nan"), *[float(r)] * 17]) for r in range(20)] + [(2, 7, 0, [1.0])], "scene int, item int, row int, values array<double>")
    terms = (20.0, 0.0, 500000.0, 0.0, -20.0, 5700200.0)
    found = {(r.y, r.x): r for r in warp.warped(rows, fits, ["scene"], ["item"], terms, 20, 20).collect()}
    sums: dict = {}
    for row in range(20):
        for col in range(20):
            x, y = turn(col + 0.5, row + 0.5)
            x, y = (x - 500000) / 20, (5700200 - y) / 20
            for cy in range(20):
                for cx in range(20):
                    w = max(0.0, min(x + 0.35, cx + 1) - max(x - 0.35, cx)) * max(0.0, min(y + 0.35, cy + 1) - max(y - 0.35, cy))
                    if w > 1e-12:
                        s = sums.setdefault((cy, cx), [0.0, 0.0, 0.0])
                        s[2] += w
                        if col not in (1, 2):
                            s[0], s[1] = s[0] + w * row, s[1] + w
    assert set(found) == set(sums)
    for cell, (v, w, every) in sums.items():
        assert found[cell].fraction == pytest.approx(w / every, abs=1e-4)
        assert (found[cell].value is None) == (w == 0) and (not w or found[cell].value == pytest.approx(v / w, abs=1e-3))
    with pytest.raises(ValueError, match="rotated"):
        warp.warped(rows, fits, ["scene"], ["item"], (20.0, 1.0, 0.0, 0.0, -20.0, 0.0), 2, 2)
    with pytest.raises(Exception, match="place a raster"):
        warp.fitted(points.limit(2), ["scene"], 32631).collect()
    assert warp.warped(rows.limit(0), fits, ["scene"], ["item"], terms, 20, 20).count() == 0


def test_reports_hold_whole_records(spark, tmp_path):
    records = items.inspection_records(adapters.items(spark, "/root/testdata/sf0.001"), adapters.coverages(spark, "/root/testdata/sf0.001")).withColumn("item_id", F.col("item_id").cast("string"))
    whole = records.agg(F.to_json(F.struct(F.lit("30UXC").alias("tile"), F.collect_list(F.struct(*records.columns)).alias("items"))).alias("j")).first().j
    (tmp_path / "r.json").write_text(whole)
    read = reports.report_items(spark, str(tmp_path / "r.json"))
    assert read.columns == ["tile", *records.columns]
    key = lambda r: r.item_id
    assert [r.asDict(True) for r in sorted(read.drop("tile").collect(), key=key)] == [r.asDict(True) for r in sorted(records.collect(), key=key)]


def test_console_lines():
    report = {"raster": {"size": [128, 64], "mean": 0.123456789, "crs": None, "tags": {}}, "points": [{"n": 1}, {"n": 2}], "ok": True}
    assert reports.console(report) == ["raster.size: 128, 64", "raster.mean: 0.123457", "raster.crs: none", "raster.tags: none", "points[0].n: 1", "points[1].n: 2", "ok: True"]
