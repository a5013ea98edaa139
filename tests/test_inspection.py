"""Inspection operators and array bundles where SQL doesn't reach: errors, edges and round trips."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from swathline.operators import inspection, luts
from swathline.sources import arrays


def test_missing_assets_of_nulls(spark):
    none = F.lit(None).cast("array<string>")
    row = spark.range(1).select(inspection.missing_assets(none, none).alias("a"), inspection.missing_assets(F.array(F.lit("vv"), F.lit("safe-manifest")), F.array(F.lit("VV"))).alias("b")).first()
    assert (row.a, row.b) == (["safe-manifest"], ["schema-calibration-vv", "schema-noise-vv", "schema-product-vv"])


def test_lookups_fail_where_nothing_is_found(spark):
    items = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "item_id int, x string")
    assert inspection.found_once(items.where("item_id = 1").select("item_id"), items).first().x == "a"
    for wanted in (2, 3):
        with pytest.raises(Exception, match="not found exactly once"):
            inspection.found_once(spark.createDataFrame([(wanted,)], "item_id int"), items).collect()
    grid = spark.createDataFrame([(1, 30, "U", "XC", "2018-03-15", {"red": "r"})], "item_id int, zone int, band string, square string, datetime_utc string, assets map<string,string>")
    for day in ("2018-03-15", "2019-01-01"):
        with pytest.raises(Exception, match="no grid item"):
            inspection.grid_item(grid, "30UXC", day, day).collect()
    with pytest.raises(Exception, match="no window"):
        inspection.best_window(spark.createDataFrame([(0, 0.2), (300, 1.0)], "rank int, valid_fraction double")).collect()


def test_windows_stay_inside(spark):
    places = spark.createDataFrame([(0, 0), (9, 9), (5, 4)], "line int, pixel int")
    found = places.select(inspection.placed_window(F.col("line"), F.col("pixel"), 10, 10, 4).alias("w")).select("w.*").collect()
    assert [tuple(r) for r in found] == [(0, 4, 0, 4), (6, 10, 6, 10), (3, 7, 2, 6)]
    with pytest.raises(ValueError):
        inspection.placed_window(F.lit(1), F.lit(1), 3, 10, 4)


@pytest.mark.parametrize("height", [1, 5, 16, 48, 100])
def test_preview_takes_every_cell(spark, height):
    rows = spark.range(height).select(F.col("id").alias("row"), F.transform(F.sequence(F.lit(0), F.lit(29)), lambda c: (F.col("id") * 100 + c).cast("float")).alias("values"))
    found = {r.y: r["values"] for r in inspection.preview(rows, height, 30, 16).collect()}
    tall = min(height, 16)
    assert found == {y: [float(int((y + 0.5) * height / tall) * 100 + int((x + 0.5) * 30 / 16)) for x in range(16)] for y in range(tall)}


def test_anchors_rank_by_interior_then_centre(spark):
    rows = spark.createDataFrame([(4, 4, 1.0), (3, 3, 1.0), (3, 4, 2.0), (6, 4, 9.0), (3, 3, 0.5), (0, 0, 5.0), (4, 4, -1.0)], "line int, pixel int, noise double")
    found = luts.noise_anchors(rows, 8, 8, 4).select("line", "pixel", "noise", "interior").collect()
    assert [tuple(r) for r in found] == [(3, 4, 2.0, True), (3, 3, 1.0, True), (4, 4, 1.0, True), (6, 4, 9.0, False), (0, 0, 5.0, False)]


def test_equations_and_differences(spark):
    rows = spark.createDataFrame([(1.0, 1.0), (1.0, 1.1), (None, 1.0), (None, None)], "a double, b double")
    assert inspection.violations(rows, {"e": (F.col("a"), F.col("b"), 0.0, 0.05)}).first().e == 2
    assert inspection.violations(rows.limit(0), {"e": (F.col("a"), F.col("b"), 0.0, 0.05)}).first().e == 0
    assert inspection.differences(rows, rows).isEmpty()
    with pytest.raises(ValueError):
        inspection.differences(rows, rows.select("a"))


def test_elements_and_texts(spark):
    document = "<s:p xmlns:s='u'><!-- <x/> --><![CDATA[<y/>]]><s:q> </s:q><q>2</q></s:p>"
    rows = spark.createDataFrame([(document,), (None,)], "document string")
    assert {(r.element, r.n) for r in inspection.element_counts(rows, []).collect()} == {("p", 1), ("q", 2)}
    assert [r[0] for r in rows.select(inspection.first_text(F.col("document"), "q")).collect()] == ["2", None]


def test_bundles_round_trip(spark, tmp_path):
    cells = spark.createDataFrame(
        [("T1", "b", 1521072000123456789, 7, "VV", 0, 1, 2.5), ("T1", "a", 10, None, "VH", 1, 0, 1.5), ("T1", "a", 10, None, "HH", 0, 0, 9.0)],
        "tile string, item_id string, time_ns long, orbit long, band string, y int, x int, value double",
    )
    row = arrays.scene_bundles(cells, ["VV", "VH"], 2, 2).first()
    (tmp_path / "T1.npz").write_bytes(row.content)
    read = arrays.bundles(spark, str(tmp_path))
    found = {r.name: r for r in read.collect()}
    assert found["values"].shape == [2, 2, 2, 2] and found["orbit"].integers == [-1, 7] and found["item_id"].texts == ["a", "b"] and found["band"].texts == ["VV", "VH"]
    assert found["time"].integers == [10, 1521072000123456789]
    values = np.array(found["values"].numbers, float).reshape(2, 2, 2, 2)
    assert values[0, 1, 0, 1] == 1.5 and values[1, 0, 1, 0] == 2.5 and np.isfinite(values).sum() == 2
    assert [r.reason for r in arrays.faults(read, {"orbit": ["time"], "band": ["time"], "gone": ["time"]}).collect()] == ["gone is missing"]
    assert arrays.faults(read, {"values": ["time", "band"]}).first().reason == "values has another shape than time, band"
    with pytest.raises(TypeError):
        arrays.packed({"a": np.array([None])})


def test_array_records_round_trip_and_refuse_damage(spark, tmp_path):
    from swathline.sources import objects, records

    cube = np.random.default_rng(1).random((5, 3, 2)).astype(np.float32)
    cube[0, 0, 0] = np.nan
    held = {"values": cube, "x": np.arange(3.0), "item_id": np.array(["a", "", "c", "d", "é"])}
    dims = {"values": ("time", "x", "band"), "x": ("x",), "item_id": ("time",)}
    for dim, size, chunks in (("time", 2, 3), ("time", 99, 1), (None, None, 1), ("band", 1, 2)):
        manifest, read = records.array_bundle_of(records.array_bundle(held, dims, dim, size))
        assert manifest["n_chunks"] == chunks and read.keys() == held.keys()
        assert all(read[k].dtype == held[k].dtype and np.array_equal(read[k], held[k], equal_nan=k == "values") for k in held)
    data = records.array_bundle(held, dims, "time", 2)
    parts = list(records.frames(data))
    shuffled = b"".join(map(records.frame, (parts[0], *parts[:0:-1])))
    assert np.array_equal(records.array_bundle_of(shuffled)[1]["values"], cube, equal_nan=True)
    for wrong in (b"".join(map(records.frame, parts[1:])), b"".join(map(records.frame, parts[:-1])), b"".join(map(records.frame, [*parts, parts[-1]]))):
        with pytest.raises(ValueError):
            records.array_bundle_of(wrong)
    with pytest.raises(ValueError):
        records.array_bundle(held, dims | {"x": ("time",)}, "time")
    rows = spark.createDataFrame([("T1", data), ("T2", data[:-1])], "tile string, content binary")
    written = {r.tile: r for r in records.write_bundles(rows, str(tmp_path / "out")).collect()}
    again = {r.path.split("/")[-1]: r for r in objects.contents(spark, str(tmp_path / "out")).collect()}
    assert sorted(again) == ["T1.tfrecord", "T2.tfrecord"]
    assert bytes(again["T1.tfrecord"].content) == data and again["T1.tfrecord"].sha256 == written["T1"].sha256 and written["T1"].n_bytes == len(data)


def test_objects_manifests_and_reports(spark, tmp_path):
    import json

    from swathline.sources import objects

    with pytest.raises(ValueError):
        objects.contents(spark, "ftp://h/x")
    hrefs = spark.createDataFrame([("s3://b/k",), ("/a/b",)], "h string")
    assert [r.h for r in hrefs.select(objects.scheme_checked(F.col("h")).alias("h")).collect()] == ["s3://b/k", "/a/b"]
    with pytest.raises(Exception, match="unsupported scheme"):
        hrefs.limit(1).select(objects.scheme_checked(F.lit("ftp://h/x"))).collect()
    objects.dump(spark.createDataFrame([("a.xml", b"<a/>")], "name string, content binary"), str(tmp_path / "dump"))
    assert tuple(spark.read.parquet(str(tmp_path / "dump")).first()) == ("a.xml", b"<a/>")
    assert objects.write_manifest(spark, str(tmp_path / "m"), "r1", {"b": 1, "a": 2}) and not objects.write_manifest(spark, str(tmp_path / "m"), "r1", {})
    text = "\n".join(r.value for r in spark.read.text(str(tmp_path / "m/run=r1")).collect())
    assert json.loads(text)["settings"] == {"a": 2, "b": 1} and objects.utc_now().endswith("Z") and objects.revision("/") is None
    status = spark.createDataFrame([("T1", "failed", None, ["x"]), ("T2", "complete", None, [])], "tile string, state string, reason string, log_tail array<string>")
    assert {r.tile: json.loads(r.document) for r in objects.status_document(status).collect()} == {"T1": {"tile": "T1", "state": "failed", "log_tail": ["x"]}, "T2": {"tile": "T2", "state": "complete"}}
    objects.write_report(spark, str(tmp_path / "r"), {"b": [1], "a": {"d": 1, "c": None}})
    assert json.loads("\n".join(r.value for r in spark.read.text(str(tmp_path / "r")).collect())) == {"a": {"c": None, "d": 1}, "b": [1]}


def test_polygons_of_parts_and_holes(spark):
    from swathline.functions import geometry
    from swathline.operators import spatial

    ring = lambda x, y, s: [[float(a), float(b)] for a, b in ((x, y), (x + s, y), (x + s, y + s), (x, y + s))]
    kind = "tile array<array<double>>, scene array<array<array<array<double>>>>"
    rows = [(ring(0, 0, 10), [[ring(0, 0, 10), ring(2, 2, 4)]]), (ring(0, 0, 10), [[ring(-5, 0, 10)], [ring(8, 8, 4)]]), (ring(0, 0, 10), [[ring(20, 20, 2)]]), (ring(0, 0, 10), None), (ring(0, 0, 10), [])]
    found = [r.m for r in spark.createDataFrame(rows, kind).select(geometry.multi_coverage("tile", "scene").alias("m")).collect()]
    assert [round(m.coverage, 9) for m in found] == [0.84, 0.54, 0.0, 0.0, 0.0] and [round(m.area, 9) for m in found[:2]] == [84.0, 54.0] and all(m.reason for m in found[3:])
    tiles = spark.createDataFrame([(1, ring(0, 0, 10))], "tile_id int, tile_ring array<array<double>>")
    scenes = spark.createDataFrame([(1, [[0.0, 0.0], [10.0, 0.0], [0.0, 10.0]]), (2, [[12.0, 0.0], [12.0, 12.0], [0.0, 12.0]]), (3, [[1.0, 1.0]])], "scene_id int, scene_ring array<array<double>>")
    pairs = spark.createDataFrame([(1, i) for i in (1, 2, 3)], "tile_id int, scene_id int")
    assert {(r.scene_id, round(r.area, 6), r.reason is None) for r in spatial.refined(pairs, tiles, scenes).collect()} == {(1, 50.0, True), (2, 32.0, True), (3, 0.0, False)}


def test_grid_documents(spark):
    from swathline.functions import geometry

    grid = F.struct(F.lit("EPSG:32630").alias("crs"), F.array(F.lit(20), F.lit(20)).alias("native_shape"), F.array(*map(F.lit, (1.0, 0.0, 5.0, 0.0, -1.0, 9.0))).alias("native_transform"), F.array(F.lit(8), F.lit(8)).alias("output_shape"), F.array(*map(F.lit, (2.5, 0.0, 5.0, 0.0, -2.5, 9.0))).alias("output_transform"))
    row = spark.range(1).select(geometry.grid_of(geometry.grid_document(grid)).alias("g")).first().g
    assert (row.crs, list(row.output_shape), list(row.output_transform)) == ("EPSG:32630", [8, 8], [2.5, 0.0, 5.0, 0.0, -2.5, 9.0])
    with pytest.raises(Exception, match="not a grid"):
        spark.range(1).select(geometry.grid_of(F.lit('{"native_shape": [1], "native_transform": [1, 2, 3, 4, 5, 6], "output_shape": [1, 1], "output_transform": [1, 2, 3, 4, 5, 6]}'))).collect()


def test_documents_that_disagree(spark):
    from swathline.sources import annotations

    kind = "item_id int, polarisation string, productType string, mode string"
    one = spark.createDataFrame([(1, "VV", "GRD", "IW"), (2, "VV", "GRD", None), (3, "VH", "GRD", "IW")], kind)
    two = spark.createDataFrame([(1, "VV", "GRD", "IW"), (2, "VV", None, "EW"), (3, "VV", "SLC", "IW")], kind)
    assert {r.item_id: r.disagree for r in annotations.consistent(one, two, ["item_id"]).collect()} == {3: ["polarisation", "productType"]}


def test_tiles_without_a_valid_cell_are_refused(spark):
    from swathline.operators import raster

    grid = spark.createDataFrame([(1, 2.0), (1, None)], "item_id int, value double")
    assert raster.validated(grid, ["item_id"]).first().n_finite == 1
    with pytest.raises(Exception, match="no valid cells"):
        raster.validated(grid.where("value IS NULL"), ["item_id"]).collect()
