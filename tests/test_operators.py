"""Edge cases of operators that SQL doesn't cover."""

from __future__ import annotations

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from swathline.functions import checksum, geometry, radiometry, text
from swathline.operators import catalogue, jobs, luts, raster
from swathline.sources import annotations, records, reports


def test_crc_vector():
    assert checksum.crc32c(b"123456789") == 0xE3069283


def test_record_files_round_trip_and_detect_damage(spark, tmp_path):
    rows = [{"x": i} for i in range(5)]
    data = records.bundle(rows, 2)
    path = tmp_path / "a.rec"
    path.write_bytes(data)
    records.register(spark)
    read = spark.read.format("records").option("paths", json.dumps([str(path)])).load().orderBy("chunk_index").collect()
    assert [r.kind for r in read] == ["metadata", "chunk", "chunk", "chunk"]
    assert [x for r in read[1:] for x in json.loads(r.payload)["rows"]] == rows
    with pytest.raises(EOFError):
        list(records.frames(data[:-1]))
    broken = bytearray(data)
    broken[20] ^= 1
    with pytest.raises(ValueError):
        list(records.frames(bytes(broken)))


def test_inventory_forms():
    assert [t for _, t in reports.inventory("- T30UXC\n- 'b'\n")] == ["T30UXC", "b"]
    assert [t for _, t in reports.inventory("sentinel2_tiles: [a, \"b\"]")] == ["a", "b"]


def test_tiles_and_polarisations(spark):
    row = spark.range(1).select(
        text.tile(F.lit(" t30uxc ")).alias("a"), text.tile(F.lit("30UX")).alias("b"), text.tile_epsg(F.lit("30UXC")).alias("c"),
        text.polarisations(F.array(F.lit(" vh"), F.lit("VV"), F.lit("xx"), F.lit("vv"), F.lit(""))).alias("d"), text.polarisations(F.lit(None).cast("array<string>")).alias("e"),
    ).first()
    assert tuple(row) == ("30UXC", None, 32630, ["VV", "VH", "XX"], [])
    with pytest.raises(ValueError):
        text.thresholds("1.5")


def test_radiometry_edges(spark):
    rows = spark.createDataFrame([(2.0, True, 1.0, 1.0), (1.0, True, 2.0, 5.0), (float("nan"), True, 1.0, 1.0), (2.0, True, 1.0, 0.0), (2.0, False, 1.0, 1.0), (3.0, True, 0.0, 1.0)], "m double, ok boolean, lut double, noise double")
    valid = radiometry.source_valid(F.col("m"), F.col("ok"), F.lit(-1.0))
    stages = radiometry.chain(F.col("m"), valid, F.col("lut"), F.col("noise"), F.lit(False))
    found = rows.select(*[c.alias(n) for n, c in stages.items()]).collect()
    assert [r.valid for r in found] == [True, False, False, False, False, False]
    assert found[0].calibrated_linear == 3.0 and abs(found[0].calibrated_db - 10 * np.log10(3)) < 1e-5


def test_interpolation_matches_numpy(spark):
    rng = np.random.default_rng(3)
    lines, pixels = [0, 7, 20], [0, 3, 9]
    values = rng.random((3, 3))
    vectors = spark.createDataFrame([(n, pixels, v.tolist()) for n, v in zip(lines, values, strict=True)], "line bigint, pixels array<bigint>, lut array<double>")
    found = {r.row: r.values for r in luts.interpolated(vectors, 10).collect()}
    across = np.array([np.interp(range(10), pixels, v) for v in values])
    want = np.array([np.interp(range(21), lines, across[:, c]) for c in range(10)]).T
    assert sorted(found) == list(range(21))
    assert np.abs(np.array([found[r] for r in range(21)]) - want).max() < 1e-12
    assert luts.faults(vectors.limit(1)).count() == 1


def test_azimuth_sections(spark):
    sections = spark.createDataFrame([(0, 9, 0, 4, [0, 9], [1.0, 10.0])], "first_line bigint, last_line bigint, first_sample bigint, last_sample bigint, lines array<bigint>, lut array<double>")
    found = {r.row: r.value for r in luts.azimuth(sections, spark.range(12).withColumnRenamed("id", "row")).collect()}
    assert found == {i: pytest.approx(1.0 + i) for i in range(10)}


def test_average_of_an_even_split(spark):
    table = spark.createDataFrame([(0, 0, 1.0), (0, 1, 3.0), (1, 0, None), (1, 1, 5.0)], "row int, col int, value double")
    cell = raster.averaged(table, [], 2.0, 1, 1).first()
    assert cell.value == pytest.approx(3.0) and cell.fraction == pytest.approx(0.75)


def test_clipping(spark):
    square = np.array([[0, 0], [2, 0], [2, 2], [0, 2]], float)
    assert geometry.ring_area(geometry.clip(square, square + 1)) == pytest.approx(1.0)
    assert len(geometry.clip(square, square + 5)) == 0
    rows = spark.createDataFrame([([[0.0, 0.0], [2.0, 0.0], [2.0, 2.0], [0.0, 2.0]], None)], "tile array<array<double>>, scene array<array<double>>")
    assert rows.select(geometry.coverage("tile", "scene").alias("m")).first().m.reason.startswith("geometry")


def test_acceptance_rules(spark):
    passes = spark.createDataFrame([(1, True), (1, False), (2, True)], "item_id int, passed boolean")
    both = {rule: {r.item_id: r.accepted for r in catalogue.acceptance(passes, rule).collect()} for rule in ("any", "all", "report-only")}
    assert both == {"any": {1: True, 2: True}, "all": {1: False, 2: True}, "report-only": {1: None, 2: None}}


def test_empty_catalogue(spark):
    empty = spark.createDataFrame([], "item_id long, datetime_utc timestamp_ntz, end_datetime_utc timestamp_ntz, platform string, instrument_mode string, product_type string, orbit_state string, relative_orbit long, absolute_orbit long, polarisations array<string>, coverage double")
    found = catalogue.threshold_summary(catalogue.eligibility(catalogue.normalised(empty)), [0.5, 0.8]).collect()
    assert [(r.item_count, r.fraction) for r in found] == [(0, 0.0), (0, 0.0)]


def test_noise_formats(spark):
    legacy = "<n><noiseVectorList><noiseVector><line>0</line><pixel>0 1</pixel><noiseLut>1 2</noiseLut></noiseVector></noiseVectorList></n>"
    azimuth = "<n><noiseAzimuthVectorList><noiseAzimuthVector><line>0 1</line></noiseAzimuthVector></noiseAzimuthVectorList></n>"
    docs = spark.createDataFrame([(1, legacy), (2, "<n><a>1</a></n>")], "id int, document string")
    assert {r.id: r.format_name for r in annotations.noise(docs).collect()} == {1: "legacy_noise_vector", 2: "none"}
    with pytest.raises(Exception, match="azimuth noise without range noise"):
        annotations.noise(spark.createDataFrame([(1, azimuth)], "id int, document string")).collect()
    product = "<p:product xmlns:p='urn:p'><p:mode>IW</p:mode><p:numberOfLines>7</p:numberOfLines><p:thermalNoiseCorrectionPerformed>False</p:thermalNoiseCorrectionPerformed></p:product>"
    row = annotations.product(spark.createDataFrame([(product,)], "document string")).first()
    assert (row.mode, row.numberOfLines, row.thermalNoiseCorrectionPerformed, row.polarisation) == ("IW", 7, False, None)


def test_report_items(spark, tmp_path):
    (tmp_path / "r.json").write_text(json.dumps({"tile": "T30UXC", "items": [{"item_id": "a", "tile_coverage_fraction": 0.5}]}, indent=2))
    row = reports.report_items(spark, str(tmp_path / "r.json")).first()
    assert (row.tile, row.item_id, row.tile_coverage_fraction, row.platform) == ("T30UXC", "a", 0.5, None)


def test_stream_of_jobs(spark, tmp_path):
    from swathline.streaming import worker

    (tmp_path / "in").mkdir()
    (tmp_path / "in/1.txt").write_text('{"tile": "T30UXC", "mode": "IW"}\n"30UXD"\n{"tile": "30UXE", "mode": "EW"}\n')
    (tmp_path / "in/2.txt").write_text("t31uda\n")
    process = lambda valid: valid.select("tile", F.when(F.col("tile") == "30UXD", 1).otherwise(0).alias("code"), F.lit("").alias("log"))
    stream = worker.run(worker.messages(spark, str(tmp_path / "in")), {"mode": "IW"}, str(tmp_path / "out"), str(tmp_path / "c"), process)
    assert stream.awaitTermination(120)
    status = {r.tile: r.state for r in spark.read.parquet(str(tmp_path / "out/status")).collect()}
    assert status == {"30UXC": "complete", "30UXD": "failed", "31UDA": "complete"}
    assert spark.read.parquet(str(tmp_path / "out/dead")).first().faults == ["mode_mismatch"]


def test_batches(spark):
    found = jobs.batches(spark.range(25).withColumnRenamed("id", "ordinal")).groupBy("batch").count().collect()
    assert sorted(r["count"] for r in found) == [5, 10, 10]


def test_every_calibration_line_is_returned(spark):
    from swathline.plans.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    last = spark.read.parquet(f"{folder}/embeddings.parquet").agg(F.max("vec_id")).first()[0]
    counts = {r.row: r["count"] for r in QUERIES["lut_lines"](spark, folder).groupBy("row").count().collect()}
    assert counts == dict.fromkeys(range((last // 20 + 1) * 20 + 1), 64)


def test_every_candidate_in_order(spark):
    from swathline.plans.queries import QUERIES

    whole, first = ([r.item_id for r in QUERIES[name](spark, "/root/testdata/sf0.001").collect()] for name in ("all_candidates", "first_candidates"))
    scenes = QUERIES["eligibility"](spark, "/root/testdata/sf0.001").where("eligible AND (item_id * 7919) % 1001 >= 800")
    assert sorted(whole) == sorted(r.item_id for r in scenes.collect()) and len(whole) > 50 and whole[:50] == first


def test_every_id_is_requested(spark):
    from swathline.plans.inspections import QUERIES

    folder = "/root/testdata/sf0.001"
    orders, nations = (spark.read.parquet(f"{folder}/{name}.parquet").count() for name in ("orders", "nation"))
    found = [r.present for r in QUERIES["requested_all_ids"](spark, folder).collect()]
    assert len(found) == orders and set(found) == {True, False}
    assert QUERIES["items_by_all_ids"](spark, folder).count() == nations


def test_acquisition_keys_hold_whole_times(spark):
    rows = spark.sql("SELECT 1 AS item_id, TIMESTAMP_NTZ '2018-03-15 06:00:00' AS datetime_utc, TIMESTAMP_NTZ '2018-03-15 06:00:25.5' AS end_datetime_utc, 'Sentinel-1A' AS platform, 'iw' AS instrument_mode, 'GRD' AS product_type, '' AS orbit_state, 1L AS relative_orbit, 0L AS absolute_orbit, array('vh', 'vv') AS polarisations, 0.9D AS coverage")
    later = rows.selectExpr("2 AS item_id", "datetime_utc + INTERVAL 1 SECOND AS datetime_utc", *rows.columns[2:])
    bare = rows.selectExpr("3 AS item_id", "CAST(NULL AS TIMESTAMP_NTZ) AS datetime_utc", "CAST(NULL AS TIMESTAMP_NTZ) AS end_datetime_utc", "'' AS platform", "'' AS instrument_mode", *rows.columns[5:8], "21029L AS absolute_orbit", "CAST(array() AS array<string>) AS polarisations", "coverage")
    keys = [r.acquisition_key for r in catalogue.normalised(rows.unionByName(later).unionByName(bare)).orderBy("item_id").collect()]
    assert keys == ["sentinel-1a|2018-03-15T06:00:00Z|2018-03-15T06:00:25.500000Z|IW|missing|VV+VH", "sentinel-1a|2018-03-15T06:00:01Z|2018-03-15T06:00:25.500000Z|IW|missing|VV+VH", "missing|missing|missing|missing|21029|missing"]


def test_ends_of_a_processor(spark):
    rows = [(1, "Candidate scenes:           0", True), (1, "No acquisitions", True), (0, "No acquisitions", True), (0, None, False), (3, "Candidate scenes: 0", False), (1, "No eligible scenes passed", None)]
    found = spark.createDataFrame(rows, "code int, log string, written boolean").select(jobs.classified(F.col("code"), F.col("log"), F.col("written")).alias("e")).collect()
    assert [tuple(r.e) for r in found] == [("no_data", "no_sentinel1_data"), ("no_data", "no_sentinel1_data"), ("complete", None), ("failed", "unknown_failure"), ("failed", "processor_exit_3"), ("no_data", "no_sentinel1_data")]


def test_kinds_of_messages(spark):
    bodies = ['{"tile": "T30UXC"}', '{"tile": "", "tile_id": "30uxd"}', '"T30UXE"', "t30uxf", "12345", "[1,2]", "null", "true", "", None, "{broken", '{"tile": "30UXC", "mode": "EW"}']
    read = jobs.parsed(spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "i int, body string"), {"mode": "IW"}).orderBy("i")
    assert [r.tile for r in read.collect()] == ["30UXC", "30UXD", "30UXE", "30UXF", None, None, None, None, None, None, None, "30UXC"]
    assert [r.faults for r in read.collect()][-3:] == [["no_tile"], ["no_tile"], ["mode_mismatch"]]
    assert read._jdf.queryExecution().optimizedPlan().toString().count("parse_json") <= 2


def test_noise_values(spark):
    of = lambda *v: spark.createDataFrame([v], "legacy double, ranged double, azimuth double").select(radiometry.noise(*map(F.col, ("legacy", "ranged", "azimuth"))).alias("n")).first().n
    assert (of(2.0, None, None), of(None, 2.0, 3.0), of(0.0, None, None)) == (2.0, 6.0, 0.0)
    for wrong in ((None, 1.0, None), (None, None, 1.0), (None, None, None), (1.0, 1.0, None), (-1.0, None, None), (None, float("inf"), 1.0), (float("nan"), None, None)):
        with pytest.raises(Exception, match="noise"):
            of(*wrong)


def test_windows_are_not_extrapolated(spark):
    vectors = spark.createDataFrame([(0, [0, 9], [1.0, 10.0]), (10, [0, 9], [11.0, 20.0])], "line bigint, pixels array<bigint>, lut array<double>")
    found = {r.row: r["values"] for r in luts.window(vectors, (2, 4), (3, 5)).collect()}
    assert found == {2: pytest.approx([6.0, 7.0]), 3: pytest.approx([7.0, 8.0])}
    for rows, samples in (((0, 12), (0, 5)), ((-1, 3), (0, 5)), ((0, 3), (0, 11))):
        with pytest.raises(Exception, match="do not cover"):
            luts.window(vectors, rows, samples).collect()
    with pytest.raises(Exception, match="single vector"):
        luts.checked(vectors.limit(1)).collect()


def test_azimuth_sections_cover_and_agree(spark):
    kind = "first_line bigint, last_line bigint, first_sample bigint, last_sample bigint, lines array<bigint>, lut array<double>"
    make = lambda *rows: spark.createDataFrame(list(rows), kind)
    left, right = (0, 9, 0, 4, [0, 9], [1.0, 10.0]), (0, 9, 5, 9, [0, 9], [2.0, 11.0])
    found = {r.row: r["values"] for r in luts.azimuth_lines(make(left, right, left), (1, 3), (3, 7)).collect()}
    assert found == {1: pytest.approx([2.0, 2.0, 3.0, 3.0]), 2: pytest.approx([3.0, 3.0, 4.0, 4.0])}
    for sections, fault in ((make(left), "no azimuth section"), (make(left, (0, 9, 4, 9, [0, 9], [2.0, 11.0])), "conflict")):
        with pytest.raises(Exception, match=fault):
            luts.azimuth_lines(sections, (0, 10), (0, 10)).collect()


def test_malformed_annotations_are_errors(spark):
    vector = "<c><calibrationVectorList><calibrationVector><line>0</line><pixel>{}</pixel><sigmaNought>1 2</sigmaNought></calibrationVector></calibrationVectorList></c>"
    read = lambda text: annotations.calibration(spark.createDataFrame([(text,)], "document string")).collect()
    assert read(vector.format("0 4"))[0].lut == [1.0, 2.0]
    for wrong in ("<c><broken", vector.format("0 4 8"), vector.format("4 0")):
        with pytest.raises(Exception):
            read(wrong)


def test_masked_checksums_of_known_texts(spark):
    rows = spark.createDataFrame([("123456789",), ("",), (None,), ("a" * 100_000,)], "text string")
    found = [r.crc for r in rows.select(checksum.masked_crc(F.encode("text", "UTF-8")).alias("crc")).collect()]
    rotate = lambda crc: ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF
    crc = 0xFFFFFFFF
    for byte in b"a" * 100_000:
        crc ^= byte
        for _ in range(8):
            crc = crc >> 1 ^ (0x82F63B78 if crc & 1 else 0)
    assert found == [rotate(0xE3069283), rotate(0), None, rotate(crc ^ 0xFFFFFFFF)]


def test_quantiles_and_gaps_against_numpy(spark):
    draw = np.random.default_rng(8)
    values = np.concatenate([draw.normal(size=500).round(2), [1e9], np.full(300, 0.25)])
    counts = spark.createDataFrame([(float(v),) for v in values], "value double").groupBy("value").agg(F.count("*").alias("n"))
    for cells in (2, 4, 256):
        assert np.allclose(catalogue.quantiles(counts, (0.0, 0.05, 0.5, 0.95, 1.0), cells=cells).first().q, np.quantile(values, (0, 0.05, 0.5, 0.95, 1)))
    rows = [(i, f"2020-01-{1 + i // 7:02d} 0{i % 3}:00:00") for i in range(40)] + [(99, None)]
    scenes = spark.createDataFrame(rows, "item_id int, t string").select("item_id", F.expr("CAST(t AS TIMESTAMP_NTZ)").alias("datetime_utc"), F.lit(1.0).alias("coverage"))
    times = sorted({t for _, t in rows if t})
    found = {str(r.datetime_utc): str(r.before) for r in catalogue.gaps(scenes).where("before IS NOT NULL").collect()}
    assert found == dict(zip(times[1:], times, strict=False))
    same = scenes.where("item_id < 40").withColumn("datetime_utc", F.expr("TIMESTAMP_NTZ '2020-01-01 00:00:00'"))
    assert tuple(catalogue.longest_gap(same, 0.5).first()) == (0, 1, 0.0)


def test_places_follow_the_whole_order(spark):
    rows = spark.range(1000).withColumn("v", F.pmod(F.hash("id"), F.lit(50))).repartition(5)
    found = jobs.numbered(rows, F.desc("v"), "id").collect()
    want = sorted(found, key=lambda r: (-r.v, r.id))
    assert [r.place for r in want] == list(range(1000))
    assert jobs.numbered(rows.limit(0), "id").count() == 0


def test_lenient_text(spark):
    row = spark.range(1).select(
        text.upper_list(F.array(F.lit(" vv"), F.lit("VV"))).alias("a"), text.tile_parts(F.lit("t30uxc")).alias("b"), text.report_tile(F.lit("x"), path=F.lit("/a/t26skg_2025/r.json")).alias("c"), text.optional_integer(F.lit("x7")).alias("d"),
        text.truncated(F.lit(-3.7)).alias("e"), text.nanoseconds(F.lit("1970-01-01T00:00:01.5Z")).alias("f"), text.nanoseconds(F.lit(" ")).alias("g"), text.href_of(F.lit("/vsis3/b/k")).alias("h"), text.datetime_or_null(F.lit("soon")).alias("i"),
    ).first()
    assert (row.a, tuple(row.b), row.c, row.d, row.e, row.f, row.g, row.h, row.i) == ([" VV", "VV"], (30, "U", "XC"), "T26SKG", None, -3, 1_500_000_000, None, "s3://b/k", None)
    assert text.with_threshold([0.5, 0.8], 0.7) == [0.5, 0.7, 0.8]
    with pytest.raises(Exception, match="not a tile"):
        spark.range(1).select(text.tile_parts(F.lit("30UX"))).collect()


def test_band_orders(spark):
    from swathline.operators import audit

    accepted = spark.createDataFrame([("VH",), ("VV",), ("VH",), ("XX",)], "band string")
    assert audit.band_order(accepted, "union", text.POLARISATIONS) == ["VV", "VH"] and audit.band_order(accepted, "canonical", text.POLARISATIONS) == list(text.POLARISATIONS)
    with pytest.raises(ValueError):
        audit.band_order(accepted, "any", text.POLARISATIONS)
