"""Inspection of scenes, documents and pixels: what is missing, what is there, which window to look at, what differs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swathline.functions.text import blank_to_null

from .jobs import numbered

#: Documents of each polarisation, and the asset every scene has.  Fixed values.
SCHEMAS = ("product", "calibration", "noise")
MANIFEST = "safe-manifest"
ANCHORS, ENOUGH = 256, 0.25


def missing_assets(names: Column, polarisations: Column) -> Column:
    """Sorted asset names that a scene of these polarisations should have and hasn't; a null list of either counts as empty."""
    none = F.array().cast("array<string>")
    each = F.transform(F.coalesce(polarisations, none), F.lower)
    expected = F.flatten(F.transform(each, lambda p: F.array(p, *[F.concat(F.lit(f"schema-{s}-"), p) for s in SCHEMAS])))
    return F.array_sort(F.array_except(F.array_append(expected, F.lit(MANIFEST)), F.coalesce(names, none)))


def polarisation_warnings(declared: Column, available: Column) -> Column:
    """Warnings of polarisations that are declared only or available only."""

    def only(name: str, a: Column, b: Column) -> Column:
        rest = F.array_join(F.array_sort(F.array_except(a, b)), ",")
        return F.when(rest != "", F.concat(F.lit(f"{name}:"), rest))

    return F.array_compact(F.array(only("declared_polarisations_without_measurement_assets", declared, available), only("measurement_assets_without_declaration", available, declared)))


def _least(rows: DataFrame, order: Column) -> DataFrame:
    """The row that comes first, or a row of nulls if there is none."""
    return rows.agg(F.min_by(F.struct(*rows.columns), order).alias("s")).select("s.*")


def grid_item(items: DataFrame, tile: str, start: str, end: str) -> DataFrame:
    """The first item ``(zone, band, square, datetime_utc, item_id, assets map)`` of a tile within days; none, or one without ``blue``, is an error."""
    day = F.to_date("datetime_utc")
    of_tile = (F.col("zone") == int(tile[:2])) & (F.col("band") == tile[2]) & (F.col("square") == tile[3:])
    found = items.where(of_tile & (day >= F.lit(start).cast("date")) & (day <= F.lit(end).cast("date")))
    return _least(found, F.struct("datetime_utc", "item_id")).withColumn("item_id", F.when(F.col("assets")["blue"].isNotNull(), F.col("item_id")).otherwise(F.raise_error(F.lit(f"no grid item with a blue asset for {tile}"))))


def found_once(ids: DataFrame, items: DataFrame) -> DataFrame:
    """The items of the asked ids; an id that isn't there exactly once is an error."""
    counts = ids.distinct().join(items.groupBy("item_id").agg(F.count("*").alias("n")), "item_id", "left")
    checked = counts.select(F.when(F.col("n") == 1, F.col("item_id")).otherwise(F.raise_error(F.concat(F.lit("not found exactly once: "), F.col("item_id").cast("string")))).alias("item_id"))
    return items.join(checked, "item_id", "left_semi")


def ranked_tiles(tiles: DataFrame, most: int) -> DataFrame:
    """Tiles by falling overlap, then by name, at most ``most``."""
    return tiles.orderBy(F.desc("overlap_fraction"), "product_tile").limit(most)


def tile_summary(pairs: DataFrame, tiles: DataFrame, minimum: float, allowed: Column) -> DataFrame:
    """By tile of ``tiles``: scenes, those of enough coverage, and the best coverage among the allowed (0 if none)."""
    sums = pairs.groupBy("tile_id").agg(F.count("*").alias("items"), F.count_if(allowed & (F.col("coverage") >= minimum)).alias("qualifying"), F.max(F.when(allowed, F.col("coverage"))).alias("best"))
    joined = tiles.select("tile_id").join(sums, "tile_id", "left")
    return joined.select("tile_id", F.coalesce("items", F.lit(0)).alias("items"), F.coalesce("qualifying", F.lit(0)).alias("qualifying"), F.coalesce("best", F.lit(0.0)).alias("best"))


def noise_statistics(rows: DataFrame, by: Sequence[str], arrays: Sequence[str]) -> DataFrame:
    """Least and largest noise and how many values are positive, over all the array columns; arrays are reduced in place, not exploded."""
    whole = F.filter(F.flatten(F.array(*[F.coalesce(a, F.array().cast("array<double>")) for a in arrays])), lambda v: v.isNotNull())
    each = rows.withColumn("noise", whole)
    positive = F.size(F.filter("noise", lambda v: v > 0))
    return each.groupBy(*by).agg(F.min(F.array_min("noise")).alias("lowest"), F.max(F.array_max("noise")).alias("highest"), F.sum(positive).cast("long").alias("n_positive"))


def element_counts(documents: DataFrame, by: Sequence[str], column: str = "document") -> DataFrame:
    """Elements of XML documents by local name; comments and character data hold none."""
    plain = F.regexp_replace(F.col(column), r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>", "")
    names = F.regexp_extract_all(plain, F.lit(r"<(?:[A-Za-z_][\w.-]*:)?([A-Za-z_][\w.-]*)"), F.lit(1))
    return documents.select(*by, F.explode(names).alias("element")).groupBy(*by, "element").agg(F.count("*").alias("n"))


def first_text(document: Column, name: str) -> Column:
    """The first text of elements of a local name that isn't blank."""
    found = F.xpath(document, F.lit(f"//*[local-name()='{name}']/text()"))
    return F.get(F.filter(F.transform(found, lambda t: F.trim(t)), lambda t: t != ""), F.lit(0))


def vector_summary(vectors: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Vectors, the lines they span and the samples they span."""
    return vectors.groupBy(*by).agg(F.count("*").alias("n_vectors"), F.min("line").alias("first_line"), F.max("line").alias("last_line"), F.min(F.array_min("pixels")).alias("first_pixel"), F.max(F.array_max("pixels")).alias("last_pixel"))


def preview(rows: DataFrame, height: int, width: int, size: int) -> DataFrame:
    """A raster's rows and samples nearest to ``size`` by ``size`` cell centres, as ``(y, values)``; a smaller raster stays as it is.

    The rows wanted are a filter on the row number and the samples an array of indexes, so other rows aren't shuffled or unpacked.
    """
    tall, wide = min(size, height), min(size, width)
    place = lambda i, full, small: F.floor((i.cast("double") + 0.5) * full / small)
    # the cell a row would be picked for; it is picked where the cell's centre falls in it
    y = F.ceil(F.col("row") * F.lit(tall) / F.lit(height) - 0.5 - 1e-9)
    chosen = rows.withColumn("y", y).where(F.col("y").between(0, tall - 1) & (place(F.col("y"), height, tall) == F.col("row")))
    picked = F.transform(F.sequence(F.lit(0), F.lit(wide - 1)), lambda i: F.get("values", place(i, width, wide).cast("int")))
    return chosen.withColumn("values", picked)


def placed_window(line: Column, pixel: Column, height: int, width: int, size: int) -> Column:
    """A window ``[row_start, row_stop) x [column_start, column_stop)`` around a place, moved inside the raster."""

    def start(at: Column, full: int, side: int) -> Column:
        return F.greatest(F.lit(0), F.least(at - side // 2, F.lit(full - side)))

    if not 0 < size <= min(height, width):
        raise ValueError(f"a window of {size} does not fit a raster of {height} by {width}")
    top, left = start(line, height, size), start(pixel, width, size)
    return F.struct(top.alias("row_start"), (top + size).alias("row_stop"), left.alias("column_start"), (left + size).alias("column_stop"))


def best_window(windows: DataFrame, anchors: int = ANCHORS, enough: float = ENOUGH) -> DataFrame:
    """Of ``windows(rank, valid_fraction)``: the first with enough valid samples among the first ``anchors``; none is an error."""
    best = _least(windows.where((F.col("rank") < anchors) & (F.col("valid_fraction") >= enough)), F.col("rank"))
    return best.withColumn("rank", F.coalesce("rank", F.raise_error(F.lit("no window holds enough valid samples")).cast("int")))


def ranked(rows: DataFrame, *order: Column | str) -> DataFrame:
    """``rank`` from 0."""
    return numbered(rows, *order, name="rank").withColumn("rank", F.col("rank").cast("int"))


def violations(rows: DataFrame, pairs: dict[str, tuple[Column, Column, float, float]]) -> DataFrame:
    """For each named equation ``(left, right, relative, absolute)``: rows where one side is null alone or both differ by more."""

    def wrong(left: Column, right: Column, relative: float, absolute: float) -> Column:
        left, right = left.cast("double"), right.cast("double")
        far = F.abs(left - right) > absolute + relative * F.abs(right)
        return F.count_if((left.isNull() != right.isNull()) | F.coalesce(far, F.lit(False)))

    return rows.agg(*[wrong(*p).alias(name) for name, p in pairs.items()])


def differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that one table has more often than the other, and which; no row means that both are equal as bags."""
    if sorted(left.columns) != sorted(right.columns):
        raise ValueError(f"columns differ: {sorted(set(left.columns) ^ set(right.columns))}")
    right = right.select(*left.columns)
    return left.exceptAll(right).withColumn("only_in", F.lit("left")).unionByName(right.exceptAll(left).withColumn("only_in", F.lit("right")))


def required_texts(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which a required column is null or blank, with the names of those."""
    blank = F.array_compact(F.array(*[F.when(blank_to_null(F.col(c).cast("string")).isNull(), F.lit(c)) for c in columns]))
    return rows.withColumn("blank", blank).where(F.size("blank") > 0)
