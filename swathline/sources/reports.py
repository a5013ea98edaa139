"""Report documents and tile inventories in, JSON and CSV reports out."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The fields of a report's items, as ``items.inspection_records`` makes them.
ITEM = (
    "item_id string, collection string, datetime_utc string, start_datetime_utc string, end_datetime_utc string, year int, platform string, constellation string, instrument_mode string, product_type string, orbit_state string, "
    "relative_orbit bigint, absolute_orbit bigint, declared_polarisations array<string>, available_polarisations array<string>, polarisation_combination string, measurement_assets map<string,string>, "
    "metadata_assets map<string,struct<product:string,calibration:string,noise:string>>, "
    "polarisation_assets array<struct<polarisation:string,measurement_href:string,product_href:string,calibration_href:string,noise_href:string,missing:array<string>>>, safe_manifest_href string, "
    "missing_metadata_assets array<string>, intersection_area_projected_units double, tile_coverage_fraction double, tile_coverage_pct double, scene_overlap_fraction double, scene_overlap_pct double, "
    "eligible_before_coverage boolean, eligibility_rejection_reasons array<string>, warnings array<string>, provisional_acquisition_key string"
)
REPORT = f"tile string, items array<struct<{', '.join(re.sub(r'^(\w+) ', r'\1: ', f) for f in re.split(r', (?=\w+ )', ITEM))}>>"


def report_items(spark: SparkSession, path: str) -> DataFrame:
    """The items of report documents, one row each, with a fixed schema."""
    return spark.read.option("multiLine", True).schema(REPORT).json(path).select("tile", F.explode("items").alias("i")).select("tile", "i.*")


def inventory(text: str) -> list[tuple[int, str]]:
    """``(ordinal, tile)`` of a YAML list of names, plain or under the key ``sentinel2_tiles``."""
    lines = [line.split("#")[0].rstrip() for line in text.splitlines()]
    names: list[str] = []
    for line in lines:
        if found := re.fullmatch(r"\s*-\s*[\"']?([^\"']+?)[\"']?", line):
            names.append(found[1])
        elif flow := re.fullmatch(r"(?:\s*sentinel2_tiles\s*:)?\s*\[(.*)\]", line):
            names += [n.strip().strip("\"'") for n in flow[1].split(",") if n.strip()]
    return list(enumerate(names))


def sorted_json(values: Column) -> Column:
    """A map of counts as JSON text with sorted keys."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(values))))


def write_csv(table: DataFrame, path: str, columns: Sequence[str], encode: Sequence[str] = ()) -> None:
    """The columns in order, with a header; those of ``encode`` as JSON.  A report is small, so it is one file."""
    table.select(*[F.to_json(c).alias(c) if c in encode else c for c in columns]).coalesce(1).write.mode("overwrite").csv(path, header=True)


def write_json(table: DataFrame, path: str) -> None:
    """One JSON object a row, its keys sorted."""
    table.select(*sorted(table.columns)).coalesce(1).write.mode("overwrite").json(path)


def console(report: dict, name: str = "") -> list[str]:
    """A report's values as lines to print, one ``path: value`` each in the order they have; lists of plain values stay on one line."""
    lines: list[str] = []
    for key, value in report.items():
        path = f"{name}.{key}" if name else str(key)
        if isinstance(value, dict):
            lines += console(value, path) or [f"{path}: none"]
        elif isinstance(value, (list, tuple)) and any(isinstance(v, dict) for v in value):
            lines += [line for i, v in enumerate(value) for line in (console(v, f"{path}[{i}]") if isinstance(v, dict) else [f"{path}[{i}]: {v}"])]
        else:
            shown = f"{value:.6g}" if isinstance(value, float) else "none" if value is None else ", ".join(map(str, value)) if isinstance(value, (list, tuple)) else value
            lines.append(f"{path}: {shown}")
    return lines
