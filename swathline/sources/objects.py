"""Whole objects: bytes of files by href, their digests, and records of a run."""

from __future__ import annotations

import json
import subprocess
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Schemes of hrefs that can be read.  Fixed values.
SCHEMES = ("s3", "s3a", "http", "https", "file", "hdfs")


def scheme_checked(href: Column) -> Column:
    """An href, where its scheme can be read; any other is an error, and a path without one stays."""
    scheme = F.regexp_extract(href, "^([A-Za-z][A-Za-z0-9+.-]*)://", 1)
    return F.when((scheme == "") | F.lower(scheme).isin(*SCHEMES), href).otherwise(F.raise_error(F.concat(F.lit("unsupported scheme: "), href)).cast("string"))


def contents(spark: SparkSession, *paths: str) -> DataFrame:
    """``(path, n_bytes, sha256, content)`` of files, each read whole by one task; an unknown scheme is an error at once."""
    for path in paths:
        if "://" in path and path.split("://")[0].lower() not in SCHEMES:
            raise ValueError(f"unsupported scheme: {path}")
    read = spark.read.format("binaryFile").load(list(paths))
    return read.select("path", F.col("length").alias("n_bytes"), F.sha2("content", 256).alias("sha256"), "content")


def dump(objects: DataFrame, path: str) -> None:
    """``objects(name, content)`` kept verbatim in one table."""
    objects.select("name", F.col("content").cast("binary").alias("content")).write.mode("overwrite").parquet(path)


def utc_now() -> str:
    return datetime.now(timezone.utc).isoformat(timespec="seconds").replace("+00:00", "Z")


def revision(folder: str) -> str | None:
    """The commit that a folder's work tree is at, if it is one."""
    try:
        return subprocess.run(["git", "-C", folder, "rev-parse", "HEAD"], capture_output=True, text=True, timeout=10, check=True).stdout.strip() or None
    except (OSError, subprocess.SubprocessError):
        return None


def write_manifest(spark: SparkSession, path: str, run_id: str, settings: dict, folder: str | None = None) -> bool:
    """Write a run's manifest, one JSON document, unless the run has one; whether it was written."""
    files = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/run={run_id}", "_SUCCESS")):
        return False
    document = json.dumps({"run_id": run_id, "started_utc": utc_now(), "settings": settings, "revision": revision(folder) if folder else None}, indent=2, sort_keys=True)
    spark.createDataFrame([(document,)], "value string").coalesce(1).write.mode("overwrite").option("lineSep", "\n").text(f"{path}/run={run_id}")
    return True


def status_document(status: DataFrame) -> DataFrame:
    """``(tile, document)``: each status row as JSON with its keys in order, without the fields that are null or empty lists."""
    names = sorted(status.columns)
    value = lambda c: F.when(F.size(c) > 0, F.col(c)) if status.schema[c].dataType.typeName() == "array" else F.col(c)
    return status.select("tile", F.to_json(F.struct(*[value(c).alias(c) for c in names])).alias("document"))


def write_report(spark: SparkSession, path: str, report: dict) -> None:
    """A report as one JSON document, indented and with its keys sorted; what JSON doesn't know is written as text."""
    document = json.dumps(report, indent=2, sort_keys=True, default=str)
    spark.createDataFrame([(document,)], "value string").coalesce(1).write.mode("overwrite").text(path)
