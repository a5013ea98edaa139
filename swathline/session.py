"""Session settings the engine expects."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession

#: Settings that results or plans depend on; cluster settings (memory, shuffle partitions) are the deployment's own.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(app: str = "swathline", **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def kept(rows: DataFrame) -> DataFrame:
    """``rows`` computed once and written to the checkpoint folder, so that a lost executor changes nothing; a local session may lack that folder's setting."""
    spark = rows.sparkSession
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(folder or tempfile.mkdtemp(prefix="swathline-"))
    return rows.checkpoint(eager=True)
