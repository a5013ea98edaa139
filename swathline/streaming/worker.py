"""The job stream: messages arrive as files, are checked, and become status rows; bad ones go to a table of their own.

A micro-batch is written with its number, so a batch that is replayed after a failure replaces itself; the stream's checkpoint holds what
was taken in.  ``availableNow`` drains the queue and stops.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from swathline.operators import jobs


def messages(spark: SparkSession, folder: str, files: int = 1) -> DataFrame:
    """The lines of files dropped in a folder, at most ``files`` of them a batch."""
    return spark.readStream.option("maxFilesPerTrigger", files).text(folder).withColumnRenamed("value", "body")


def run(stream: DataFrame, expected: dict[str, str], out: str, checkpoint: str, process: Callable[[DataFrame], DataFrame]) -> StreamingQuery:
    """Drain the queue.  ``process(valid jobs)`` returns ``(tile, code, log)``; states go to ``out/status``, bad messages to ``out/dead``.

    A tile that several messages of a batch ask for is processed once; its status says for how many messages, and what becomes of them.
    """

    def batch(rows: DataFrame, number: int) -> None:
        read = jobs.parsed(rows, expected).persist()
        end = jobs.classified(F.col("code"), F.col("log"))
        jobs_of = read.where(F.size("faults") == 0).groupBy("tile").agg(F.count("*").alias("messages"), F.min("body").alias("body"))
        done = process(jobs_of).select("tile", end.alias("end")).join(jobs_of.select("tile", "messages"), "tile")
        found = done.select("tile", "end.*", jobs.action(F.col("end.state")).alias("action"), "messages", F.lit(number).alias("sequence"))
        found.write.mode("overwrite").parquet(f"{out}/status/batch={number}")
        read.where(F.size("faults") > 0).select("body", "faults").write.mode("overwrite").parquet(f"{out}/dead/batch={number}")
        read.unpersist()

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
