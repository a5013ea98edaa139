"""Tile jobs: building messages, reading them back, classifying ends, and the current status of each tile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swathline.functions import text
from swathline.session import kept

BATCH = 10
#: What a failed run's log says when there was nothing to process.  Fixed values.
NO_DATA_MARKERS = ("No Sentinel-1", "No scenes remained after filtering.", "No acquisitions", "Candidate scenes:           0", "No eligible scenes")


def distinct_in_order(inventory: DataFrame) -> DataFrame:
    """``inventory(ordinal, tile)`` with names normalised; of equal ones the first stays."""
    clean = inventory.withColumn("tile", text.tile(F.col("tile"))).where("tile IS NOT NULL")
    return clean.groupBy("tile").agg(F.min("ordinal").alias("ordinal"))


def enqueue(inventory: DataFrame, existing: DataFrame | None, config: dict[str, str], prefix: str, limit: int | None = None) -> DataFrame:
    """``(ordinal, tile, output_key, body)`` of the tiles without output, in order, at most ``limit``."""
    key = text.output_key(prefix, F.col("tile"), config["start_date"], config["end_date"], config["calibration_lut"])
    jobs = distinct_in_order(inventory).withColumn("output_key", key)
    if existing is not None:
        jobs = jobs.join(existing.select("output_key"), "output_key", "left_anti")
    if limit:
        jobs = jobs.orderBy("ordinal").limit(limit)
    body = F.to_json(F.struct("tile", *[F.lit(v).alias(k) for k, v in sorted(config.items())], "output_key"))
    return jobs.select("ordinal", "tile", "output_key", body.alias("body"))


def numbered(rows: DataFrame, *order: Column | str, name: str = "place") -> DataFrame:
    """``rows`` with their place from 0 in a total order, without a task that holds them all.

    Rows are range-partitioned and sorted, and kept so that partitions stay what they are; the driver gets the number of rows of each.
    """
    order = [F.asc(o) if isinstance(o, str) else o for o in order]
    within = kept(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id()))
    part = F.shiftrightunsigned("_id", 33)
    counts = {r.part: r.n for r in within.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}
    parts = sorted(counts)
    before = [sum(counts[p] for p in parts[:i]) for i in range(len(parts))]
    table = F.broadcast(rows.sparkSession.createDataFrame(list(zip(parts, before, strict=True)), "_part long, _before long"))
    return within.withColumn("_part", part).join(table, "_part").withColumn(name, F.col("_before") + F.expr("_id & 8589934591")).drop("_id", "_part", "_before")


def batches(jobs: DataFrame, size: int = BATCH) -> DataFrame:
    """Jobs in groups of ``size`` by their place in order."""
    return numbered(jobs, "ordinal").withColumn("batch", F.floor(F.col("place") / size)).drop("place")


def parsed(messages: DataFrame, expected: dict[str, str], column: str = "body") -> DataFrame:
    """``tile`` and ``faults`` of messages: an object, a quoted name or a bare name; fields that are given must be as expected.

    JSON of another kind (a number, a list, a truth value, null) names no tile.  Null and blank messages name none either.
    """
    body = F.trim(column)
    # an array of one: the parser's result crosses a generator, so it isn't written out again for each field
    rows = messages.select("*", F.explode(F.array(F.struct(body.alias("body"), F.try_parse_json(body).alias("json")))).alias("_m"))
    json, kind = F.col("_m.json"), F.schema_of_variant(F.col("_m.json"))
    field = lambda name: F.try_variant_get(json, f"$.{name}", "string")
    rows = rows.withColumn("_k", F.explode(F.array(F.struct(kind.startswith("OBJECT").alias("object"), (kind == "STRING").alias("quoted"), *[field(k).alias(k) for k in ("tile", "tile_id", "mgrs_tile", *sorted(expected))]))))
    named = F.coalesce(*[F.nullif(F.col(f"_k.{n}"), F.lit("")) for n in ("tile", "tile_id", "mgrs_tile")])
    name = F.when(json.isNull(), F.col("_m.body")).when(F.col("_k.object"), named).when(F.col("_k.quoted"), F.try_variant_get(json, "$", "string"))
    name = text.tile(name)
    wrong = [F.when(F.col("_k.object") & (F.col(f"_k.{k}") != F.lit(v)), F.lit(f"{k}_mismatch")) for k, v in sorted(expected.items())]
    found = F.array_compact(F.array(F.when(name.isNull(), F.lit("no_tile")), *wrong))
    return rows.withColumns({"tile": name, "faults": found}).drop("_m", "_k")


def classified(code: Column, log: Column, written: Column | None = None) -> Column:
    """``struct<state, reason>`` of a processor's end: complete if it exited with 0 and its output was ``written``.

    Of the others, a log that says so means that there was nothing to process; an exit code names the failure, and 0 without output is unknown.
    """
    none = F.lit(False)
    for marker in NO_DATA_MARKERS:
        none = none | F.coalesce(F.contains(log, F.lit(marker)), F.lit(False))
    end = lambda state, reason: F.struct(F.lit(state).alias("state"), reason.alias("reason"))
    done = (code == 0) & (F.lit(True) if written is None else F.coalesce(written, F.lit(False)))
    failed = end("failed", F.when(code != 0, F.concat(F.lit("processor_exit_"), code.cast("string"))).otherwise(F.lit("unknown_failure")))
    return F.when(done, end("complete", F.lit(None).cast("string"))).when(none, end("no_data", F.lit("no_sentinel1_data"))).otherwise(failed)


#: What becomes of a message whose job ended in a state.  Fixed values.
ACTIONS = {"complete": "delete", "no_data": "delete", "skipped": "delete", "invalid": "keep", "failed": "keep", "interrupted": "release", "aborted": "keep"}


def action(state: Column) -> Column:
    """Delete the message, release it for another worker at once, or keep it until its visibility ends; null for no known state."""
    return F.create_map(*[F.lit(x) for pair in ACTIONS.items() for x in pair])[state]


def current(status: DataFrame) -> DataFrame:
    """The last status of each tile, the larger sequence number where times are equal."""
    return status.groupBy("tile").agg(F.max(F.struct("updated", "sequence", "state")).alias("s")).select("tile", "s.updated", "s.sequence", "s.state")
