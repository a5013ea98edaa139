"""Scene catalogue analytics: eligibility, thresholds, gaps, duplicates and audit selections.

Scenes are rows ``(item_id, datetime_utc, end_datetime_utc, platform, instrument_mode, product_type, orbit_state, relative_orbit,
absolute_orbit, polarisations array<string>, coverage double)``; operators add columns and keep the others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from swathline.functions import text
from swathline.session import kept

PLATFORMS = ("sentinel-1a", "sentinel-1b")
MODE, PRODUCT = "IW", "GRD"
DAY = 86_400e6


def compact(*values: Column) -> Column:
    return F.array_compact(F.array(*values))


def differs(name: str, column: str, wanted: str) -> Column:
    """A reason where the column isn't as wanted; null differs from everything."""
    return F.when(~F.col(column).eqNullSafe(F.lit(wanted)), F.concat(F.lit(f"{name}_is_"), text.missing_or(F.col(column))))


def normalised(scenes: DataFrame) -> DataFrame:
    """Upper and lower cases, ordered polarisations, their combination, year and provisional key."""
    pols = text.polarisations(F.col("polarisations"))
    scenes = scenes.withColumns({"instrument_mode": F.upper("instrument_mode"), "platform": F.lower("platform"), "orbit_state": F.lower("orbit_state"), "polarisations": pols})
    combination = F.coalesce(F.nullif(F.array_join("polarisations", "+"), F.lit("")), F.lit("NONE"))
    key = text.acquisition_key(*map(F.col, ("platform", "datetime_utc", "end_datetime_utc", "instrument_mode", "absolute_orbit", "polarisations")))
    return scenes.withColumns({"combination": combination, "year": F.year("datetime_utc"), "acquisition_key": key})


def eligibility(scenes: DataFrame, platforms: Sequence[str] | None = PLATFORMS) -> DataFrame:
    """``reasons`` in fixed order and ``eligible``; ``platforms=None`` allows all."""
    platform = F.when(~F.coalesce(F.col("platform").isin(*platforms), F.lit(False)), F.concat(F.lit("platform_is_"), text.missing_or(F.col("platform")))) if platforms is not None else F.lit(None).cast("string")
    none = F.when(F.size("polarisations") == 0, F.lit("no_supported_measurement_assets"))
    reasons = compact(differs("instrument_mode", "instrument_mode", MODE), platform, differs("product_type", "product_type", PRODUCT), none)
    return scenes.withColumn("reasons", reasons).withColumn("eligible", F.size("reasons") == 0)


def dual_eligibility(scenes: DataFrame, minimum: float, platforms: Sequence[str] = PLATFORMS) -> DataFrame:
    """The prototype's rule: platform before mode, both VV and VH, and coverage."""
    scenes = scenes.withColumn(
        "reasons",
        compact(
            F.when(~F.coalesce(F.col("platform").isin(*platforms), F.lit(False)), F.concat(F.lit("platform_is_"), text.missing_or(F.col("platform")))),
            differs("instrument_mode", "instrument_mode", MODE),
            *[F.when(~F.array_contains("polarisations", p), F.lit(f"missing_{p.lower()}")) for p in ("VV", "VH")],
            F.when(~F.coalesce(F.col("coverage") >= minimum, F.lit(False)), F.lit("coverage_below_threshold")),
        ),
    )
    return scenes.withColumn("eligible", F.size("reasons") == 0)


def candidates(scenes: DataFrame, minimum: float, most: int | None = None, ids: DataFrame | None = None) -> DataFrame:
    """Eligible scenes of enough coverage, earliest first (null times last), at most ``most``."""
    found = scenes.where(F.col("eligible") & (F.col("coverage") >= minimum))
    if ids is not None:
        found = found.join(ids, "item_id", "left_semi")
    found = found.orderBy(F.col("datetime_utc").asc_nulls_last(), "item_id")
    return found.limit(most) if most else found


def absent(ids: DataFrame, scenes: DataFrame) -> DataFrame:
    """Requested ids that no scene has."""
    return ids.join(scenes, "item_id", "left_anti").distinct()


def counts(scenes: DataFrame, column: str) -> DataFrame:
    return scenes.groupBy(text.missing_or(F.col(column)).alias("value")).agg(F.count("*").alias("n"))


def polarisation_counts(scenes: DataFrame) -> DataFrame:
    """Scenes by polarisation: the four known ones always, others never."""
    # one pass over the scenes without exploding them, then four rows
    sums = scenes.agg(*[F.count_if(F.array_contains("polarisations", p)).alias(p) for p in text.POLARISATIONS])
    return sums.unpivot([], list(text.POLARISATIONS), "polarisation", "n")


def reason_counts(scenes: DataFrame, column: str = "reasons") -> DataFrame:
    return scenes.select(F.explode(column).alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


def at_thresholds(scenes: DataFrame, thresholds: Sequence[float]) -> DataFrame:
    """Each scene once for every threshold it reaches; the list is short, so this is a generator and no join."""
    reached = F.filter(F.array(*[F.lit(float(t)) for t in thresholds]), lambda t: F.col("coverage") >= t)
    return scenes.withColumn("threshold", F.explode(reached))


def with_all(found: DataFrame, thresholds: Sequence[float]) -> DataFrame:
    """A row for every threshold, also of those that no scene reaches."""
    table = found.sparkSession.createDataFrame([(float(t),) for t in thresholds], "threshold double")
    return table.join(found, "threshold", "left")


def threshold_summary(scenes: DataFrame, thresholds: Sequence[float]) -> DataFrame:
    """Items, distinct acquisitions and share of the eligible for every threshold."""
    eligible = scenes.where("eligible")
    total = eligible.agg(F.count("*").alias("total"))
    # acquisitions first: counting distinct keys then needs no second copy of the rows
    by_key = at_thresholds(eligible, thresholds).groupBy("threshold", "acquisition_key").agg(F.count("*").alias("n"), F.min("datetime_utc").alias("first"), F.max("datetime_utc").alias("last"))
    found = by_key.groupBy("threshold").agg(F.sum("n").alias("n"), F.count("*").alias("n_keys"), F.min("first").alias("first"), F.max("last").alias("last"))
    joined = with_all(found, thresholds).crossJoin(F.broadcast(total))
    share = F.coalesce(F.col("n") / F.nullif(F.col("total"), F.lit(0)), F.lit(0.0))
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    return joined.select("threshold", F.coalesce("n", F.lit(0)).alias("item_count"), F.coalesce("n_keys", F.lit(0)).alias("acquisition_count"), share.alias("fraction"), day("first").alias("first_day"), day("last").alias("last_day"))


COUNTED = {"year": "year", "platform": "platform", "orbit_state": "orbit_state", "relative_orbit": "relative_orbit", "polarisation_combination": "combination"}


def threshold_counts(scenes: DataFrame, thresholds: Sequence[float]) -> DataFrame:
    """By threshold, how many scenes have each value of ``COUNTED`` and each known polarisation: maps in the order of their keys."""
    alike = at_thresholds(scenes, thresholds).groupBy("threshold", *COUNTED.values(), "polarisations").agg(F.count("*").alias("n"))
    fields = [F.struct(F.lit(kind).alias("kind"), text.missing_or(F.col(c)).alias("value"), F.col("n").alias("n")) for kind, c in COUNTED.items()]
    known = [F.struct(F.lit("polarisation").alias("kind"), F.lit(p).alias("value"), F.when(F.array_contains("polarisations", p), F.col("n")).otherwise(0).alias("n")) for p in text.POLARISATIONS]
    sums = alike.select("threshold", F.inline(F.array(*fields, *known))).groupBy("threshold", "kind", "value").agg(F.sum("n").alias("n"))
    entries = lambda kind: F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("kind") == kind, F.struct("value", "n")))))
    return sums.groupBy("threshold").agg(*[entries(kind).alias(f"counts_by_{kind}") for kind in (*COUNTED, "polarisation")])


def threshold_table(scenes: DataFrame, thresholds: Sequence[float]) -> DataFrame:
    """The 17 columns of the thresholds' CSV file, maps as JSON."""
    summary, gap, counted = threshold_summary(scenes, thresholds), gap_statistics(scenes, thresholds), threshold_counts(scenes.where("eligible"), thresholds)
    times = at_thresholds(scenes.where("eligible"), thresholds).groupBy("threshold").agg(F.min("datetime_utc").alias("first"), F.max("datetime_utc").alias("last"))
    rows = summary.join(gap, "threshold").join(counted, "threshold", "left").join(times, "threshold", "left")
    # thresholds that no scene reaches count no polarisation, and no value of anything else
    zero = {kind: F.create_map().cast("map<string,bigint>") for kind in COUNTED} | {"polarisation": F.map_from_arrays(F.array(*map(F.lit, sorted(text.POLARISATIONS))), F.array_repeat(F.lit(0).cast("long"), len(text.POLARISATIONS)))}
    maps = [F.to_json(F.coalesce(f"counts_by_{kind}", zero[kind])).alias(f"counts_by_{kind}") for kind in (*COUNTED, "polarisation")]
    return rows.select(
        F.col("threshold").alias("threshold_fraction"), text.percentage_points(F.col("threshold")).alias("threshold_pct"), F.col("item_count").alias("retained_stac_item_count"), F.col("acquisition_count").alias("retained_provisional_acquisition_count"),
        F.col("fraction").alias("retained_fraction_of_eligible_items"), text.iso(F.col("first")).alias("first_datetime_utc"), text.iso(F.col("last")).alias("last_datetime_utc"),
        *[F.col(f"{short}_gap").alias(f"{long}_gap_days") for short, long in (("min", "minimum"), ("median", "median"), ("mean", "mean"), ("max", "maximum"))], *maps,
    )


def acquisitions(scenes: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The first scene of each acquisition key: earliest time, then smallest id."""
    order = F.struct(F.col("datetime_utc").isNull(), "datetime_utc", "item_id")
    return scenes.groupBy(*by, "acquisition_key").agg(F.min_by(F.struct("item_id", "datetime_utc"), order).alias("s")).select(*by, "acquisition_key", "s.*")


def gaps(scenes: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Times of scenes, each with the last scene before it and the gap in days; null at the first time.

    ``(datetime_utc, n, item_id, last_id, before, before_id, gap_days)``: equal times are one row first, so a time that many
    scenes share costs a row a task.  Neighbours are found within days, and the days' ends among days, so no task holds more than a
    day or the calendar.  Scenes without time are left out.
    """
    times = scenes.where("datetime_utc IS NOT NULL").groupBy(*by, "datetime_utc").agg(F.count("*").alias("n"), F.min("item_id").alias("item_id"), F.max("item_id").alias("last_id"))
    times = times.withColumn("day", F.to_date("datetime_utc"))
    inner = Window.partitionBy(*by, "day").orderBy("datetime_utc")
    days = times.groupBy(*by, "day").agg(F.max(F.struct("datetime_utc", "last_id")).alias("end"))
    days = days.select(*by, "day", F.lag("end").over(Window.partitionBy(*by).orderBy("day")).alias("end"))
    rows = times.withColumns({"before": F.lag("datetime_utc").over(inner), "before_id": F.lag("last_id").over(inner)}).join(days, [*by, "day"])
    before = F.coalesce("before", "end.datetime_utc")
    rows = rows.withColumns({"before_id": F.coalesce("before_id", "end.last_id"), "gap_days": text.distance_micros(F.col("datetime_utc"), before) / F.lit(DAY), "before": before})
    return rows.drop("day", "end")


def quantiles(counts: DataFrame, at: Sequence[float], by: Sequence[str] = (), cells: int = 256) -> DataFrame:
    """Exact quantiles of ``counts(value, n)`` by few groups, interpolated at (n - 1) p, as an array column ``q``.

    ``counts`` has distinct values and is read several times, so it should be a written table (``kept``).  They are dealt to cells between approximate quantiles (the one thing the driver gets, ``cells`` numbers a
    group); sums over cells tell the ranks a cell begins with, so no task holds more than about one part in ``cells`` of a group's values.
    """
    points = F.percentile_approx("value", F.array(*[F.lit(i / cells) for i in range(1, cells)]), F.lit(10_000)).alias("points")
    limits = counts.sparkSession.createDataFrame(counts.groupBy(*by).agg(points).collect(), ", ".join([*(f"{c} {counts.schema[c].dataType.simpleString()}" for c in by), "points array<double>"]))
    dealt = counts.join(F.broadcast(limits), list(by)) if by else counts.crossJoin(F.broadcast(limits))
    dealt = dealt.withColumn("cell", F.size(F.filter("points", lambda p: p < F.col("value")))).drop("points")
    sums = dealt.groupBy(*by, "cell").agg(F.sum("n").alias("n"))
    whole = Window.partitionBy(*by)
    sums = sums.select(*by, "cell", (F.sum("n").over(whole.orderBy("cell")) - F.col("n")).alias("low"), F.sum("n").over(whole).alias("total"))
    ranked = dealt.join(F.broadcast(sums), [*by, "cell"])
    ranked = ranked.withColumn("upto", F.col("low") + F.sum("n").over(Window.partitionBy(*by, "cell").orderBy("value")))

    def at_rank(rank: Column) -> Column:
        return F.max(F.when((F.col("upto") > rank) & (F.col("upto") - F.col("n") <= rank), F.col("value")))

    places = [(F.col("total") - 1) * p for p in at]
    found = ranked.groupBy(*by).agg(*[x for i, p in enumerate(places) for x in (at_rank(F.floor(p)).alias(f"lo{i}"), at_rank(F.ceil(p)).alias(f"hi{i}"), F.max(p - F.floor(p)).alias(f"w{i}"))])
    return found.select(*by, F.array(*[F.col(f"lo{i}") + (F.col(f"hi{i}") - F.col(f"lo{i}")) * F.col(f"w{i}") for i in range(len(places))]).alias("q"))


def gap_statistics(scenes: DataFrame, thresholds: Sequence[float]) -> DataFrame:
    """Gaps between distinct acquisitions at every threshold; nulls where there are fewer than two."""
    unique = acquisitions(at_thresholds(scenes.where("eligible"), thresholds), ["threshold"])
    times = gaps(unique, ["threshold"])
    # a time that n acquisitions share has n - 1 gaps of zero after its own
    each = F.explode(F.array(F.struct(F.col("gap_days").alias("value"), F.lit(1).cast("long").alias("n")), F.struct(F.lit(0.0).alias("value"), (F.col("n") - 1).alias("n")))).alias("g")
    counts = kept(times.select("threshold", each).where("g.value IS NOT NULL AND g.n > 0").groupBy("threshold", "g.value").agg(F.sum("g.n").alias("n")))
    sums = counts.groupBy("threshold").agg(F.sum("n").alias("gap_count"), F.min("value").alias("min_gap"), (F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("mean_gap"), F.max("value").alias("max_gap"))
    found = sums.join(quantiles(counts, [0.5], ["threshold"]).select("threshold", F.col("q")[0].alias("median_gap")), "threshold")
    return with_all(found, thresholds).withColumn("gap_count", F.coalesce("gap_count", F.lit(0)))


def coverage_distribution(scenes: DataFrame) -> DataFrame:
    """Exact quantiles, interpolated at (n - 1) p; a row of nulls for an empty table."""
    counts = kept(scenes.where("coverage IS NOT NULL").groupBy(F.col("coverage").alias("value")).agg(F.count("*").alias("n")))
    found = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.min("value").alias("lowest"), F.max("value").alias("highest"), (F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("mean"))
    q = quantiles(counts, (0.05, 0.25, 0.5, 0.75, 0.95))
    return found.crossJoin(q).select(F.col("total").alias("n"), "lowest", *[F.col("q")[i].alias(name) for i, name in enumerate(("p05", "p25", "median", "p75", "p95"))], "mean", "highest")


def duplicates(scenes: DataFrame) -> DataFrame:
    """The scenes of acquisition keys that several scenes have, ``(acquisition_key, n, item_id)``; a row a scene, as a key may have very many."""
    several = scenes.groupBy("acquisition_key").agg(F.count("*").alias("n")).where("n > 1")
    return scenes.join(several, "acquisition_key").select("acquisition_key", "n", "item_id")


def near_threshold(scenes: DataFrame, primary: float, margin: float) -> DataFrame:
    return scenes.where(F.abs(F.col("coverage") - primary) <= margin)


def longest_gap(scenes: DataFrame, threshold: float) -> DataFrame:
    """The scenes around the longest gap at a threshold; the earliest of equal ones."""
    enough = scenes.where(F.col("coverage") >= threshold)
    between = gaps(enough).where("gap_days IS NOT NULL").select("before_id", "item_id", "datetime_utc", "gap_days")
    # where all times are equal, the first two scenes are as far apart as any
    two = enough.where("datetime_utc IS NOT NULL").select("datetime_utc", "item_id").orderBy("datetime_utc", "item_id").limit(2)
    order = Window.orderBy("datetime_utc", "item_id")
    apart = text.distance_micros(F.col("datetime_utc"), F.lag("datetime_utc").over(order)) / F.lit(DAY)
    first = two.select(F.lag("item_id").over(order).alias("before_id"), "item_id", "datetime_utc", apart.alias("gap_days")).where("before_id IS NOT NULL")
    return between.unionByName(first).orderBy(F.desc("gap_days"), "datetime_utc", "item_id").limit(1).select("before_id", "item_id", "gap_days")


def closest(scenes: DataFrame, thresholds: Sequence[float], k: int) -> DataFrame:
    """For each threshold the k scenes closest below, and the k closest at or above."""
    each = F.explode(F.array(*[F.lit(float(t)) for t in thresholds])).alias("threshold")
    sided = scenes.select("*", each).withColumn("side", F.when(F.col("coverage") >= F.col("threshold"), "above").otherwise("below"))
    distance = F.abs(F.col("coverage") - F.col("threshold"))
    order = Window.partitionBy("threshold", "side").orderBy(distance, F.col("datetime_utc").asc_nulls_last(), "item_id")
    return sided.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def audit_selection(scenes: DataFrame, thresholds: Sequence[float], k: int, gap_threshold: float, ids: DataFrame | None = None) -> DataFrame:
    """Scenes to audit, each with the sorted set of reasons it was chosen for."""
    eligible = scenes.where("eligible")
    near = closest(eligible, thresholds, k).select("item_id", F.concat_ws("_", F.lit("closest"), "side", F.format_string("%.2f", "threshold")).alias("reason"))
    pair = longest_gap(eligible, gap_threshold).select(F.explode(F.array("before_id", "item_id")).alias("item_id"), F.lit("longest_gap").alias("reason"))
    chosen = near.unionByName(pair)
    if ids is not None:
        chosen = chosen.unionByName(eligible.join(ids, "item_id", "left_semi").select("item_id", F.lit("requested").alias("reason")))
    return chosen.groupBy("item_id").agg(F.array_sort(F.collect_set("reason")).alias("reasons"))


def threshold_status(records: DataFrame, thresholds: Sequence[float]) -> DataFrame:
    """Three-valued passes of ``records(item_id, coverage, joint, complete)``; null where an item isn't complete."""
    each = F.explode(F.array(*[F.lit(float(t)) for t in thresholds])).alias("threshold")
    rows = records.select("*", each)
    geometric, joint = F.col("coverage") >= F.col("threshold"), F.when(F.col("complete"), F.col("joint") >= F.col("threshold"))
    return rows.withColumns({"geometric_pass": geometric, "joint_pass": joint, "changed": geometric != joint})


def outcomes(status: DataFrame) -> DataFrame:
    return status.groupBy("threshold").agg(F.count_if("changed").alias("changed"), F.count_if(~F.col("changed")).alias("unchanged"), F.count_if(F.col("changed").isNull()).alias("unknown"), F.count("changed").alias("known"))


def acceptance(passes: DataFrame, rule: str) -> DataFrame:
    """``accepted`` by item from ``passes(item_id, passed)``: any, all, or null for a report."""
    if rule not in ("any", "all", "report-only"):
        raise ValueError(f"unknown acceptance rule {rule!r}")
    how = {"any": F.bool_or("passed"), "all": F.bool_and("passed"), "report-only": F.first(F.lit(None).cast("boolean"))}[rule]
    return passes.groupBy("item_id").agg(how.alias("accepted"))


def coverage_faults(scenes: DataFrame) -> DataFrame:
    """Scenes whose coverage isn't a fraction; there should be none."""
    return scenes.where(~F.coalesce(F.col("coverage").between(0, 1), F.lit(False))).select("item_id", "coverage")


def invariants(summary: DataFrame) -> DataFrame:
    """Thresholds whose count is larger than that of a lower one; there should be none."""
    order = Window.orderBy("threshold")
    return summary.withColumn("before", F.lag("item_count").over(order)).where("item_count > before").select("threshold", "item_count", "before")
