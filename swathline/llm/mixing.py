"""Mixing sources to target weights by entropy balancing, in DataFrame operations only.

The rates r_i of a source's documents minimise the relative entropy of the mix to the base rates b_i (1 unless a column
says otherwise), sum r_i log(r_i / b_i) - r_i + b_i over documents, under the source's token constraint
sum size_i r_i = target and r_i <= 3.  The convex dual has one multiplier a source; its solution is the exponentially
tilted rate r_i = min(3, b_i exp(lambda size_i)), so a source that should give more gives it by its long documents first,
and one that should give less leaves these out first.  Newton steps on the dual, held in a bracket, take the gradient and the Hessian
from one aggregation of the documents by source, base rate and size; only one row a source reaches the driver.

Rates become copies by systematic rounding along the sizes of a source: floor(R_i + 1/2) - floor(R_{i-1} + 1/2), with R the
running sum of rates from the largest document down, which is never over the ceiling of a rate and misses the target by
about one document.  A second pass closes most of what is missed with small documents.  Running sums are taken
first over cells of a bounded number of documents, so that no task holds a whole hot source.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .textkit import WORD, checkpointed

CAP = 3
WEIGHTS = (1.0, 2.0, 3.0)
CELL = 4096
NEWTON_STEPS = 40
#: Two closing passes: with documents of at most half of what is missed, then an eighth of the rest.
SHARES = (2, 8)
TOLERANCE = 1e-9
#: Rates are over any cap from this power on.
LARGEST_POWER = 50.0


def token_targets(sizes: dict[str | None, int], weights: tuple[float, ...] = WEIGHTS, cap: int = CAP) -> dict[str | None, float]:
    """The tokens each source should give: all tokens shared by weight, none over ``cap`` times what the source has.

    Sources go by code point, null last, and take the weights in turn.  What a stopped source leaves is shared among the
    others by weight, until none is above.  A source without tokens gets none.
    """
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, target = float(sum(sizes.values())), list(order), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total > cap * sizes[s]]
        if not over:
            target |= {s: left * weight[s] / total for s in open_}
            break
        target |= {s: float(cap * sizes[s]) for s in over}
        left -= sum(target[s] for s in over)
        open_ = [s for s in open_ if s not in target]
    return target


def _case(column: str, values: dict[str | None, float]) -> Column:
    """A value by source.  There is one row a source on the driver; a map literal keeps the plan flat."""
    known = {k: v for k, v in values.items() if k is not None}
    found = F.create_map(*[x for k, v in known.items() for x in (F.lit(k), F.lit(float(v)))])[F.col(column)] if known else F.lit(None).cast("double")
    return F.when(F.col(column).isNull(), F.lit(float(values.get(None, 0.0)))).otherwise(found)


def tilted(multipliers: dict[str | None, float]) -> Column:
    """The rate of a row ``(source, base, size)`` before the cap; a size of zero leaves the base rate."""
    multiplier = _case("source", multipliers)
    power = F.when(F.col("size") == 0, 0.0).otherwise(F.least(F.lit(LARGEST_POWER), multiplier * F.col("size")))
    return F.when(multiplier == -math.inf, 0.0).otherwise(F.col("base") * F.exp(power))


def solve(profile: DataFrame, targets: dict[str | None, float], cap: int = CAP) -> dict[str | None, float]:
    """The multiplier of each source, by Newton steps on the dual.

    ``profile(source, base, size, n)``: documents by source, base rate and size.  A source whose target is the cap itself has
    an infinite multiplier; one without tokens, or with no target, has minus infinity.
    """
    tokens = F.col("n") * F.col("size").cast("double")
    found = profile.groupBy("source").agg(F.sum(tokens).alias("tokens"), F.sum(tokens * F.col("size")).alias("squares")).collect()
    lam = {r.source: -math.inf if targets[r.source] <= 0 or not r.tokens else math.inf if targets[r.source] >= cap * r.tokens else 0.0 for r in found}
    # a step is counted in the size at which a source's mean token lies
    scale = {r.source: r.squares / r.tokens for r in found if r.tokens}
    low, high = dict.fromkeys(lam, -math.inf), dict.fromkeys(lam, math.inf)
    active = {s for s, x in lam.items() if math.isfinite(x)}
    for _ in range(NEWTON_STEPS):
        if not active:
            break
        steps = profile.select("source", "size", tokens.alias("tokens"), tilted({s: lam[s] for s in active}).alias("rate"))
        inner = F.when(F.col("rate") < cap, F.col("tokens") * F.col("size") * F.col("rate")).otherwise(0.0)
        now = steps.groupBy("source").agg(F.sum(F.col("tokens") * F.least(F.lit(float(cap)), "rate")).alias("g"), F.sum(inner).alias("h"))
        for row in now.collect():
            s = row.source
            if s not in active:
                continue
            miss = row.g - targets[s]
            if abs(miss) < TOLERANCE * targets[s]:
                active.discard(s)
                continue
            (high if miss > 0 else low)[s] = lam[s]
            # at most doubled (and a step more) towards a side that has no bound yet
            reach = 2 / scale[s] + abs(lam[s])
            step = miss / row.h if row.h else math.copysign(reach, miss)
            lam[s] -= max(-reach, min(reach, step))
            if not low[s] < lam[s] < high[s]:
                lam[s] = (low[s] + high[s]) / 2
    return lam


def _cells(rows: DataFrame) -> DataFrame:
    """``rows(source, size, key)`` with ``cell``: within a source and size, about ``CELL`` rows share one."""
    sizes = rows.groupBy("source", "size").agg(F.count("*").alias("n"))
    cells = F.pmod(F.col("key"), F.greatest(F.lit(1), F.ceil(F.col("n") / CELL))).alias("cell")
    joined = rows.alias("r").join(sizes.alias("s"), F.expr("r.source <=> s.source AND r.size = s.size"))
    return joined.select("r.*", cells)


def _running(rows: DataFrame, value: str, out: str) -> DataFrame:
    """``rows(source, size, cell, key, doc_id, mark, ...)`` with the sum of ``value`` over the source up to each row, largest first.

    The window over a source runs on one row a cell; the window over rows holds one cell.
    """
    cells = rows.groupBy("source", "size", "cell").agg(F.sum(value).alias("total"))
    before = Window.partitionBy("source").orderBy(F.desc("size"), "cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select("source", "size", "cell", F.coalesce(F.sum("total").over(before), F.lit(0.0)).alias("before"))
    within = Window.partitionBy("source", "size", "cell").orderBy("key", "doc_id", "mark").rowsBetween(Window.unboundedPreceding, 0)
    ranked = rows.withColumn("within", F.sum(value).over(within))
    joined = ranked.alias("r").join(cells.alias("c"), F.expr("r.source <=> c.source AND r.size = c.size AND r.cell = c.cell"))
    return joined.select("r.*", (F.col("c.before") + F.col("r.within")).alias(out)).drop("within")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = WEIGHTS, cap: int = CAP, base_rate: str | None = None) -> DataFrame:
    """``(doc_id, size, source_size, target, copies, taken)``, one row for each row of ``docs``.

    ``copies`` (0 to ``cap``) is how often the mix takes the document and ``taken`` = ``copies * size``.  Null and empty
    texts have size 0 and are taken at their base rate, unless their source has no tokens at all; a null source is a source; repeated rows are
    separate documents, each with its own copies.  Reruns agree: ties are broken by a hash of the id and by the id.
    The number of sources is taken to fit the driver (one row each).
    """
    mixed, sizes, targets = _mixed(docs, id_col, text_col, source_col, weights, cap, base_rate, F.lit(0).cast("long"))
    numbers = {s: float(n) for s, n in sizes.items()}
    return mixed.select("doc_id", "size", _case("source", numbers).cast("long").alias("source_size"), _case("source", targets).alias("target"), "copies", (F.col("copies") * F.col("size")).alias("taken"))


def _mixed(docs: DataFrame, id_col: str, text_col: str, source_col: str, weights: tuple[float, ...], cap: int, base_rate: str | None, mark: Column) -> tuple[DataFrame, dict, dict]:
    """``(doc_id, mark, source, size, copies, ...)`` of each row, and the tokens and targets of sources."""
    size = F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    base = F.coalesce(F.col(base_rate).cast("double"), F.lit(1.0)) if base_rate else F.lit(1.0)
    rows = checkpointed(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), size.alias("size"), base.alias("base"), F.xxhash64(F.col(id_col)).alias("key"), mark.alias("mark")))
    profile = checkpointed(rows.groupBy("source", "base", "size").agg(F.count("*").alias("n")))
    sizes = {r.source: int(r.tokens) for r in profile.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("tokens")).collect()}
    targets = token_targets(sizes, weights, cap)
    rate = F.least(F.lit(float(cap)), tilted(solve(profile, targets, cap)))
    rated = _running(_cells(rows).withColumn("rate", rate), "rate", "upto")
    # a tiny push keeps whole sums whole
    half = F.lit(0.5 + 1e-9)
    copies = F.floor(F.col("upto") + half) - F.floor(F.col("upto") - F.col("rate") + half)
    first = checkpointed(rated.withColumn("copies", F.least(F.lit(cap), F.greatest(F.lit(0), copies)).cast("long")).drop("upto", "rate"))
    mixed = first
    for share in SHARES:
        mixed = checkpointed(_close(mixed, targets, cap, share))
    return mixed, sizes, targets


def _close(rows: DataFrame, targets: dict[str | None, float], cap: int, share: int) -> DataFrame:
    """One copy more (or less) of documents that together weigh at most what a source misses, largest first.

    Only documents of at most one part in ``share`` of the miss take part, so no one of them decides the sum.
    """
    got = {r.source: int(r.taken) for r in rows.groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("taken")).collect()}
    miss = {s: targets[s] - n for s, n in got.items()}
    room = F.abs(F.col("miss"))
    able = (F.col("size") > 0) & (F.col("size") * share <= room) & F.when(F.col("miss") > 0, F.col("copies") < cap).otherwise(F.col("copies") > 0)
    marked = rows.withColumn("miss", _case("source", miss)).withColumn("able", F.when(able, F.col("size").cast("double")).otherwise(0.0))
    summed = _running(marked, "able", "upto")
    changed = (F.col("able") > 0) & (F.col("upto") <= room)
    return summed.withColumn("copies", F.col("copies") + F.when(changed, F.signum("miss").cast("long")).otherwise(0)).drop("miss", "able", "upto")


def repeated(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs``, each as many times as the mix takes it, with the same columns.

    Rows that share an id (null ids among them) are taken equally often: the least of their copies.
    """
    counts = mixed.groupBy("doc_id").agg(F.min("copies").alias("copies")).where("copies > 0")
    joined = docs.alias("d").join(counts.alias("c"), F.col(f"d.{id_col}").eqNullSafe(F.col("c.doc_id")))
    times = F.explode(F.sequence(F.lit(1), F.col("c.copies").cast("int")))
    # the copy's number is dropped again: equal rows are the point
    numbered = joined.select(F.struct("d.*").alias("row"), times.alias("copy"))
    return numbered.select("row.*")


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of ``docs``, each as many times as ``mix`` takes this row, whatever other rows share its id.

    Rows that share an id are told apart by a hash of all their columns; equal rows together give the sum of their copies.
    """
    mark = F.xxhash64(*docs.columns)
    mixed, _, _ = _mixed(docs, id_col, text_col, source_col, WEIGHTS, CAP, None, mark)
    counts = mixed.groupBy("doc_id", "mark").agg(F.sum("copies").alias("copies"), F.count("*").alias("n"))
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("doc_id"), mark.alias("mark"))
    if not counts.where("n > 1").isEmpty():
        rows = rows.dropDuplicates(["doc_id", "mark"])
    joined = rows.alias("r").join(counts.where("copies > 0").alias("c"), F.expr("r.doc_id <=> c.doc_id AND r.mark = c.mark"))
    # the copy's number is dropped again: equal rows are the point
    numbered = joined.select("row", F.explode(F.sequence(F.lit(1), F.col("c.copies").cast("int"))).alias("copy"))
    return numbered.select("row.*")
