"""A queue of messages as two tables: the messages, and a log of what was done with them.

Nothing is updated in place, so a lost worker needs no care: a message that it received and neither deleted nor released is seen
again when its time has run out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def states(messages: DataFrame, log: DataFrame, now: Column, timeout: int, attempts: int | None = None) -> DataFrame:
    """``messages(message_id, ...)`` with ``attempts`` and ``state``, from ``log(message_id, at, action)``.

    A message is ``deleted`` once a delete is logged.  It is ``in_flight`` for ``timeout`` seconds from its last receipt or extension, unless
    it was released at that time or later, and ``dead`` when it could be received but has been ``attempts`` times.  Any other is
    ``visible``.  Log rows after ``now``, of no known action, or without a message or a time count for nothing.
    """
    known = log.where(F.col("at") <= now)
    last = lambda *actions: F.max(F.when(F.col("action").isin(*actions), F.col("at")))
    seen = known.groupBy("message_id").agg(
        F.count_if(F.col("action") == "receive").alias("attempts"), last("receive", "extend").alias("_held"), last("release").alias("_released"), last("delete").alias("_deleted"),
    )
    rows = messages.join(seen, "message_id", "left").withColumn("attempts", F.coalesce("attempts", F.lit(0)))
    held = (F.col("_held") + F.make_dt_interval(secs=F.lit(timeout)) > now) & ~F.coalesce(F.col("_released") >= F.col("_held"), F.lit(False))
    state = F.when(F.col("_deleted").isNotNull(), "deleted").when(F.coalesce(held, F.lit(False)), "in_flight")
    if attempts is not None:
        state = state.when(F.col("attempts") >= attempts, "dead")
    return rows.withColumn("state", state.otherwise("visible")).drop("_held", "_released", "_deleted")


def entries(done: DataFrame, at: Column) -> DataFrame:
    """Log rows for ``done(message_id, action)``: what ``jobs.action`` says, and none for a message that is kept until its time runs out."""
    return done.where(F.col("action").isin("delete", "release")).select("message_id", at.alias("at"), "action")
