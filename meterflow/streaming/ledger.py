"""The billing job as one fan-out of each micro-batch.

``ledger_sink`` is a ``foreachBatch`` function. For one batch of decoded
messages it writes the points, the bills, the summary, the rejects and the new
running totals, and commits them together (``sources.store``): readers see the
whole batch or nothing of it, and a replayed batch finds its own commit and
does nothing.

Running totals are a versioned table on the JVM side, not operator state: the
batch's rows are summed by the cell scan (``operators.scan``, balanced for hot
keys), and each (meter, cycle) starts from its total in the last commit. A
batch writes the totals of the keys it touched; after ``SNAPSHOT`` such parts
it writes all totals once and drops the older parts. Sums are DECIMAL, and no
task holds a whole key's rows. The batch is kept with its exact kWh and its
cycle, so a message is decoded once; the points are written first and the bills
and the summary read from them, so a reading is billed once.

``close_after`` closes calendar months: a month that ended that long before
the latest reading seen gets one row with its final total in ``closed``, and
readings of closed months go to ``late`` instead of the bills, so nothing
vanishes.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.functions import kwh as kwh_expr
from meterflow.functions import tier_cost
from meterflow.operators.billing import classify, cumulative_kwh, monthly_billing, power_usage, running_bill, with_cycle
from meterflow.operators.points import batch_summary
from meterflow.schemas import CRIT_KW, WARN_KW
from meterflow.sources.store import PointStore
from meterflow.sources.topic import split_rejects

SNAPSHOT = 16
TOTAL = "decimal(28,6)"


def totals(store: PointStore, keys=("meter_id",)) -> DataFrame | None:
    """(keys, month_key, kwh, lost): the running total of every cycle in the last commit; None before the first.

    ``lost``: the cycle holds a reading without a usable number.
    """
    rows = store.read("totals")
    if rows is None:
        return None
    return rows.groupBy(*keys, "month_key").agg(F.max_by(F.struct("kwh", "lost"), "version").alias("t")).select(
        *keys, "month_key", "t.kwh", "t.lost")


def ledger_sink(root: str, run_id: str, cycle: str = "demo_slot", keys=("meter_id",), warn: float = WARN_KW, crit: float = CRIT_KW,
                close_after: dt.timedelta | None = None, unit: str = "day"):
    """A ``foreachBatch`` function for decoded messages (``topic.decode_readings`` with ``keys`` and ``tie``).

    Rows of a batch are added in (event_time, tie) order, batches in the order
    of their commits. Empty batches write nothing. Tables: power_usage,
    monthly_billing, batch_summary, rejects, totals; with ``close_after``
    (calendar months only) also closed and late. ``unit``: the range of time of
    one folder, ``day`` or ``month``.
    """
    keys = list(keys)
    if close_after is not None and cycle != "calendar_month":
        raise ValueError("close_after needs cycle='calendar_month'")

    def sink(batch: DataFrame, batch_id: int) -> None:
        name = f"{run_id}-{batch_id:09d}"
        store = PointStore(batch.sparkSession, root, unit)
        if store.has(name):
            return
        batch = with_cycle(batch.withColumns({"kwh": kwh_expr("kw", exact=True),  # the text is needed of rejects alone
                                              "message": F.when(F.col("reject").isNotNull(), F.col("message"))}), cycle).persist()
        try:
            if not batch.isEmpty():
                write(store, batch, batch_id, name)
        finally:
            batch.unpersist()

    def write(store: PointStore, batch: DataFrame, batch_id: int, name: str) -> None:
        version, before = store.version() + 1, totals(store, keys)
        good, bad = split_rejects(batch)
        rows = good.select(*keys, "event_time", "tie", "kw", "kwh", "sub1", "sub2", "sub3", "month_key")
        entries = store.stage(bad.drop("month_key").withColumn("batch_id", F.lit(batch_id)), "rejects", name)
        mark = new_mark = None
        if close_after is not None:
            mark, top = store.mark(), rows.agg(F.max("event_time")).first()[0]
            new_mark = max((x for x in (mark, top and top - close_after) if x is not None), default=None)
            if mark is not None:
                shut = ended("month_key") <= F.lit(mark)
                entries += store.stage(rows.filter(shut).withColumn("time", F.col("event_time")), "late", name)
                rows = rows.filter(~shut)
        ids = [*keys, "month_key"]
        start = before if before is not None else rows.limit(0).select(*ids, F.lit(0).cast(TOTAL).alias("kwh"), F.lit(False).alias("lost"))
        named = lambda df, *more: df.select(*(F.col(k).alias(f"_{k}") for k in ids), *more)
        same = F.expr(" and ".join(f"{k} <=> _{k}" for k in ids))
        offset = named(start, F.col("kwh").alias("_from"), F.col("lost").alias("_lost"))
        with_offset = lambda df: df.join(offset, same, "left").drop(*(f"_{k}" for k in ids))
        run = with_offset(cumulative_kwh(rows, ids))
        total = F.when(~F.coalesce("_lost", F.lit(False)), F.col("kwh_cumulative") + F.coalesce("_from", F.lit(0).cast(TOTAL))).cast(TOTAL)
        billed = classify(running_bill(run.withColumn("kwh_cumulative", total).drop("_from", "_lost")), warn, crit)
        points = power_usage(billed, keys, extra=("tie", "month_key")).withColumn("batch_id", F.lit(batch_id))
        entries += store.stage(points, "power_usage", name)
        points = store.staged("power_usage", name, points.schema)
        bills = monthly_billing(points.withColumnRenamed("time", "event_time"), keys).withColumn("batch_id", F.lit(batch_id))
        entries += store.stage(bills, "monthly_billing", name)
        entries += store.stage(batch_summary(points), "batch_summary", name, "last_time")
        lost = F.max(F.col("kw").isNotNull() & F.col("kwh").isNull())
        added = with_offset(rows.groupBy(*ids).agg(F.sum("kwh").alias("kwh"), lost.alias("lost")))
        new = added.select(*ids, (F.coalesce("kwh", F.lit(0)) + F.coalesce("_from", F.lit(0))).cast(TOTAL).alias("kwh"),
                           (F.col("lost") | F.coalesce("_lost", F.lit(False))).alias("lost"), F.lit(version).cast("long").alias("version"))
        old, rest = store.live("totals"), start.join(named(new), same, "left_anti")
        every = new.unionByName(rest.withColumn("version", F.lit(version).cast("long")))
        if len(old) >= SNAPSHOT:
            entries += store.stage(every, "totals", name) + store.removals("totals", old)
        else:
            entries += store.stage(new, "totals", name)
        if new_mark is not None:
            due = ended("month_key") <= F.lit(new_mark)
            if mark is not None:
                due = due & (ended("month_key") > F.lit(mark))
            closed = every.filter(due).select(*ids, ended("month_key").alias("time"), F.when(~F.col("lost"), F.col("kwh")).alias("kwh"))
            entries += store.stage(closed.withColumn("vnd", tier_cost("kwh", exact=True)), "closed", name)
        store.commit(name, entries, new_mark)

    return sink


def ended(month_key: str):
    """The first instant after a ``yyyy-MM`` cycle."""
    first = F.to_timestamp(F.concat(F.col(month_key), F.lit("-01")), "yyyy-MM-dd")
    return F.add_months(first.cast("date"), 1).cast("timestamp")
