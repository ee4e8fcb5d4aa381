"""I1-I8, A7, D9, D10 in Structured Streaming.

The running kWh of every (meter, billing cycle) lives in the state store (a
``ValueState`` of ``transformWithStateInPandas``; RocksDB provider on a
cluster), so it survives restarts through the checkpoint, and the work is
spread over executors by the (meter, cycle) hash partitioning. Everything
else (bill, alert, shares, projections) is stateless Column expressions
after the stateful step - the same functions as the batch path.

Order semantics: inside one micro-batch the rows of a key are added in
(event_time, tie) order; a row arriving in a later batch is added after
everything already counted (a late reading lands in its own cycle). With
in-order input this equals the batch running total.

A key's rows of one micro-batch are handled in one task, so the micro-batch
size (``maxFilesPerTrigger`` / ``maxOffsetsPerTrigger``) bounds that memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from meterflow.functions import alert_level, cycle_key
from meterflow.operators.billing import classify, monthly_billing, power_usage, running_bill
from meterflow.operators.dashboard import mean_of, upsert_points
from meterflow.operators.points import batch_summary
from meterflow.schemas import CRIT_KW, WARN_KW
from meterflow.sources.sinks import write_points
from meterflow.sources.topic import decode_readings, split_rejects


def month_end_ms(month_key: str) -> int:
    """First instant (UTC, epoch ms) after a ``yyyy-MM`` cycle."""
    y, m = (int(x) for x in month_key.split("-"))
    y, m = (y + 1, 1) if m == 12 else (y, m + 1)
    return int(pd.Timestamp(year=y, month=m, day=1, tz="UTC").value // 1_000_000)


# NaN and NULL can't be told apart once a column has been through pandas, so flags go beside the numbers.
LOST, NO_NUMBER = "flag_lost", "flag_no_number"


class CycleTotals(StatefulProcessor):
    """Running kWh per grouping key (meter, cycle), kept in a ValueState
    together with whether the cycle holds a reading without a usable number.

    With ``close=True`` (calendar months, event-time mode) a timer at the end
    of the month fires once the watermark passes it: it emits one row with
    ``closed = true`` and the cycle's final total, and clears the state, so
    state stays bounded by the open cycles.
    """

    dtype, state_schema, zero, limit = "float64", "kwh double, lost boolean", 0.0, np.inf

    def __init__(self, columns: list[str], order=("event_time", "tie"), value: str = "kwh",
                 out: str = "kwh_cumulative", close: bool = False):
        self.columns, self.order, self.value, self.out = list(columns), list(order), value, out
        self.close_cycles = close

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.total = handle.getValueState("total", self.state_schema)

    def _cum(self, start, vals):
        return np.cumsum(np.concatenate([[start], vals]))[1:]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows), ignore_index=True)
        if pdf.empty:
            return
        pdf = pdf.sort_values(self.order, kind="mergesort")
        start, lost = self.total.get() if self.total.exists() else (self.zero, False)
        vals = pdf[self.value].to_numpy(dtype=self.dtype)
        cum = self._cum(start, vals)
        # a reading without a usable number makes the rest of its cycle unknown, as does a total that the state can't hold
        wide = np.abs(float(start) + np.cumsum(vals.astype("float64"))) >= self.limit
        pdf[LOST] = np.logical_or.accumulate(np.concatenate([[lost], pdf[LOST].to_numpy(dtype=bool) | wide]))[1:]
        lost = bool(pdf[LOST].iloc[-1])
        self.total.update((self.zero if lost and self.limit < np.inf else cum[-1].item(), lost))
        if self.close_cycles:
            self.handle.registerTimer(month_end_ms(key[-1]))
            pdf["closed"] = False
        pdf[self.out] = cum
        yield pdf[self._out_cols()]

    def _out_cols(self):
        return self.columns + [self.out] + (["closed"] if self.close_cycles else [])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.total.exists():
            return
        total, lost = self.total.get()
        self.total.clear()
        row = {c: None for c in self.columns}
        row.update({"meter_id": key[0], "month_key": key[-1], self.value: self.zero, "tie": -1,
                    "event_time": pd.Timestamp(expiredTimerInfo.getExpiryTimeInMs(), unit="ms"),
                    self.out: total, LOST: lost, NO_NUMBER: False, "closed": True})
        yield pd.DataFrame([row])[self._out_cols()]

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.total.update((initialState[self.value].iloc[0].item(), False))

    def close(self) -> None:
        pass


class ExactCycleTotals(CycleTotals):
    """As ``CycleTotals`` on integer micro-kWh (exact, order-free sums)."""

    dtype, state_schema, zero, limit = "int64", "micro long, lost boolean", 0, 9.0e18

    def _cum(self, start, vals):
        return int(start) + np.cumsum(vals)


MICRO = 10 ** 6
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def ensure_state_store(spark: SparkSession) -> None:
    """``transformWithState`` keeps its state in column families, which only
    the RocksDB state store provides; select it when the session names another
    provider. A query keeps the provider recorded in its checkpoint."""
    key = "spark.sql.streaming.stateStore.providerClass"
    if spark.conf.get(key, None) != ROCKSDB:
        spark.conf.set(key, ROCKSDB)


def billing_stream(readings: DataFrame, cycle: str = "demo_slot", keys=("meter_id",),
                   initial: DataFrame | None = None, warn: float = WARN_KW,
                   crit: float = CRIT_KW, exact: bool = False,
                   close_after: str | None = None) -> DataFrame:
    """Readings -> billed readings (running kWh per cycle, bill, alert, shares).

    ``initial``: (keys..., month_key, kwh) rows to resume from (I5 per_cycle).
    ``exact``: carry kWh as integer micro-kWh in the state (DECIMAL(20,6) in
    and out), so totals equal the batch DECIMAL path bit for bit; otherwise
    DOUBLE like the original.
    ``close_after`` (calendar months only): watermark delay after which a
    month is closed - one ``closed`` row with its final total is emitted and
    its state dropped; readings later than the watermark are then dropped.
    A 3-minute slot resumes every day, so it is never closed.
    """
    keys = list(keys)
    ensure_state_store(readings.sparkSession)
    if close_after is not None and cycle != "calendar_month":
        raise ValueError("close_after needs cycle='calendar_month'")
    if close_after is not None:
        readings = readings.withWatermark("event_time", close_after)
    df = readings.withColumn("month_key", cycle_key("event_time", cycle))
    if exact:
        df = df.withColumn("kwh", (F.col("kwh").cast("decimal(20,6)") * F.lit(MICRO))
                           .cast("long"))
        out_t, proc = T.LongType(), ExactCycleTotals
    else:
        df = df.withColumn("kwh", F.col("kwh").cast("double"))
        out_t, proc = T.DoubleType(), CycleTotals
    df = df.withColumns({NO_NUMBER: F.coalesce(F.isnan("kw"), F.lit(False)),
                         LOST: F.col("kw").isNotNull() & (F.col("kwh").isNull() | F.isnan(F.col("kwh").cast("double"))),
                         "kwh": F.when(F.col("kwh").isNotNull() & ~F.isnan(F.col("kwh").cast("double")), F.col("kwh"))
                         .otherwise(F.lit(0).cast(out_t))})
    cols = df.columns
    extra = [T.StructField("closed", T.BooleanType())] if close_after is not None else []
    schema = T.StructType(list(df.schema.fields) + [T.StructField("kwh_cumulative", out_t)]
                          + extra)
    init = None
    if initial is not None:
        v = F.col("kwh").cast("decimal(20,6)") * F.lit(MICRO) if exact else F.col("kwh")
        init = initial.select(*keys, "month_key", v.cast(out_t).alias("kwh")) \
            .groupBy(*keys, "month_key")
    out = df.groupBy(*keys, "month_key").transformWithStateInPandas(
        statefulProcessor=proc(cols, close=close_after is not None), outputStructType=schema,
        outputMode="Append", timeMode="EventTime" if close_after is not None else "None",
        initialState=init)
    if exact:
        out = out.withColumns({
            "kwh": (F.col("kwh").cast("decimal(20,0)") / F.lit(MICRO)).cast("decimal(20,6)"),
            "kwh_cumulative": (F.col("kwh_cumulative").cast("decimal(26,0)") / F.lit(MICRO))
            .cast("decimal(26,6)")})
    nan = F.lit(None) if exact else F.lit(float("nan"))
    bad = F.col(NO_NUMBER)
    out = out.withColumns({"kw": F.when(bad, F.lit(float("nan"))).otherwise(F.col("kw")), "kwh": F.when(bad | F.col("kw").isNull(), nan).otherwise(F.col("kwh")),
                           "kwh_cumulative": F.when(F.col(LOST), nan).otherwise(F.col("kwh_cumulative"))}).drop(LOST, NO_NUMBER)
    return classify(running_bill(out), warn, crit)


def state_totals(spark: SparkSession, checkpoint: str, keys=("meter_id",), exact: bool = False) -> DataFrame:
    """(keys, month_key, kwh) as a ``billing_stream`` left them in its state store, read from its checkpoint.

    What the last committed micro-batch holds; ready to be the ``initial`` of
    another stream. Cycles with a reading without a usable number have NULL.
    """
    rows = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "total").load()
    kwh = (F.col("value.micro").cast("decimal(20,0)") / F.lit(MICRO)).cast("decimal(20,6)") if exact else F.col("value.kwh")
    return rows.select(*(F.col(f"key.{k}").alias(k) for k in (*keys, "month_key")), F.when(~F.col("value.lost"), kwh).alias("kwh"))


def message_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """A file stream of JSON messages (one per line) - the topic stand-in."""
    r = spark.readStream.format("text")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(path)


def decoded_stream(messages: DataFrame, meter_id: str = "house") -> tuple[DataFrame, DataFrame]:
    """B4/B5/B8 + I8 on a stream: (readings, rejects). Messages carry no meter
    id, so a constant one is added."""
    dec = decode_readings(messages).withColumn("meter_id", F.lit(meter_id)).withColumn(
        "tie", F.xxhash64("message"))
    good, bad = split_rejects(dec)
    return good.select("meter_id", "event_time", "tie", "kw", "kwh", "sub1", "sub2", "sub3"), bad


def point_sink(root: str, run_id: str, keys=("meter_id",)):
    """A7 + I4 + D9/D10: a ``foreachBatch`` function writing the batch's
    ``power_usage`` and ``monthly_billing`` points and a one-row summary.

    Paths are ``<root>/<table>/run_id=R/batch_id=N/day=D`` written in overwrite
    mode, so a replayed batch (after a failure) rewrites the same files, and a
    time range prunes by day. Empty micro-batches write nothing.
    """
    keys = list(keys)

    def sink(batch_df: DataFrame, batch_id: int) -> None:
        # Persist before the first action: the batch plan holds the stateful
        # step, which would otherwise run once for the emptiness check and
        # again for each write.
        batch_df.persist()
        try:
            if batch_df.isEmpty():
                return
            part = f"run_id={run_id}/batch_id={batch_id}"
            write_points(power_usage(batch_df, keys, extra=("tie", "month_key")),
                         f"{root}/power_usage/{part}", mode="overwrite")
            write_points(monthly_billing(batch_df, keys, extra=("tie",)),
                         f"{root}/monthly_billing/{part}", mode="overwrite")
            pts = power_usage(batch_df, keys, extra=("tie",)).withColumn(
                "batch_id", F.lit(batch_id))
            batch_summary(pts).write.mode("overwrite").parquet(f"{root}/batch_summary/{part}")
        finally:
            batch_df.unpersist()

    return sink


def run_stream(df: DataFrame, sink, checkpoint: str, trigger: str = "2 seconds",
               name: str | None = None):
    """I2 + I3: start ``df`` into a ``foreachBatch`` sink with checkpointed
    offsets and state. ``trigger``: a processing-time interval or 'availableNow'."""
    w = df.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    w = w.trigger(availableNow=True) if trigger == "availableNow" else w.trigger(
        processingTime=trigger)
    return w.start()


def live_mean(readings: DataFrame, interval: str = "5 minutes", watermark: str | None = None,
              keys=(), exact: bool = False) -> DataFrame:
    """Mean kW of each time window.

    Without a watermark every reading counts, however late, and in update
    mode each batch gives the new value of the windows it touched, the open
    one included (write them with ``window_sink``). With a watermark, windows
    that end before it are final and leave the state; later readings of
    theirs don't count.
    ``exact``: sum as DECIMAL(28,6) so the mean does not depend on the order
    partial sums are merged in."""
    r = readings.withColumn("event_time", F.col("event_time").cast("timestamp"))
    r = r if watermark is None else r.withWatermark("event_time", watermark)
    agg = (r.groupBy(*keys, F.window("event_time", interval).alias("w"))
           .agg(mean_of("kw", exact).alias("mean_kw"), F.count(F.lit(1)).alias("points")))
    return agg.select(*keys, F.col("w.start").alias("bucket"), "mean_kw", "points")


def window_sink(root: str):
    """A ``foreachBatch`` function for ``live_mean`` in update mode: a folder for
    each batch (a replay rewrites it). ``current_windows`` reads the latest values."""
    def sink(batch_df: DataFrame, batch_id: int) -> None:
        batch_df.write.mode("overwrite").parquet(f"{root}/batch_id={batch_id}")

    return sink


def current_windows(spark: SparkSession, root: str, keys=()) -> DataFrame:
    """The last value written of each window."""
    return upsert_points(spark.read.parquet(root), [*keys, "bucket"], ["batch_id"]).drop("batch_id")


def reject_sink(root: str, run_id: str):
    """I8: a ``foreachBatch`` function for the rejects of ``decoded_stream``: the
    messages with their reasons under ``<root>/rejects``, one folder a batch."""
    def sink(batch_df: DataFrame, batch_id: int) -> None:
        batch_df.write.mode("overwrite").parquet(f"{root}/rejects/run_id={run_id}/batch_id={batch_id}")

    return sink


def alert_feed(readings: DataFrame, warn: float = WARN_KW, crit: float = CRIT_KW) -> DataFrame:
    """I7 + D9: ``alert_stream`` with the number of alerts and of CRITICAL ones observed in every micro-batch."""
    return alert_stream(readings, warn, crit).observe("alerts", F.count(F.lit(1)).alias("alerts"),
                                                      F.count_if(F.col("alert_level") == "CRITICAL").alias("critical"))


def observed_alerts(query) -> list[tuple[int, int, int]]:
    """(batch id, alerts, CRITICAL) of the recent micro-batches of a running or stopped ``alert_feed`` query."""
    seen = {p.batchId: p.observedMetrics["alerts"] for p in query.recentProgress if "alerts" in p.observedMetrics}
    return [(b, r["alerts"], r["critical"]) for b, r in sorted(seen.items())]


def alert_stream(readings: DataFrame, warn: float = WARN_KW, crit: float = CRIT_KW) -> DataFrame:
    """Stateless feed of WARNING and CRITICAL readings."""
    return (readings.withColumn("alert_level", alert_level("kw", warn, crit))
            .filter(F.col("alert_level").isin("WARNING", "CRITICAL")))
