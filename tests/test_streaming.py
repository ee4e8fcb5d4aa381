"""Structured Streaming: stream equals batch, restart continues, replay is idempotent."""
import datetime as dt
import json
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from meterflow.operators.dashboard import bucket_mean
from meterflow.sources.topic import decode_readings, split_rejects
from meterflow.streaming import billing as sb

SF = "/root/testdata/sf0.001"


def write_day_files(folder, days=None):
    """One JSON-lines message file per day, modification times in day order."""
    os.makedirs(folder, exist_ok=True)
    t = pq.read_table(f"{SF}/events.parquet").to_pandas().sort_values(["ts", "event_id"])
    t["day"] = t.ts.dt.date
    names = []
    for i, (day, g) in enumerate(sorted(t.groupby("day"), key=lambda x: x[0])):
        if days is not None and i not in days:
            continue
        p = os.path.join(folder, f"m{i:03d}.json")
        with open(p, "w") as f:
            for r in g.itertuples():
                k = json.loads(r.props)["k"]
                f.write(json.dumps({"event_time": r.ts.strftime("%Y-%m-%d %H:%M:%S"),
                                    "kw": r.value / 25, "sub1": k * 0.1, "sub2": k * 0.05,
                                    "sub3": (99 - k) * 0.1}) + "\n")
        os.utime(p, (1e9 + i, 1e9 + i))
        names.append(p)
    return names


def run(spark, src, out, ckpt, run_id="r1", max_files=10, initial=None):
    good, _ = sb.decoded_stream(sb.message_stream(spark, src, max_files))
    billed = sb.billing_stream(good, cycle="demo_slot", initial=initial)
    q = sb.run_stream(billed, sb.point_sink(out, run_id), ckpt, "availableNow")
    q.awaitTermination()
    return q


def batch_reference(spark, src):
    good, _ = split_rejects(decode_readings(spark.read.text(src)).withColumn(
        "tie", F.xxhash64("message")).withColumn("meter_id", F.lit("house")))
    good = good.withColumn("month_key", F.concat(
        F.lit("demo-"), F.hour("event_time").cast("string"), F.lit("-"),
        F.floor(F.minute("event_time") / 3).cast("string")))
    w = Window.partitionBy("meter_id", "month_key").orderBy("event_time", "tie")
    return good.select("tie", F.sum("kwh").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("ref"))


def _compare(spark, got, ref):
    j = got.join(ref, "tie")
    assert j.count() == ref.count() == got.count()
    rows = j.select("kwh_cumulative", "ref").collect()
    assert all(r[0] == pytest.approx(r[1], rel=1e-12, abs=1e-12) for r in rows)


def test_stream_equals_batch_and_restart(spark, scratch):
    src, out, ckpt = (os.path.join(scratch, x) for x in ("in", "out", "ckpt"))
    write_day_files(src, days=set(range(15)))
    q1 = run(spark, src, out, ckpt)
    first_batches = q1.lastProgress["batchId"]
    write_day_files(src, days=set(range(15, 40)))
    run(spark, src, out, ckpt)
    pu = spark.read.parquet(os.path.join(out, "power_usage"))
    assert pu.agg(F.max("batch_id")).first()[0] > first_batches  # ids continue after restart
    _compare(spark, pu, batch_reference(spark, src))
    summ = spark.read.parquet(os.path.join(out, "batch_summary"))
    assert summ.agg(F.sum("points")).first()[0] == pu.count()


def test_replay_is_idempotent_and_empty_skipped(spark, scratch):
    out = os.path.join(scratch, "out")
    rows = [("house", dt.datetime(2024, 1, 1, 0, 0, 1), 1, 2.0, 3.0, 0.0, 0.0, 0.0, "demo-0-0", 3.0)]
    df = spark.createDataFrame(rows, "meter_id string, event_time timestamp, tie long, kw double, "
                                     "kwh double, sub1 double, sub2 double, sub3 double, "
                                     "month_key string, kwh_cumulative double")
    from meterflow.operators.billing import classify, running_bill
    billed = classify(running_bill(df))
    sink = sb.point_sink(out, "r1")
    sink(billed, 7)
    sink(billed, 7)  # replay of the same batch
    sink(billed.limit(0), 8)  # empty batch writes nothing
    pu = spark.read.parquet(os.path.join(out, "power_usage"))
    assert pu.count() == 1 and pu.first()["batch_id"] == 7


def test_initial_state(spark, scratch):
    src = os.path.join(scratch, "in")
    first = write_day_files(src, days={0})[0]
    with open(first) as f:
        t0 = dt.datetime.strptime(json.loads(f.readline())["event_time"], "%Y-%m-%d %H:%M:%S")
    key = f"demo-{t0.hour}-{t0.minute // 3}"
    init = spark.createDataFrame([("house", key, 100.0)], "meter_id string, month_key "
                                                          "string, kwh double")
    out, ckpt = os.path.join(scratch, "out"), os.path.join(scratch, "ckpt")
    run(spark, src, out, ckpt, initial=init)
    pu = spark.read.parquet(os.path.join(out, "power_usage"))
    ref = batch_reference(spark, src)
    j = pu.join(ref, "tie").select("month_key", "kwh_cumulative", "ref").collect()
    for r in j:
        extra = 100.0 if r["month_key"] == key else 0.0
        assert r["kwh_cumulative"] == pytest.approx(r["ref"] + extra, rel=1e-12)
    assert any(r["month_key"] == key for r in j)


def test_live_mean_and_alert_stream(spark, scratch):
    src = os.path.join(scratch, "in")
    write_day_files(src, days=set(range(6)))
    good, _ = sb.decoded_stream(sb.message_stream(spark, src, 2))
    q = (sb.live_mean(good, "1 hour", "0 seconds").writeStream.outputMode("append")
         .format("memory").queryName("live_mean_t").trigger(availableNow=True)
         .option("checkpointLocation", os.path.join(scratch, "c1")).start())
    q.awaitTermination()
    got = {r["bucket"]: r["mean_kw"] for r in spark.sql("SELECT * FROM live_mean_t").collect()}
    bgood, _ = split_rejects(decode_readings(spark.read.text(src)))
    ref = {r["bucket"]: r["mean_kw"] for r in
           bucket_mean(bgood, ["kw"], "1 hour", time="event_time", fill="none").collect()}
    assert got and all(got[b] == pytest.approx(ref[b], rel=1e-12) for b in got)
    q2 = (sb.alert_stream(good).writeStream.format("memory").queryName("alerts_t")
          .trigger(availableNow=True).option("checkpointLocation", os.path.join(scratch, "c2"))
          .start())
    q2.awaitTermination()
    levels = {r[0] for r in spark.sql("SELECT alert_level FROM alerts_t").collect()}
    n_ref = bgood.filter(F.col("kw") >= 3).count()
    assert levels <= {"WARNING", "CRITICAL"} and spark.table("alerts_t").count() == n_ref


def test_calendar_month_closes(spark, scratch):
    """A February reading moves the watermark past January: January is closed
    with its final total and its state dropped."""
    src = os.path.join(scratch, "in")
    write_day_files(src, days=set(range(40)))
    feb = os.path.join(src, "z_feb.json")
    with open(feb, "w") as f:
        f.write(json.dumps({"event_time": "2024-02-02 00:00:00", "kw": 1.0, "sub1": 0.0,
                            "sub2": 0.0, "sub3": 0.0}) + "\n")
    os.utime(feb, (2e9, 2e9))
    good, _ = sb.decoded_stream(sb.message_stream(spark, src, 40))
    billed = sb.billing_stream(good, cycle="calendar_month", close_after="1 hour")
    q = (billed.writeStream.format("memory").queryName("closing_t").outputMode("append")
         .trigger(availableNow=True).option("checkpointLocation", os.path.join(scratch, "c"))
         .start())
    q.awaitTermination()
    out = spark.table("closing_t")
    closed = out.filter("closed").collect()
    jan = [r for r in closed if r["month_key"] == "2024-01"]
    total = out.filter("NOT closed AND month_key = '2024-01'").agg(F.sum("kwh")).first()[0]
    assert len(jan) == 1 and jan[0]["kwh_cumulative"] == pytest.approx(total, rel=1e-12)
    assert jan[0]["event_time"] == dt.datetime(2024, 2, 1) and jan[0]["alert_level"] is None


def test_a_nan_message_makes_only_its_cycle_unknown(spark, scratch):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    kws = [(0, 2.0), (1, 1.0), (2, float("nan")), (2, 1.0), (4, 5.0), (5, 1.0)]  # slots of three minutes
    with open(os.path.join(src, "m.json"), "w") as f:
        for s, (m, kw) in enumerate(kws):
            f.write(json.dumps({"event_time": f"2024-01-01 00:0{m}:0{s}", "kw": kw, "sub1": 0.0, "sub2": 0.0, "sub3": 0.0}) + "\n")
    for exact, unknown in ((False, float("nan")), (True, None)):
        out = os.path.join(scratch, f"out{exact}")
        good, _ = sb.decoded_stream(sb.message_stream(spark, src))
        if exact:
            good = good.withColumn("kwh", (F.col("kw").try_cast("decimal(18,6)") * F.lit(1.5).cast("decimal(18,6)")).cast("decimal(20,6)"))
        q = sb.run_stream(sb.billing_stream(good, exact=exact), sb.point_sink(out, "r"), os.path.join(scratch, f"ckpt{exact}"), "availableNow")
        q.awaitTermination()
        rows = spark.read.parquet(os.path.join(out, "power_usage")).orderBy("time").collect()
        assert [str(float(r.kwh_cumulative)) if r.kwh_cumulative is not None else None for r in rows] == [
            "3.0", "4.5", *[str(unknown) if unknown is not None else None] * 2, "7.5", "9.0"]
        assert rows[2].alert_level == "CRITICAL" and str(rows[2].kw) == "nan"


def test_state_store_equals_the_recovered_totals(spark, scratch):
    from meterflow.operators.points import recover_totals
    src, out, ckpt = (os.path.join(scratch, x) for x in ("in", "out", "ckpt"))
    write_day_files(src, days=set(range(12)))
    run(spark, src, out, ckpt)
    mb = spark.read.parquet(os.path.join(out, "monthly_billing"))
    want = {(r.meter_id, r.month_key): r.kwh for r in mb.groupBy("meter_id", "month_key").agg(F.max("kwh").alias("kwh")).collect()}
    got = {(r.meter_id, r.month_key): r.kwh for r in sb.state_totals(spark, ckpt).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], rel=1e-12) for k in want)
    rec = recover_totals(None, mode="per_cycle", billing=mb, order=("batch_id", "time", "tie"))
    assert {(r.meter_id, r.month_key) for r in rec.collect()} == got.keys()


def test_a_total_beyond_the_state_is_unknown():
    import pandas as pd

    class Held:
        value = None
        exists = lambda self: self.value is not None
        get = lambda self: self.value

        def update(self, x):
            self.value = x

    proc = sb.ExactCycleTotals(["tie", sb.LOST])
    proc.total = Held()
    rows = pd.DataFrame({"event_time": pd.Timestamp("2024-01-01"), "tie": range(8), "kwh": [1_500_000_000_000_000_000] * 8, sb.LOST: False})
    first = next(proc.handleInputRows(("m", "c"), iter([rows]), None))
    assert first[sb.LOST].tolist() == [False] * 5 + [True] * 3 and first["kwh_cumulative"][4] == 7_500_000_000_000_000_000
    again = next(proc.handleInputRows(("m", "c"), iter([rows[:1].assign(kwh=1)]), None))
    assert again[sb.LOST].tolist() == [True] and proc.total.value == (0, True)
