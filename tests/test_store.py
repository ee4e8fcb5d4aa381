"""Committed point stores and the ledger job: crashes, replays, merges, compaction, pruning."""
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from meterflow.sources.store import PointStore
from meterflow.sources.topic import decode_readings, encode_readings
from meterflow.streaming import ledger

D = dt.datetime
POINTS = "meter_id string, time timestamp, tie long, kw double"


def points(spark, days, first=0):
    return spark.createDataFrame([("m", D(2024, 1, d, h), first + 24 * d + h, float(h)) for d in days for h in range(24)], POINTS)


def opened(df):
    return {f.split("day=")[1].split("/")[0] for f in df.inputFiles()}


def test_nothing_counts_before_its_commit(spark, scratch):
    store = PointStore(spark, scratch)
    assert store.read("points") is None and store.read("points", schema=POINTS).count() == 0
    a = store.stage(points(spark, [1, 2]), "points", "a")
    assert store.read("points") is None
    store.commit("a", a)
    store.stage(points(spark, [2, 3]), "points", "b")  # a crash: never committed
    assert store.read("points").count() == 48 and store.has("a") and not store.has("b")
    again = PointStore(spark, scratch)  # opening a store leaves it as it is
    assert again.read("points").count() == 48 and again.version() == 1


def test_a_range_opens_its_days_only(spark, scratch):
    store = PointStore(spark, scratch)
    store.commit("a", store.stage(points(spark, range(1, 11)), "points", "a"))
    df = store.read("points", "2024-01-04 12:00:00", "2024-01-05 03:00:00")
    assert opened(df) == {"2024-01-04", "2024-01-05"} and df.count() == 16
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    assert store.read("points", "2025-01-01 00:00:00") is None
    months = PointStore(spark, os.path.join(scratch, "m"), "month")
    months.commit("a", months.stage(points(spark, range(1, 11)), "points", "a"))
    assert months.read("points", "2024-01-04 12:00:00", "2024-01-05 03:00:00").count() == 16


def test_merge_rewrites_touched_days_only(spark, scratch):
    store, keys, order = PointStore(spark, scratch), ["meter_id", "time"], ["tie"]
    store.merge("points", points(spark, [1, 2, 3]), keys, order)
    before = {r.day: r.part for r in store.live("points")}
    late = points(spark, [2], first=1000).withColumn("kw", F.col("kw") + 100).unionByName(points(spark, [4]))
    store.merge("points", late, keys, order)
    after = {r.day: r.part for r in store.live("points")}
    assert [d for d in after if after[d] != before.get(d)] == [dt.date(2024, 1, 2), dt.date(2024, 1, 4)]
    got = {r.time: r.kw for r in store.read("points").collect()}
    assert len(got) == 96 and all(v == t.hour + (100 if t.day == 2 else 0) for t, v in got.items())
    assert store.vacuum_paths("points") == [store.folder("points", before[dt.date(2024, 1, 2)], dt.date(2024, 1, 2))]


def test_compaction_keeps_rows_and_bounds_files(spark, scratch):
    store = PointStore(spark, scratch)
    for i in range(5):
        store.commit(f"b{i}", store.stage(points(spark, [1, 2], first=1000 * i).repartition(4), "points", f"b{i}"))
    single = store.stage(points(spark, [7]), "points", "c")
    store.commit("c", single)
    want = sorted(map(tuple, store.read("points").select("meter_id", "time", "tie", "kw").collect()))
    running = store.stage(points(spark, [1], first=9000), "points", "later")  # a sink writes meanwhile
    reader = store.read("points")
    assert store.compact("points", rows_per_file=50) == 10
    assert reader.count() == len(want)  # a query that was planned before still runs
    df = store.read("points")
    assert sorted(map(tuple, df.select("meter_id", "time", "tie", "kw").collect())) == want
    files = [f for f in df.inputFiles() if "day=2024-01-01" in f]
    assert 3 <= len(files) <= 6 and all(len(rs) == 1 for rs in [[r for r in store.live("points") if r.day.day == d] for d in (1, 2, 7)])
    store.commit("later", running)
    assert store.read("points").count() == len(want) + 24 and store.compact("points", least=3) == 0


def batch(spark, rows):
    """Decoded messages of (tie, minute, kw); kw "x" makes a reject."""
    df = spark.createDataFrame([(t, D(2024, 1, 1) + dt.timedelta(minutes=m), float(k) if k != "x" else 0.0, k == "x") for t, m, k in rows],
                               "tie long, event_time timestamp, kw double, bad boolean")
    df = df.withColumns({c: F.lit(0.0) for c in ("sub1", "sub2", "sub3")})
    msgs = encode_readings(df, keys=("tie", "bad"))
    msgs = msgs.withColumn("value", F.when(F.col("bad"), F.lit("{bad").cast("binary")).otherwise(F.col("value")))
    return decode_readings(msgs, keep=("tie",)).withColumn("meter_id", F.lit("house"))


def test_batches_replays_and_crashes(spark, scratch, monkeypatch):
    monkeypatch.setattr(ledger, "SNAPSHOT", 2)
    sink = ledger.ledger_sink(scratch, "r")
    batches = [[(1, 0, 1), (2, 1, 2), (3, 4, 1), (9, 0, "x")], [(4, 2, 1), (5, 1440, 3)], [(6, 1, float("nan")), (7, 5, 2)], [(8, 2, 5), (10, 3, 1)]]
    sink(batch(spark, batches[0]), 0)
    sink(batch(spark, batches[0]), 0)  # replay of a committed batch
    real = PointStore.commit
    monkeypatch.setattr(PointStore, "commit", lambda self, *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError, match="lost"):
        sink(batch(spark, batches[1]), 1)
    store = PointStore(spark, scratch)
    assert {r.tie for r in store.read("power_usage").collect()} == {1, 2, 3}
    monkeypatch.setattr(PointStore, "commit", real)
    for i in (1, 2, 3):
        sink(batch(spark, batches[i]), i)
    sink(batch(spark, []).limit(0), 4)
    assert not store.has("r-000000004")
    got = {r.tie: (r.month_key, r.kwh) for r in store.read("monthly_billing").collect()}
    f = lambda x: None if x is None else float(x)
    # slot 0 of every day goes on: 1.5, +3, then +1.5 and the next day's 4.5; unknown from the NaN on
    assert {t: (k, f(v)) for t, (k, v) in got.items()} == {
        1: ("demo-0-0", 1.5), 2: ("demo-0-0", 4.5), 3: ("demo-0-1", 1.5), 4: ("demo-0-0", 6.0), 5: ("demo-0-0", 10.5),
        6: ("demo-0-0", None), 7: ("demo-0-1", 4.5), 8: ("demo-0-0", None), 10: ("demo-0-1", 6.0)}
    assert [(r.tie, r.reject, r.batch_id) for r in store.read("rejects").collect()] == [(9, "json", 0)]
    assert {(r.batch_id, r.points, r.critical) for r in store.read("batch_summary").collect()} == {(0, 3, 0), (1, 2, 0), (2, 2, 1), (3, 2, 1)}
    assert len(store.live("totals")) <= 3
    assert {(r.month_key, f(r.kwh), r.lost) for r in ledger.totals(store).collect()} == {("demo-0-0", 18.0, True), ("demo-0-1", 6.0, False)}


def test_months_close_once_and_late_readings_stay(spark, scratch):
    sink = ledger.ledger_sink(scratch, "r", "calendar_month", close_after=dt.timedelta(days=1), unit="month")
    day = 1440
    sink(batch(spark, [(1, 0, 1), (2, 30 * day, 1)]), 0)
    sink(batch(spark, [(3, 31 * day, 2)]), 1)  # 1 February: less than a day after the end of January
    store = PointStore(spark, scratch, "month")
    assert store.read("closed") is None
    sink(batch(spark, [(4, 3 * day, 4), (5, 33 * day, 2)]), 2)
    sink(batch(spark, [(6, 5 * day, 8), (7, 62 * day, 1)]), 3)
    assert {(r.month_key, float(r.kwh)) for r in store.read("closed").collect()} == {("2024-01", 9.0), ("2024-02", 6.0)}
    assert [r.tie for r in store.read("late").collect()] == [6]
    assert {r.tie for r in store.read("power_usage").collect()} == {1, 2, 3, 4, 5, 7}


def test_a_batch_is_billed_once_and_kept_without_its_text(spark, scratch, monkeypatch):
    """The bills come from the points that were written; only rejects are kept as text, and their text is whole."""
    bills, split, billed, kept = ledger.monthly_billing, ledger.split_rejects, [], []
    monkeypatch.setattr(ledger, "monthly_billing", lambda df, keys: (billed.append(df), bills(df, keys))[1])
    monkeypatch.setattr(ledger, "split_rejects", lambda df: (kept.extend(df.select("tie", "message", "kwh").collect()), split(df))[1])
    ledger.ledger_sink(scratch, "r")(batch(spark, [(1, 0, 1), (2, 1, 2), (9, 0, "x")]), 0)
    plan = billed[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "InMemoryRelation" not in plan and "parquet" in plan
    assert {(r.tie, r.message, r.kwh if r.kwh is None else str(r.kwh)) for r in kept} == {(1, None, "1.500000"), (2, None, "3.000000"), (9, "{bad", None)}
    store = PointStore(spark, scratch)
    assert [(r.tie, r.message) for r in store.read("rejects").collect()] == [(9, "{bad")]
    assert {(r.tie, str(r.kwh)) for r in store.read("monthly_billing").collect()} == {(1, "1.500000"), (2, "4.500000")}


def test_observed_alerts_equal_the_feed(spark):
    from meterflow.plans.queries import _alert_feed
    feed, seen = _alert_feed(spark, "/root/testdata/sf0.001")
    n, critical = feed.count(), feed.filter("alert_level = 'CRITICAL'").count()
    assert (sum(r[2] for r in seen), sum(r[3] for r in seen)) == (n, critical)
    assert len([r for r in seen if r[0] == 2]) >= 2  # the processing-time run took two batches
