"""Skew-safe ordered scans equal the plain per-key window."""
import datetime as dt
from decimal import Decimal

from pyspark.sql import Window
from pyspark.sql import functions as F

from meterflow.operators import billing, scan
from meterflow.operators.scan import previous_row, running_total, running_totals
from meterflow.sources import tables

SF = "/root/testdata/sf0.01"
ORDER = ["event_time", "tie"]


def _readings(spark, house):
    return billing.with_cycle(tables.readings(spark, SF, house=house), "demo_slot")


def _hard(spark):
    """Null keys, null times, ties, a burst within one second and one far outlier."""
    t0 = dt.datetime(2024, 1, 1)
    times = [None] * 4 + [t0 + dt.timedelta(microseconds=137 * i) for i in range(300)] + [
        t0 + dt.timedelta(minutes=7 * i) for i in range(60)] + [t0] * 5 + [dt.datetime(1969, 12, 31, 23, 59, 59, 999999), dt.datetime(2090, 1, 1)]
    rows = [(["a", "b", None][i % 3 if i % 2 else 0], t, i, None if i % 11 == 0 else Decimal(i) / 8, i % 5) for i, t in enumerate(times)]
    return spark.createDataFrame(rows, "meter_id string, event_time timestamp, tie long, kwh decimal(20,6), n int").repartition(5)


def test_running_total_equals_window(spark):
    w = Window.partitionBy("meter_id").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, 0)
    for r in (_readings(spark, True), _readings(spark, False), _hard(spark)):
        a = running_total(r, ["meter_id"], ORDER, "kwh", "c")
        b = r.select("tie", F.sum("kwh").over(w).alias("ref"))
        assert a.schema["c"].dataType == b.schema["ref"].dataType and a.columns == [*r.columns, "c"]
        j = a.join(b, "tie")
        assert j.count() == r.count()
        assert j.filter(~F.col("c").eqNullSafe(F.col("ref"))).count() == 0


def test_two_totals_in_one_scan(spark):
    r = _hard(spark)
    both = running_totals(r, ["meter_id"], ORDER, {"a": "kwh", "b": "n"})
    for out, value in (("a", "kwh"), ("b", "n")):
        j = both.select("tie", out).join(running_total(r, ["meter_id"], ORDER, value, "ref").select("tie", "ref"), "tie")
        assert j.filter(~F.col(out).eqNullSafe(F.col("ref"))).count() == 0


def test_no_window_over_rows_spans_a_whole_key(spark):
    plan = running_total(_readings(spark, True), ["meter_id"], ORDER, "kwh", "c")._jdf.queryExecution().optimizedPlan().toString()
    windows = [x for x in plan.split("\n") if "Window [" in x]
    assert len(windows) == 3 and sum("_part" in x.split("],")[1] for x in windows) >= 1


def test_rows_of_one_time_or_none_split_by_ties(spark, monkeypatch):
    """A third of the rows without a time and a third at one second, all of one meter, ties negative and null too."""
    monkeypatch.setattr(scan, "TIES", 16)
    t0 = dt.datetime(2024, 1, 1, 10, 0, 5)
    micros = [t0 + dt.timedelta(microseconds=m) for m in (1, 1, 999, 1000, 1000, 1001, 2500)]
    times = [None] * 300 + [t0] * 300 + micros * 20 + [t0 + dt.timedelta(seconds=i) for i in range(150)]
    ties = [(i * 7919) % 1009 - 300 for i in range(len(times))]
    assert len(set(ties)) == len(ties)
    rows = [("m", t, k, Decimal(k) / 4) for t, k in zip(times, ties)] + [("m", None, None, Decimal(1)), ("m", t0, None, Decimal(2))]
    r = spark.createDataFrame(rows, "meter_id string, event_time timestamp, tie long, kwh decimal(20,6)").repartition(4)
    cells = scan._cells(r, ORDER).groupBy("meter_id", *scan.CELL).count()
    assert cells.agg(F.max("count")).first()[0] <= 60  # three instants within one millisecond
    assert cells.filter("_part < 9223372036854775807L").agg(F.max("count")).first()[0] <= 16
    w = Window.partitionBy("meter_id").orderBy(*ORDER)
    ref = r.select("event_time", "tie", F.sum("kwh").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("sum"), F.lag("kwh").over(w).alias("lag"))
    got = previous_row(running_total(r, ["meter_id"], ORDER, "kwh", "c"), ["meter_id"], ORDER, ["kwh"]).select("event_time", "tie", "c", "prev_kwh")
    narrow = previous_row(r.select("meter_id", *ORDER, "kwh"), ["meter_id"], ORDER, ["kwh"]).select("event_time", "tie", "prev_kwh")
    want = sorted(map(str, ref.collect()))
    assert sorted(str(x).replace("c=", "sum=").replace("prev_kwh=", "lag=") for x in got.collect()) == want
    assert sorted(str(x) for x in narrow.collect()) == sorted(str(x).replace("lag=", "prev_kwh=") for x in ref.drop("sum").collect())


def test_rollovers_compute_the_bills_once(spark):
    out = billing.rollovers(billing.bill_readings(_readings(spark, True), cycle="demo_slot"))
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in plan and plan.count("FileScan") <= 3  # those of the running total


def test_crowded_hours_are_cut_and_others_moved_once(spark, monkeypatch):
    """Hours above and below CROWD, null keys too: right sums and previous rows, cells that are few, no row moved
    again for the join with what the cells hand on."""
    monkeypatch.setattr(scan, "TIES", 8)
    monkeypatch.setattr(scan, "CROWD", 40)
    t0 = dt.datetime(2024, 1, 1)
    times = [None] * 150 + [t0] * 100 + [t0 + dt.timedelta(seconds=3 * i) for i in range(100)] + [t0 + dt.timedelta(days=1 + i // 20) for i in range(400)]
    rows = [(None if k % 3 == 2 else f"m{k % 3}", t, 1000 * (k * 7919 % 1009), Decimal(k) / 4) for k, t in enumerate(times)]
    r = spark.createDataFrame(rows, "meter_id string, event_time timestamp, tie long, kwh decimal(20,6)").repartition(4)
    w = Window.partitionBy("meter_id").orderBy(*ORDER)
    ref = r.select("tie", F.sum("kwh").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("sum"), F.lag("kwh").over(w).alias("lag"))
    got = previous_row(running_total(r, ["meter_id"], ORDER, "kwh", "c"), ["meter_id"], ORDER, ["kwh"]).select("tie", "c", "prev_kwh")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, ref.collect()))
    keyed = scan._keyed(r, ["meter_id"], ORDER, ORDER)
    crowded = keyed.groupBy(scan.KEY, scan.HOUR).count().filter(F.col("count") > 40)
    cells = scan._merged(keyed, crowded).groupBy(scan.KEY, *scan.CELL).count()
    quiet = cells.join(crowded.select(scan.KEY, scan.HOUR), [scan.KEY, scan.HOUR], "left_anti")
    assert crowded.count() == 6 and quiet.count() == 3 * 20 and cells.count() > 60 + 200
    monkeypatch.setattr(scan, "CROWD", 1 << 16)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = running_total(r, ["meter_id"], ORDER, "kwh", "c")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    lines = plan.split("\n")
    at = next(i for i, x in enumerate(lines) if "SortMergeJoin" in x and "_part" in x)
    under = next(i for i, x in enumerate(lines) if i > at and "Window" in x)
    assert not any("Exchange" in x for x in lines[at:under])
    # rows of one date whose ties lie far apart share their cell, where the cells of the ties were as many as the rows
    far = spark.range(300).select(F.lit("m").alias("meter_id"), F.lit(t0).alias("event_time"), (F.col("id") * 10 * scan.TIES).alias("tie"))
    far = scan._keyed(far, ["meter_id"], ORDER, ORDER)
    assert scan._merged(far, far.groupBy(scan.KEY, scan.HOUR).count().filter(f"count > {scan.CROWD}")).groupBy(scan.KEY, *scan.CELL).count().count() == 1


def test_previous_row_equals_lag(spark):
    w = Window.partitionBy("meter_id").orderBy(*ORDER)
    for r, cols in ((_readings(spark, True), ["month_key", "kwh"]), (_hard(spark), ["kwh", "n"])):
        a = previous_row(r, ["meter_id"], ORDER, cols)
        b = r.select("tie", *(F.lag(c).over(w).alias(f"ref_{c}") for c in cols))
        j = a.join(b, "tie")
        assert j.count() == r.count()
        for c in cols:
            assert j.filter(~F.col(f"prev_{c}").eqNullSafe(F.col(f"ref_{c}"))).count() == 0


def test_rollovers_with_null_times(spark):
    rows = [("m", None, i, 1.0) for i in range(3)] + [("m", dt.datetime(2024, 1 + i // 4, 1 + i % 4), 10 + i, 1.0) for i in range(24)]
    r = spark.createDataFrame(rows, "meter_id string, event_time timestamp, tie long, kwh double")
    r = r.withColumns({"kw": F.lit(1.0), "sub1": F.lit(0.0), "sub2": F.lit(0.0), "sub3": F.lit(0.0)})
    got = sorted((x.new_key, x.prev_key, x.prev_kwh) for x in billing.rollovers(billing.bill_readings(r)).collect())
    assert got == [(f"2024-0{k}", f"2024-0{k - 1}", 4.0) for k in range(2, 7)]


def test_nan_reading_makes_the_rest_of_its_cycle_unknown(spark):
    rows = [("m", dt.datetime(2024, 1, 1, 0, i), i, kw) for i, kw in enumerate([2.0, 1.0, float("nan"), 1.0])] + [
        ("m", dt.datetime(2024, 2, 1), 9, 4.0), ("m", dt.datetime(2024, 2, 2), 10, None), ("m", dt.datetime(2024, 2, 3), 11, 1e13)]
    from meterflow.functions import kwh
    base = spark.createDataFrame(rows, "meter_id string, event_time timestamp, tie long, kw double")
    base = base.withColumns({f"sub{i}": F.lit(0.0) for i in (1, 2, 3)})
    exact = billing.bill_readings(base.withColumn("kwh", kwh("kw", 1.5, exact=True))).orderBy("tie").collect()
    assert [None if r.kwh_cumulative is None else float(r.kwh_cumulative) for r in exact] == [3.0, 4.5, None, None, 6.0, 6.0, None]
    assert exact[2].alert_level == "CRITICAL"
    loose = billing.bill_readings(base.withColumn("kwh", kwh("kw", 1.5))).orderBy("tie").collect()
    assert [str(r.kwh_cumulative) for r in loose][:4] == ["3.0", "4.5", "nan", "nan"]


def test_cycle_deltas_sum_to_final_bill(spark):
    r = billing.with_cycle(tables.readings(spark, SF, house=True), "calendar_month")
    cum = billing.cumulative_kwh(r)
    last = cum.groupBy("meter_id", "month_key").agg(
        F.max_by("kwh_cumulative", F.struct("event_time", "tie")).alias("last"))
    fin = billing.final_bills(r)
    j = last.join(fin, ["meter_id", "month_key"])
    assert j.filter(F.col("last") != F.col("kwh")).count() == 0
    assert j.count() == fin.count()


def test_rollover_fold_matches_python_fold(spark):
    """E3 against a row-by-row fold of the original semantics (single meter, slots)."""
    billed = billing.bill_readings(tables.readings(spark, "/root/testdata/sf0.001", house=True),
                                   cycle="demo_slot")
    got = {(r["new_key"], r["prev_key"], float(r["prev_kwh"]))
           for r in billing.rollovers(billed).collect()}
    rows = sorted(((r["event_time"], r["tie"], r["month_key"], r["kwh"]) for r in
                   billed.select("event_time", "tie", "month_key", "kwh").toLocalIterator()))
    state, last, want = {}, None, set()
    for _, _, key, k in rows:
        if key not in state:
            state[key] = 0
            if last is not None and key != last:
                want.add((key, last, float(state[last])))
        last = key
        state[key] += k
    assert got == want and len(want) > 100
