"""Dashboard reads and point-store semantics: FIXTURES X5 edges."""
import datetime as dt

from pyspark.sql import functions as F

from meterflow.operators import dashboard as db

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def _pts(spark, rows):
    return spark.createDataFrame(rows, "time timestamp, tie long, alert_level string, kw double, "
                                       "suggestion string")


def test_latest_skips_null_and_uses_tie(spark):
    rows = [(T0, 1, "INFO", 1.0, "a"), (T0 + dt.timedelta(seconds=5), 2, "INFO", None, "b"),
            (T0 + dt.timedelta(seconds=5), 3, "INFO", None, "c")]
    got = db.latest(_pts(spark, rows), ["kw", "suggestion"]).collect()[0]
    assert got["kw"] == 1.0 and got["suggestion"] == "c"


def test_upsert_last_write_wins(spark):
    rows = [(T0, 1, "INFO", 1.0, "a"), (T0, 2, "INFO", 2.0, "b"),      # same key: later wins
            (T0, 3, "WARNING", 3.5, "c")]                              # other level: stays
    up = db.upsert_points(_pts(spark, rows), ["time", "alert_level"], ["time", "tie"]).collect()
    got = sorted((r["alert_level"], r["kw"]) for r in up)
    assert got == [("INFO", 2.0), ("WARNING", 3.5)]


def test_alert_log_newest_fifty(spark):
    rows = [(T0 + dt.timedelta(minutes=i), i, "WARNING", 3.0 + i / 100, "s") for i in range(51)]
    rows.append((T0 + dt.timedelta(minutes=99), 99, "INFO", 2.5, "s"))
    log = db.alert_log(_pts(spark, rows)).collect()
    assert len(log) == 50 and log[0]["time"] == T0 + dt.timedelta(minutes=50)
    assert all(r["kw"] >= 3 for r in log)


def test_bucket_fill_null_and_linear(spark):
    # buckets 0,1,2,3,4 of 5 minutes: 0 empty, 1 = 1.0, 2 empty, 3 = 3.0, 4 empty
    rows = [(T0 + dt.timedelta(minutes=6), 1, "INFO", 1.0, "s"),
            (T0 + dt.timedelta(minutes=16), 2, "INFO", 2.0, "s"),
            (T0 + dt.timedelta(minutes=17), 3, "INFO", 4.0, "s")]
    pts = _pts(spark, rows)
    rng = ("2024-01-01 00:00:00", "2024-01-01 00:24:59")
    null = db.bucket_mean(pts, ["kw"], "5 minutes", *rng, fill="null").orderBy("bucket").collect()
    assert [r["mean_kw"] for r in null] == [None, 1.0, None, 3.0, None]
    lin = db.bucket_mean(pts, ["kw"], "5 minutes", *rng, fill="linear").orderBy("bucket").collect()
    assert [r["mean_kw"] for r in lin] == [None, 1.0, 2.0, 3.0, None]
    none = db.bucket_mean(pts, ["kw"], "5 minutes", *rng, fill="none").collect()
    assert len(none) == 2


def test_time_range_inclusive_and_peak(spark):
    rows = [(T0, 1, "INFO", 1.0, "a"), (T0 + dt.timedelta(minutes=10), 2, "INFO", 5.0, "b")]
    pts = _pts(spark, rows)
    assert db.time_range(pts, T0, T0 + dt.timedelta(minutes=10)).count() == 2
    assert db.peak(pts, "kw").collect()[0][0] == 5.0
    assert db.peak(pts, "kw", T0, T0).collect()[0][0] == 1.0


def test_rename_regex_and_mix(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "`power_usage.a` double, b double")
    assert db.rename_regex(df, r"power_usage\.(.*)", r"\1").columns == ["a", "b"]
    rows = [(T0, 1, 10.0, 30.0, 60.0)]
    pts = spark.createDataFrame(rows, "time timestamp, tie long, sub1_pct double, sub2_pct double, "
                                      "sub3_pct double")
    mix = db.load_mix(pts).collect()[0]
    assert (mix["kitchen_share"], mix["laundry_share"], mix["water_heater_share"]) == (10.0, 30.0, 60.0)


def test_time_range_prunes_days_of_the_point_store(spark, scratch):
    from meterflow.sources.sinks import write_points
    rows = [(T0 + dt.timedelta(hours=7 * i), i, "INFO", 1.0, "s") for i in range(60)]
    write_points(_pts(spark, rows), f"{scratch}/points")
    lo, hi = T0 + dt.timedelta(days=3), T0 + dt.timedelta(days=4, hours=5)
    df = db.time_range(spark.read.parquet(f"{scratch}/points"), lo, hi)
    assert sorted(r.tie for r in df.collect()) == [i for i in range(60) if lo <= rows[i][0] <= hi]
    plan = df._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("PartitionFilters"):]
    assert "day" in scan[:scan.index("]")] and len(df.inputFiles()) > 0
    assert "GreaterThanOrEqual(time" in plan


def test_runs_of_gaps_equal_a_spine(spark):
    import datetime as dt
    import random
    from meterflow.operators.dashboard import fill_gaps, interpolate_linear
    rng = random.Random(2)
    day = dt.date(2024, 1, 1)
    rows = [(m, day + dt.timedelta(days=i), rng.choice([None, rng.random()]), rng.choice([None, rng.random()]))
            for m in "abcd" for i in range(40) if rng.random() < 0.3]
    df = spark.createDataFrame(rows, "m string, ds date, y double, z double")
    step = F.expr("INTERVAL 1 DAY")
    lo, hi = F.lit(day), F.lit(day + dt.timedelta(days=45))
    for a, b in ((None, None), (lo, hi)):
        span = df.groupBy("m").agg(F.min("ds").alias("a"), F.max("ds").alias("b"))
        spine = span.select("m", F.explode(F.sequence("a" if a is None else a, "b" if b is None else b)).alias("ds"))
        want = spine.join(df, ["m", "ds"], "left")
        plain = fill_gaps(df, ["m"], "ds", ["y", "z"], step, a, b)
        assert sorted(plain.collect(), key=str) == sorted(want.collect(), key=str)
        linear = fill_gaps(df, ["m"], "ds", ["y", "z"], step, a, b, linear=True)
        assert sorted(linear.collect(), key=str) == sorted(interpolate_linear(want, ["m"], "ds", ["y", "z"]).select("m", "ds", "y", "z").collect(), key=str)
    plan = fill_gaps(df, ["m"], "ds", ["y"], step, lo, hi, linear=True)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1
