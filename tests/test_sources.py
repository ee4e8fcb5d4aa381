"""Meter files (both dialects, both cleanings) and topic messages: FIXTURES X1-X3."""
import pytest
import datetime as dt
import math
import os

from meterflow.schemas import CSV_HEADER, TXT_HEADER
from meterflow.sources import files, topic

TXT_LINES = [
    "16/12/2006;17:24:00;4.216;0.418;234.840;18.400;0.000;1.000;17.000",  # keep / keep
    "1/1/2007;0:05:00;2.5;0.1;240.0;10.0;0;0;0",                          # keep / keep
    "28/4/2007;00:21:00;?;?;?;?;?;?;",                                    # drop / drop
    "28/4/2007;00:22:00;1.5;?;240.1;6.2;0;0;1",                           # drop / keep
    "28/4/2007;00:23:00;1.5;0.1;240.1;6.2;;;",                            # keep (subs 0) / keep
    "28/4/2007;00:24:00;1.5;0.1;240.1;6.2;x;0;1",                         # drop / keep
    "28/4/2007;00:25:00",                                                 # drop / drop
    "",                                                                   # drop / drop
    "99/99/2007;00:26:00;1.5;0;0;0;0;0;0",                                # keep / drop
]


def _write(path, header, lines):
    with open(path, "w") as f:
        f.write(header + "\n" + "\n".join(lines) + "\n")


def test_txt_strict_and_loose(spark, scratch):
    p = os.path.join(scratch, "power.txt")
    _write(p, TXT_HEADER, TXT_LINES)
    lines = files.read_lines(spark, p)
    strict = files.strict_rows(lines).collect()
    loose = files.loose_rows(lines).collect()
    assert [r["kw"] for r in strict] == [4.216, 2.5, 1.5, 1.5]
    assert strict[2]["sub1"] == 0.0 and strict[2]["sub3"] == 0.0
    assert strict[3]["event_time"] is None  # strict cleaning keeps a bad date
    assert strict[1]["event_time"] == dt.datetime(2007, 1, 1, 0, 5)
    assert [r["kw"] for r in loose] == [4.216, 2.5, 1.5, 1.5, 1.5]
    assert loose[3]["sub1"] is None  # 'x' coerced to NULL


def test_csv_dialect_and_mixed_folder(spark, scratch):
    os.makedirs(os.path.join(scratch, "mixed"))
    _write(os.path.join(scratch, "mixed", "a.csv"), CSV_HEADER,
           ["2006-12-16 17:24:00,4.216,0.418,234.84,18.4,0,1,17", "2006-12-16 17:25:00,?,0,0,0,0,0,0",
            "bad,1.0,0,0,0,0,0,0"])
    _write(os.path.join(scratch, "mixed", "b.txt"), TXT_HEADER, TXT_LINES[:2])
    r = files.load_readings(spark, os.path.join(scratch, "mixed"), "strict")
    got = sorted((x["kw"], x["sub3"]) for x in r.collect())
    # the CSV line with a bad date is kept by the strict cleaning (date not needed)
    assert got == [(1.0, 0.0), (2.5, 0.0), (4.216, 17.0), (4.216, 17.0)]
    loose = files.load_readings(spark, os.path.join(scratch, "mixed"), "loose").collect()
    assert sorted(x["kw"] for x in loose) == [2.5, 4.216, 4.216]
    assert {x["kwh"] for x in loose} == {2.5 * 1.5, 4.216 * 1.5}


MESSAGES = [
    ('{"event_time":"2024-01-01 00:00:30","kw":1.5,"sub1":0.0,"sub2":1.0,"sub3":17.0}', None),
    ('{"event_time":"2024-01-01 00:00:31","kw":1.5}', None),
    ('{"event_time":"bad","kw":1.5}', "time"),
    ('{"event_time":"2024-01-01 00:00:32","kw":"x"}', "kw"),
    ("{bad", "json"),
    ('{"event_time":"2024-01-01 00:00:33","kw":NaN}', None),
]


def test_decode_and_rejects(spark):
    df = spark.createDataFrame([(m.encode(), i) for i, (m, _) in enumerate(MESSAGES)],
                               "value binary, i int")
    dec = topic.decode_readings(df, keep=("i",))
    got = {r["i"]: r for r in dec.collect()}
    assert [got[i]["reject"] for i in range(len(MESSAGES))] == [r for _, r in MESSAGES]
    assert got[0]["kwh"] == 2.25 and got[1]["sub1"] is None
    assert math.isnan(got[5]["kw"])
    good, bad = topic.split_rejects(dec)
    assert good.count() == 3 and bad.count() == 3
    assert set(bad.columns) == {"i", "message", "reject"}


def test_encode_round_trip(spark):
    rows = [(dt.datetime(2024, 1, 1, 0, 0, 30), 1.5, 0.1, 0.15000000000000002, 9.9)]
    df = spark.createDataFrame(rows, "event_time timestamp, kw double, sub1 double, sub2 double, "
                                     "sub3 double")
    enc = topic.encode_readings(df)
    assert enc.schema["value"].dataType.typeName() == "binary"
    back = topic.decode_readings(enc).collect()[0]
    assert (back["event_time"], back["kw"], back["sub2"]) == (rows[0][0], 1.5, rows[0][3])
    assert back["reject"] is None


def test_strict_rounding(spark):
    df = spark.createDataFrame([("1/1/2007;0:05:00;2.123456;0;0;0;1.239;0;0",)], "value string")
    r = files.strict_rows(df).collect()[0]
    assert r["kw"] == 2.1235 and r["sub1"] == 1.24


def _optimized_plan(df) -> str:
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("extended")
    text = buf.getvalue()
    return text[text.index("== Optimized Logical Plan =="):text.index("== Physical Plan ==")]


def test_each_line_parsed_once(spark):
    """The cleaning filters must not be pushed below the parsed fields (which
    would repeat the split and casts once per reference in the predicate)."""
    lines = spark.createDataFrame([(TXT_LINES[0],)], "value string")
    for rows, more in ((files.strict_rows(lines), 0), (files.loose_rows(lines), len(files.ISO_FORMATS))):
        plan = _optimized_plan(rows)
        assert plan.count("split(") == 1, plan
        assert plan.count("gettimestamp(") == 2 + more, plan  # one per dialect branch, one per further form


def test_numbers_are_those_of_the_text_formats(spark):
    from pyspark.sql import functions as F

    from meterflow.functions import to_number
    texts = ["1.5", " 2 ", "-.5e3", "1.", "1.5d", "1.5f", "1_0", "0x1", "", "nan", "NaN", "Infinity", "-inf", "1e400", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(to_number("t").alias("a"), to_number("t", finite=True).alias("b")).collect()
    want = ["1.5", "2.0", "-500.0", "1.0", *["None"] * 5, "nan", "nan", "inf", "-inf", "inf", "None"]
    assert [str(r.a) for r in rows] == want
    assert [str(r.b) for r in rows] == [x if x not in ("nan", "inf", "-inf") else "None" for x in want]


def test_daily_energy_counts_real_readings_only(spark):
    from meterflow.operators import daily
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("m", t, x) for x in (1.5, 1.5, float("nan"), float("inf"), 1e13, None)], "meter_id string, event_time timestamp, kw double")
    rows = daily.daily_energy(df, factor=1.0, min_readings=1).collect()
    assert [(r.n, r.y) for r in rows] == [(2, 3.0)]


def test_loose_rows_take_other_iso_forms(spark):
    rows = [("2007-01-01T00:05:00,1.5,0,0,0,0,0,0",), ("2007-01-01 00:06,1.5,0,0,0,0,0,0",), ("2007-01-02,1.5,0,0,0,0,0,0",), ("2007-13-02,1.5,0,0,0,0,0,0",)]
    got = files.loose_rows(spark.createDataFrame(rows, "value string")).collect()
    assert [r.event_time for r in got] == [dt.datetime(2007, 1, 1, 0, 5), dt.datetime(2007, 1, 1, 0, 6), dt.datetime(2007, 1, 2)]


def test_load_readings_tie_is_stable(spark, scratch):
    _write(os.path.join(scratch, "power.txt"), TXT_HEADER, TXT_LINES)
    a = files.load_readings(spark, scratch).collect()
    b = files.load_readings(spark, scratch, dialect="txt").repartition(3).collect()
    assert sorted(r.tie for r in a) == sorted(r.tie for r in b) and len({r.tie for r in a}) == len(a) == 4


def test_rounding_is_that_of_the_double(spark):
    import random
    from meterflow.functions.parse import round_half_even
    rng = random.Random(1)
    xs = [2.675, 0.125, 0.375, 1.005, 2.5, -2.675, -0.125, 1e15 + 0.3, 4.5e15, 1e300, 0.0, -0.5, 0.00005, 1.00005, 12345678.12345]
    xs += [round(rng.uniform(-50, 50), rng.choice([3, 4, 5, 6])) for _ in range(3000)] + [rng.randrange(-9999, 9999) / 8 for _ in range(300)]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    for digits in (2, 4):
        for r in df.select("x", round_half_even("x", digits).alias("y")).collect():
            assert r.y == round(r.x, digits), r
    odd = spark.createDataFrame([(float("nan"),), (float("inf"),), (None,)], "x double").select(round_half_even("x", 2)).collect()
    assert str(odd[0][0]) == "nan" and odd[1][0] == float("inf") and odd[2][0] is None


def test_dialect_by_the_first_line_of_each_file(spark, scratch):
    from meterflow.schemas import CSV_HEADER, TXT_HEADER
    from meterflow.sources import files
    texts = {"a.csv": [CSV_HEADER, "2007-01-01 00:00:00,1.5,0.1,240,a;b,1,2,3", "2007-01-01 00:01:00,2.5,0.1,240,6,1,2,3"],
             "b.txt": [TXT_HEADER, "1/1/2007;00:02:00;3.5;0,1;240;6;1;2;3"],
             "c.txt": ["nothing to split at", "1/1/2007;00:03:00;4.5;0.1;240;6;1;2;3"]}
    for name, lines in texts.items():
        with open(f"{scratch}/{name}", "w") as f:
            f.write("\n".join(lines) + "\n")
    kinds = {r.file.split("/")[-1]: r.dialect for r in files.file_dialects(spark, scratch).collect()}
    assert kinds == {"a.csv": "csv", "b.txt": "txt", "c.txt": "txt"}
    kw = lambda **a: sorted(r.kw for r in files.load_readings(spark, scratch, **a).collect())
    assert kw(dialect="header") == kw(dialect="header", cleaning="loose") == [1.5, 2.5, 3.5, 4.5]
    assert kw() == [2.5, 3.5, 4.5]  # line by line, the field with a semicolon makes a line TXT


def test_topic_reader_and_stream_writer(spark, scratch):
    from meterflow.sources import topic
    assert topic.topic_options("h:1", "t", compression="lz4") == {
        "kafka.bootstrap.servers": "h:1", "topic": "t", "kafka.acks": "1", "compression": "lz4"}
    src = topic.read_topic(spark, "h:1", "t", fmt="rate", rowsPerSecond="50")  # a source that ignores the topic's options
    assert src.isStreaming
    assert topic.source_options("h:1", "t", maxOffsetsPerTrigger="5")["maxOffsetsPerTrigger"] == "5"
    assert topic.source_options("h:1", "t") == {"kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "latest",
                                                "maxOffsetsPerTrigger": str(topic.MAX_OFFSETS)}
    msgs = src.selectExpr("cast(value as double) as kw", "timestamp as event_time", "0D as sub1", "0D as sub2", "0D as sub3")
    with pytest.raises(ValueError, match="checkpoint"):
        topic.write_topic(topic.encode_readings(msgs), "h:1", "t", fmt="noop")
    q = topic.write_topic(topic.encode_readings(msgs), "h:1", "t", fmt="noop", checkpoint=f"{scratch}/ckpt", trigger="200 milliseconds")
    try:
        import time
        for _ in range(100):
            if q.lastProgress and q.lastProgress.batchId >= 1:
                break
            time.sleep(0.2)
        assert q.isActive and q.lastProgress.batchId >= 1  # a processing-time trigger, batch after batch
    finally:
        q.stop()
    topic.write_topic(spark.createDataFrame([(b"x",)], "value binary"), "h:1", "t", fmt="noop")
