"""Raw minute-level meter files.

Two text dialects exist: ``;``-separated with day-first ``Date;Time`` (TXT)
and ``,``-separated with an ISO-like ``datetime`` (CSV). Files are read as
lines (``spark.read.text``) and the dialect is decided per line, or by the first
line of each file (``dialect="header"``, for fields that hold the other
separator); a folder mixing both works, and nothing is sniffed on the driver.

Two cleanings exist:

* ``strict`` (replay to the topic): drop blank lines, any line containing
  ``?``, lines with too few fields, and lines whose power or a present
  sub-meter field is not a number; an empty or missing sub-meter is 0.0. The
  date is not needed to keep a line (it is parsed, NULL if bad).
* ``loose`` (forecast input): ``?``, empty fields, NaN and the infinities are
  NA; keep a line when its date-time and its power both parse.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.functions import kwh as kwh_expr
from meterflow.functions import na, parse_day_first, parse_event_time, to_number
from meterflow.functions.parse import round_half_even
from meterflow.schemas import KWH_FACTOR_DEMO
from meterflow.session import checkpoint_path

# Field positions per dialect (fixed by the file formats).
TXT_POS = {"date": 0, "time": 1, "kw": 2, "sub1": 6, "sub2": 7, "sub3": 8, "min_parts": 3}
CSV_POS = {"datetime": 0, "kw": 1, "sub1": 5, "sub2": 6, "sub3": 7, "min_parts": 2}


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw lines of one file, a folder or a glob (column ``value``)."""
    return spark.read.text(path)


def file_dialects(spark: SparkSession, path: str) -> DataFrame:
    """(file, dialect): csv where a file's first line has ``,`` and no ``;``, else txt.

    The first line is the first row of the block that starts at 0. Its scan
    passes over the text once, without splitting or parsing it.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), "value")
    first = (lines.withColumn("id", F.monotonically_increasing_id()).filter("at = 0").groupBy("file")
             .agg(F.min_by(F.struct(F.contains("value", F.lit(",")).alias("comma"), F.contains("value", F.lit(";")).alias("semicolon")), "id").alias("f")))
    return first.select("file", F.when(F.col("f.comma") & ~F.col("f.semicolon"), "csv").otherwise("txt").alias("dialect"))


def dialect(line: Column) -> Column:
    """A1: 'txt' when the line has ``;``, else 'csv' when it has ``,``."""
    return (F.when(F.instr(line, ";") > 0, F.lit("txt"))
            .when(F.instr(line, ",") > 0, F.lit("csv")).otherwise(F.lit(None)))


def _field(parts: Column, pos: int) -> Column:
    # 0-based position; NULL when the line is shorter.
    return F.try_element_at(parts, F.lit(pos + 1))


def _once(df: DataFrame, keep, *cols: Column) -> DataFrame:
    """Project ``cols`` through a one-element generator. A filter over a plain
    projection is pushed below it with each referenced expression substituted
    (split, casts, date parsing run again per reference); above a generator it
    stays put, so every expression runs once per line."""
    return df.select(*keep, F.inline(F.array(F.struct(*cols))))


def split_fields(lines: DataFrame, value: str = "value", dialect_hint: str = "auto",
                 keep=()) -> DataFrame:
    """A2/A3: split each line by its dialect and name the used fields (text).

    The split is computed once per line (its own projection), then fields are
    picked by position, which keeps the generated code small.
    """
    line = F.trim(F.col(value))
    d = dialect(line) if dialect_hint == "auto" else F.col("dialect") if dialect_hint == "column" else F.lit(dialect_hint)
    base = lines.select(*keep, line.alias("line"), d.alias("dialect"))
    parts = base.select(*keep, "line", "dialect", F.split(
        "line", F.when(F.col("dialect") == "txt", F.lit(";")).otherwise(F.lit(","))).alias("_p"))
    txt = F.col("dialect") == "txt"

    def pick(tkey, ckey):
        t = _field(F.col("_p"), TXT_POS[tkey]) if tkey else F.lit(None).cast("string")
        c = _field(F.col("_p"), CSV_POS[ckey]) if ckey else F.lit(None).cast("string")
        return F.when(txt, t).otherwise(c)

    return _once(
        parts, keep, F.col("line"), F.col("dialect"), F.size("_p").alias("n_parts"),
        pick("date", None).alias("date_text"), pick("time", None).alias("time_text"),
        pick(None, "datetime").alias("datetime_text"), pick("kw", "kw").alias("kw_text"),
        pick("sub1", "sub1").alias("sub1_text"), pick("sub2", "sub2").alias("sub2_text"),
        pick("sub3", "sub3").alias("sub3_text"))


def _is_header() -> Column:
    first = F.when(F.col("dialect") == "txt", F.col("date_text")).otherwise(F.col("datetime_text"))
    return F.trim(first).isin("Date", "datetime")


#: Forms of a CSV date-time that the forecast input may have besides the usual one.
ISO_FORMATS = ("yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm", "yyyy-MM-dd'T'HH:mm", "yyyy-MM-dd")


def _event_time(more=()) -> Column:
    text = F.trim(F.col("datetime_text"))
    iso = F.coalesce(parse_event_time(text), *(parse_event_time(text, f) for f in more))
    return F.when(F.col("dialect") == "txt",
                  parse_day_first(F.col("date_text"), F.col("time_text"))).otherwise(iso)


SUBS = ("sub1", "sub2", "sub3")


def strict_rows(lines: DataFrame, value: str = "value", kw_digits: int = 4,
                sub_digits: int = 2, keep=(), dialect_hint: str = "auto") -> DataFrame:
    """B1 + B3: the replay cleaning. Output: [keep], event_time, kw, sub1..sub3."""
    f = split_fields(lines, value, dialect_hint, keep)
    min_parts = F.when(F.col("dialect") == "txt", F.lit(TXT_POS["min_parts"])).otherwise(
        F.lit(CSV_POS["min_parts"]))
    pre = (F.col("dialect").isNotNull() & (F.length("line") > 0) & ~F.col("line").contains("?")
           & (F.col("n_parts") >= min_parts) & ~_is_header())
    nums = _once(
        f.filter(pre), keep, _event_time().alias("event_time"), to_number("kw_text").alias("kw"),
        *[F.when(F.col(f"{c}_text").isNull() | (F.col(f"{c}_text") == ""), F.lit(0.0))
          .otherwise(to_number(f"{c}_text")).alias(c) for c in SUBS])
    ok = F.col("kw").isNotNull()
    for c in SUBS:
        ok = ok & F.col(c).isNotNull()
    return nums.filter(ok).select(
        *keep, "event_time", round_half_even("kw", kw_digits).alias("kw"),
        *[round_half_even(c, sub_digits).alias(c) for c in SUBS])


def loose_rows(lines: DataFrame, value: str = "value", keep=(), dialect_hint: str = "auto") -> DataFrame:
    """B2 (+A4, B6, B7): the forecast cleaning. Output: [keep], event_time, kw,
    sub1..sub3 (sub-meters NULL when NA or not numeric)."""
    f = split_fields(lines, value, dialect_hint, keep)
    f = f.filter(F.col("dialect").isNotNull() & ~_is_header())
    out = _once(f, keep, _event_time(ISO_FORMATS).alias("event_time"), to_number(na("kw_text"), finite=True).alias("kw"),
                *[to_number(na(f"{c}_text"), finite=True).alias(c) for c in SUBS])
    return out.filter(F.col("event_time").isNotNull() & F.col("kw").isNotNull())


def as_readings(rows: DataFrame, meter_id: str = "house", factor: float = KWH_FACTOR_DEMO,
                tie: Column | None = None) -> DataFrame:
    """Cleaned rows to parsed readings (M4). ``tie`` defaults to a hash of the
    row, which does not depend on how the input is laid out."""
    hashed = F.xxhash64(*(F.col(c) for c in rows.columns))
    return rows.select(F.lit(meter_id).alias("meter_id"), "event_time",
                       (tie if tie is not None else hashed).alias("tie"),
                       "kw", kwh_expr("kw", factor).alias("kwh"), "sub1", "sub2", "sub3")


def load_readings(spark: SparkSession, path: str, cleaning: str = "strict",
                  meter_id: str = "house", factor: float = KWH_FACTOR_DEMO,
                  dialect: str = "auto") -> DataFrame:
    """A10: a meter file (or folder of them) as readings.

    ``dialect``: txt, csv, header (each file by its first line), or auto (each
    line by its separator). ``tie`` hashes file name and line.
    """
    lines = read_lines(spark, path).select("value", F.xxhash64("_metadata.file_name", "value").alias("tie"), F.col("_metadata.file_path").alias("file"))
    if dialect == "header":
        # a saved table, so that its size decides whether it is broadcast
        kinds = checkpoint_path(spark, "meterflow", f"dialects-{uuid.uuid4().hex}")
        file_dialects(spark, path).write.parquet(kinds)
        lines, dialect = lines.join(spark.read.parquet(kinds), "file"), "column"
    clean = strict_rows if cleaning == "strict" else loose_rows
    rows = clean(lines, keep=("tie",), dialect_hint=dialect)
    return as_readings(rows, meter_id, factor, F.col("tie"))
