"""Ordered scans (running sums, previous row) that stay balanced when one key
holds most of the rows.

A plain ``Window.partitionBy(key).orderBy(t)`` puts every row of a key into
one task, and one meter (or one billing cycle of a single-meter deployment)
can hold a third of all rows. Here the ordering of every key is cut at fixed
points and the scan runs in three levels:

1. rows within a cell; the only sort over rows, by the whole order. A cell is
   an hour of a key. Where that holds more than ``CROWD`` rows, it is one
   millisecond, and within its whole value (or among rows without a time) one
   range of ``TIES`` values of the second order column;
2. cells within (key, hour): pre-aggregated rows, one unless the hour is crowded;
3. hours within a key: some 8,800 pre-aggregated rows a year.

What a level hands on (a sum, or the last row) is added to the level below by
a join on the cell, which finds the rows partitioned as the window left them.
Crowded hours are found by a count of the same rows and broadcast, at most one
for every ``CROWD`` rows; so no job runs while the plan is built, and a
recomputed task agrees with the first one. A burst spreads over its
milliseconds; rows of one second, of one date or without a time spread over
their ties: with distinct integer ties no window over rows has more than
``CROWD`` or ``TIES``. (Rows of one instant between two milliseconds, or with
ties that are no integers, stay in one cell.) Rows without a time are first in
the order, as in the plain window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY, HOUR, AT, PART = "_key", "_hour", "_at", "_part"
CELL = (HOUR, AT, PART)
NO_TIME = -(1 << 62)  # before all times
TIES = 1 << 16  # values of the second order column in a cell
CROWD = 1 << 16  # rows of an hour of a key that are one cell


def _cells(df: DataFrame, order) -> DataFrame:
    """``df`` with its cell (see above); the order by (AT, PART) agrees with ``order``."""
    time = F.col(order[0])
    kind = df.schema[order[0]].dataType.typeName()
    if kind in ("timestamp", "timestamp_ntz", "date"):
        time = time.cast("timestamp")
        at, hour, whole = F.unix_millis(time), 3_600_000, F.pmod(F.unix_micros(time), F.lit(1000)) == 0
    else:
        at, hour, whole = F.floor(time).cast("long"), 3600, F.floor(time) == time
    part = F.lit(0).cast("long")
    if len(order) > 1 and df.schema[order[1]].dataType.typeName() in ("byte", "short", "integer", "long"):
        tie = F.col(order[1]).cast("long")
        tie = F.coalesce(tie - F.pmod(tie, F.lit(TIES).cast("long")), F.lit(-(1 << 63)))
        part = F.when(F.coalesce(whole, F.lit(True)), tie).otherwise(F.lit((1 << 63) - 1))  # after the whole value
    df = df.withColumns({AT: F.coalesce(at, F.lit(NO_TIME)), PART: part})
    return df.withColumn(HOUR, F.floor(F.col(AT) / hour).cast("long"))


def _keyed(df: DataFrame, keys, order, uses) -> DataFrame:
    """``df`` with its cells (see ``_cells``) and the keys as one column KEY, which is never
    null: joins on it are plain equalities, so they keep the partitions of the windows.
    Sorts start with HOUR, as they compare the first column fastest if it is a number."""
    cells = _cells(df, order)
    rest = [c for c in cells.columns if c not in keys or c in uses]
    return cells.select(F.struct(*keys).alias(KEY), *rest)


def _same(left: DataFrame, right: DataFrame, keys) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & (left[k] == right[f"_r_{k}"])
    return cond


def _renamed(df: DataFrame, keys) -> DataFrame:
    return df.select(*(F.col(k).alias(f"_r_{k}") for k in keys), *(c for c in df.columns if c not in keys))


def _unkeyed(cols, keys) -> list[Column]:
    return [F.col(KEY)[c].alias(c) if c in keys else F.col(c) for c in cols]


def _merged(cells: DataFrame, hours: DataFrame) -> DataFrame:
    """``cells`` with one cell for each hour that is not among ``hours`` (the crowded ones)."""
    by = [KEY, HOUR]
    cut = F.broadcast(_renamed(hours.select(*by, F.lit(True).alias("_cut")), by))
    joined = cells.join(cut, _same(cells, cut, by), "left")
    whole = lambda c: F.when(F.col("_cut"), F.col(c)).otherwise(F.lit(0).cast("long"))
    return joined.select(*(whole(c).alias(c) if c in (AT, PART) else c for c in cells.columns))


def running_totals(df: DataFrame, keys, order, values: dict[str, str]) -> DataFrame:
    """For each ``out: value`` of ``values``, ``out`` = running sum of ``value`` per key
    in ``order`` (rows up to the current one).

    Nulls don't count; a sum of nulls alone is null. Exact for DECIMAL and
    integer values; DOUBLE sums are associated by cell, always in the same way.
    """
    keys, order, outs = list(keys), list(order), list(values)
    cols = [c for c in df.columns if c not in outs]
    rows, cell = _keyed(df, keys, order, {*order, *values.values()}), [HOUR, KEY, AT, PART]
    cells = _merged(rows, rows.groupBy(KEY, HOUR).count().filter(F.col("count") > CROWD))
    before = lambda by, *at: Window.partitionBy(*by).orderBy(*at).rowsBetween(Window.unboundedPreceding, -1)
    parts = cells.groupBy(*cell).agg(*(F.sum(values[o]).alias(f"_s_{o}") for o in outs))
    hours = parts.groupBy(KEY, HOUR).agg(*(F.sum(f"_s_{o}").alias(f"_h_{o}") for o in outs))
    hours = hours.withColumns({f"_h_{o}": F.sum(f"_h_{o}").over(before([KEY], HOUR)) for o in outs})
    parts = parts.withColumns({f"_s_{o}": F.sum(f"_s_{o}").over(before([KEY, HOUR], AT, PART)) for o in outs})
    upto = _renamed(hours, [KEY, HOUR])
    offsets = parts.join(upto, _same(parts, upto, [KEY, HOUR])).select(*cell, *(f"_s_{o}" for o in outs), *(f"_h_{o}" for o in outs))
    here = Window.partitionBy(*cell).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = cells.withColumns({f"_l_{o}": F.sum(values[o]).over(here) for o in outs})
    offsets = _renamed(offsets, cell)
    joined = local.join(offsets, _same(local, offsets, cell))

    def total(o):
        parts = [F.col(f"_{x}_{o}") for x in "hsl"]
        kind = local.schema[f"_l_{o}"].dataType
        zero = F.lit(0).cast(kind)
        added = sum((F.coalesce(p.cast(kind), zero) for p in parts[1:]), F.coalesce(parts[0].cast(kind), zero))
        return F.when(F.coalesce(*parts).isNotNull(), added.cast(kind)).alias(o)

    return joined.select(*_unkeyed(cols, keys), *map(total, outs))


def running_total(df: DataFrame, keys, order, value: str, out: str) -> DataFrame:
    """One running sum (see ``running_totals``)."""
    return running_totals(df, keys, order, {out: value})


def previous_row(df: DataFrame, keys, order, cols, prefix: str = "prev_") -> DataFrame:
    """Adds ``prefix+c`` = value of ``c`` on the previous row of the same key in ``order``.

    Where ``keys``, ``order`` and ``cols`` are all its columns, the exchanges that
    computing ``df`` needs are made once: both passes over it (the hours, then its
    rows, moved to their cells once for the two levels that read them) use every column.
    """
    keys, order, cols = list(keys), list(order), list(cols)
    base, cell = df.columns, [HOUR, KEY, AT, PART]
    rows = _keyed(df, keys, order, {*order, *cols})
    last = lambda c, by: F.max_by(c, by)
    ends = last(F.struct(*cols), F.struct(*order)).alias("_last")
    # both conditions hold always: with them both uses of the hours need all columns, and share one exchange
    hours = rows.groupBy(KEY, HOUR).agg(F.count(F.lit(1)).alias("_n"), ends).filter((F.col("_n") > 0) & F.col("_last").isNotNull())
    cells = _merged(rows, hours.filter(F.col("_n") > CROWD))
    if set(base) == {*keys, *order, *cols}:
        cells = cells.repartition(*cell)
    parts = cells.groupBy(*cell).agg(ends)
    hours = hours.select(KEY, HOUR, F.lag("_last").over(Window.partitionBy(KEY).orderBy(HOUR)).alias("_before"))
    parts = parts.withColumn("_last", F.lag("_last").over(Window.partitionBy(KEY, HOUR).orderBy(AT, PART)))
    upto = _renamed(hours, [KEY, HOUR])
    carry = parts.join(upto, _same(parts, upto, [KEY, HOUR])).select(*cell, F.coalesce("_last", "_before").alias("_carry"))
    here = Window.partitionBy(*cell).orderBy(*order)
    local = cells.withColumn("_prev", F.lag(F.struct(*cols)).over(here))
    carry = _renamed(carry, cell)
    prev = F.coalesce("_prev", "_carry")
    return local.join(carry, _same(local, carry, cell)).select(*_unkeyed(base, keys), *(prev[c].alias(prefix + c) for c in cols))
