"""Stored point tables with commits.

A table is a set of folders ``<root>/<table>/part=P/day=D``, D being the day of
the rows or, in a store for long ranges, the first day of their month. Folders
are written first and become visible together when one commit names them: a
commit is a single small file under ``<root>/commits``, written by one job, so
a crash between two writes shows nothing of either. Readers open exactly the
folders that are live in the log, and of these only the days they ask for.

A commit may also remove folders, which is how merges (copy on write, by day)
and compactions replace old ones. The files of removed folders stay until
``vacuum_paths`` are deleted by whoever owns the storage, so readers that have
already planned a query are not disturbed. Writers of one store take turns:
one stream, and merges or compactions of other days or of committed folders.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.operators.dashboard import time_range, upsert_points

LOG = "commit string, version long, table string, part string, day date, kind string, rows long, mark timestamp"


class PointStore:
    def __init__(self, spark: SparkSession, root: str, unit: str = "day"):
        self.spark, self.root, self.unit = spark, root.rstrip("/"), unit
        spark.createDataFrame([], LOG).drop("commit").coalesce(1).write.mode("ignore").json(f"{self.root}/commits/commit=none")

    def _day(self, time) -> Column:
        day = F.to_date(time) if self.unit == "day" else F.trunc(F.to_date(time), self.unit)
        return F.coalesce(day, F.lit("1970-01-01").cast("date"))

    def log(self) -> DataFrame:
        """All entries of all commits."""
        return self.spark.read.schema(LOG).json(f"{self.root}/commits").filter("version is not null")

    def has(self, commit: str) -> bool:
        return not self.log().filter(F.col("commit") == commit).isEmpty()

    def version(self) -> int:
        return self.log().agg(F.max("version")).first()[0] or 0

    def mark(self):
        """The latest time mark that a commit carries (a watermark), or None."""
        return self.log().agg(F.max("mark")).first()[0]

    def live(self, table: str, from_ts=None, to_ts=None) -> list:
        """(part, day, rows) of the folders that count; compaction bounds their number."""
        log = self.log().filter(F.col("table") == table)
        for bound, keep in ((from_ts, lambda x: F.col("day") >= x), (to_ts, lambda x: F.col("day") <= x)):
            if bound is not None:
                log = log.filter(keep(self._day(F.lit(bound).cast("timestamp"))))
        last = log.groupBy("part", "day").agg(F.max_by(F.struct("kind", "rows"), "version").alias("l"))
        return last.filter("l.kind = 'add'").select("part", "day", "l.rows").orderBy("day", "part").collect()

    def folder(self, table: str, part: str, day) -> str:
        return f"{self.root}/{table}/part={part}/day={day}"

    def read(self, table: str, from_ts=None, to_ts=None, schema=None) -> DataFrame | None:
        """The committed rows (with ``part`` and ``day``) whose time lies in the range, both ends included.

        None if the store has no folder of these days and no ``schema`` is given.
        """
        paths = [self.folder(table, r.part, r.day) for r in self.live(table, from_ts, to_ts)]
        if not paths:
            return None if schema is None else self.spark.createDataFrame([], schema)
        reader = self.spark.read.option("basePath", f"{self.root}/{table}")
        df = (reader.schema(schema) if schema is not None else reader).parquet(*paths)
        if "time" not in df.columns:
            return df
        return time_range(df, from_ts, to_ts) if self.unit == "day" else time_range(df.drop("day"), from_ts, to_ts)

    def stage(self, df: DataFrame, table: str, part: str, time: str = "time", rows_per_file: int | None = None) -> list[dict]:
        """Write ``df`` by day under ``part`` (a repeated write replaces it); the entries to commit.

        With ``rows_per_file`` the files of a day are even and at most that long.
        """
        df = df.withColumn("day", self._day(F.col(time) if time in df.columns else F.lit(None).cast("date")))
        per_day = lambda rows: {r.day: r.n for r in rows.groupBy("day").agg(F.count("*").alias("n")).collect()}
        path, out = f"{self.root}/{table}/part={part}", df
        if rows_per_file is not None:
            need = {d: max(1, math.ceil(n / rows_per_file)) for d, n in per_day(df).items()}
            files = self.spark.createDataFrame(list(need.items()), "_day date, _files int")  # one row a day
            salted = df.join(F.broadcast(files), F.col("day") == F.col("_day")).withColumn(
                "_salt", F.pmod(F.xxhash64(*(c for c in df.columns if c != "day")), "_files"))
            out = salted.repartition(max(1, sum(need.values())), "day", "_salt").drop("_day", "_files", "_salt")
        out.write.mode("overwrite").partitionBy("day").parquet(path)
        # counted in what was written, so that df is computed once
        count = per_day(self.spark.read.schema(out.schema).parquet(path))
        return [{"table": table, "part": part, "day": d, "kind": "add", "rows": n} for d, n in sorted(count.items())]

    def staged(self, table: str, part: str, schema) -> DataFrame:
        """The rows that ``stage`` has written under ``part``, committed or not, for whoever wrote them."""
        return self.spark.read.schema(schema).parquet(f"{self.root}/{table}/part={part}")

    def commit(self, name: str, entries: list[dict], mark=None) -> None:
        """Make the entries count, all at once. A commit without folders records that it happened."""
        version = self.version() + 1
        rows = [(version, e["table"], e["part"], e["day"], e["kind"], e["rows"], mark) for e in entries] or [(version, "", "", None, "none", 0, mark)]
        kinds = ", ".join(c for c in LOG.split(", ") if not c.startswith("commit"))
        self.spark.createDataFrame(rows, kinds).coalesce(1).write.mode("overwrite").json(f"{self.root}/commits/commit={name}")

    def removals(self, table: str, live: list) -> list[dict]:
        return [{"table": table, "part": r.part, "day": r.day, "kind": "remove", "rows": r.rows} for r in live]

    def merge(self, table: str, updates: DataFrame, keys, order, time: str = "time") -> None:
        """A9 on the store: ``updates`` replace points of the same ``keys`` by ``order``; last write wins.

        Only the days that ``updates`` touch are read and written again; other
        days keep their folders. ``updates`` have the table's columns.
        """
        updates = updates.withColumn("day", self._day(F.col(time)))
        days = {r.day for r in updates.select("day").distinct().collect()}
        touched = [r for r in self.live(table) if r.day in days]
        name = f"merge-{uuid.uuid4().hex}"
        rows = updates
        if touched:
            old = self.spark.read.option("basePath", f"{self.root}/{table}").parquet(*(self.folder(table, r.part, r.day) for r in touched))
            rows = old.drop("part").unionByName(updates)
        self.commit(name, self.stage(upsert_points(rows, keys, order).drop("day"), table, name, time) + self.removals(table, touched))

    def compact(self, table: str, rows_per_file: int = 1_000_000, least: int = 2, time: str = "time") -> int:
        """Pack the folders of every day that has ``least`` or more into even files; returns how many folders went.

        Reads committed folders only and swaps them in one commit, so a stream
        may go on writing: its new folders are not touched.
        """
        live = self.live(table)
        days = {}
        for r in live:
            days.setdefault(r.day, []).append(r)
        old = [r for rs in days.values() if len(rs) >= least for r in rs]
        if not old:
            return 0
        name = f"compact-{uuid.uuid4().hex}"
        rows = self.spark.read.option("basePath", f"{self.root}/{table}").parquet(*(self.folder(table, r.part, r.day) for r in old))
        self.commit(name, self.stage(rows.drop("part", "day"), table, name, time, rows_per_file) + self.removals(table, old))
        return len(old)

    def vacuum_paths(self, table: str) -> list[str]:
        """Folders that no longer count, for whoever deletes them."""
        last = (self.log().filter(F.col("table") == table).groupBy("part", "day").agg(F.max_by("kind", "version").alias("kind"))
                .filter("kind = 'remove'").collect())
        return [self.folder(table, r.part, r.day) for r in last]
