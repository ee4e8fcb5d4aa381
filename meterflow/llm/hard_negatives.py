"""Hard-negative mining by the threshold algorithm (operator 13).

Vectors are quantised to integers. An anchor's score of a row is their inner
product, a sum of one term a dimension, so Fagin's threshold algorithm finds
the best rows without scoring all:

* rows are packed into blocks; a block keeps, for each dimension, its rows
  sorted by that component (the candidate lists);
* an anchor reads every list from its good end, downwards where its own
  component is positive and upwards where it is negative (sorted access);
* rows met for the first time are scored in integers (random access);
* the components where the lists stand give a threshold that no unread row
  exceeds. Reading stops once it is strictly below the worst score kept in
  every window that is still open, so ties by id are never lost.

Spark deals the work: anchors in tiles, blocks in slots. Each (tile, slot) is
a stream of one task that gets the tile once and then block after block, with
the windows found so far carried along, so later blocks are often left out by
their first threshold. Anchors are the stated query set; only the few rows of
each window leave a task.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterflow.llm.scratch import saved

BLOCK = 2048  # rows a block
BUFFER = 16  # blocks a task holds while it packs
TILE = 16384  # anchors a tile
SLOT = 16  # blocks a slot, where there are enough for all cores
DEPTHS = (16, 64, 256, 1024)
PACKED = "kind int, part long, dim int, ids binary, labels binary, vectors binary, wins binary"
EXACT = 2.0**53


def quantised(df: DataFrame, scale: int) -> DataFrame:
    """(id, label, v): the rows that take part, each once, with integer components."""
    big = float(1 << 62)
    x = F.transform(F.col("embedding"), lambda c: F.floor(F.lit(float(scale)) * c.cast("double")))
    whole = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    norm = F.aggregate(F.col("embedding"), F.lit(0.0), lambda s, c: s + F.pow(F.lit(float(scale)) * F.abs(c.cast("double")) + 1, F.lit(2.0)))
    rows = df.select(F.col("vec_id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), "embedding")
    return rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()).filter(
        whole & (norm < big)).select("id", "label", x.cast("array<long>").alias("v")).distinct()


def matrix(rows: list) -> np.ndarray:
    """Rows of integers side by side; shorter ones are filled with zeros."""
    out = np.zeros((len(rows), max(map(len, rows), default=0)), np.int64)
    for i, r in enumerate(rows):
        out[i, :len(r)] = r
    return out


def packed(rows: DataFrame, kind: int, size: int, wins: bool = False) -> DataFrame:
    """``rows(id, label, v[, wins])`` in blocks of at most ``size``, each of like labels."""
    def run(batches):
        from pyspark import TaskContext
        base, count, held = TaskContext.get().partitionId() << 32, 0, []

        def flush():
            nonlocal count, held
            held.sort(key=lambda r: (r[1], r[0]))
            for at in range(0, len(held), size):
                part = held[at:at + size]
                x = matrix([r[2] for r in part])
                bounds = np.array([[*b[0], *b[1]] for b in (r[3] for r in part)], np.int64) if wins else np.zeros(0, np.int64)
                yield [kind, base + count, x.shape[1], np.array([r[0] for r in part], np.int64).tobytes(),
                       np.array([r[1] for r in part], np.int64).tobytes(), x.tobytes(), bounds.tobytes()]
                count += 1
            held = []

        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("id", "label", "v", *(["wins"] if wins else []))]
            for at in range(0, batch.num_rows, size):
                held += list(zip(*(c[at:at + size] for c in cols), strict=True))
                if len(held) >= size * BUFFER:
                    yield from map(record, flush())
        yield from map(record, flush())

    return rows.mapInArrow(run, PACKED)


def record(row: list) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
    names = [c.split()[0] for c in PACKED.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds, strict=True)], names=names)


class Best:
    """The first ``k`` rows by (score down, id up) with scores from ``low`` to ``high``."""

    def __init__(self, k: int, low: int, high: int):
        self.k, self.low, self.high, self.rows = k, low, high, []

    def floor(self) -> int:
        """A row must score at least this to get in."""
        return max(self.low, -self.rows[-1][0]) if len(self.rows) == self.k else self.low

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        fit = np.flatnonzero((scores >= self.floor()) & (scores <= self.high))
        if len(fit) > 4 * self.k:
            cut = -np.partition(-scores[fit], self.k * 2)[self.k * 2]
            if len(np.unique(ids[fit[scores[fit] > cut]])) >= self.k:
                fit = fit[scores[fit] > cut]
        if len(fit):
            self.rows = sorted({*self.rows, *zip((-scores[fit]).tolist(), ids[fit].tolist(), strict=True)})[:self.k]


class Block:
    """Rows with a sorted list for each dimension."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, dim: int):
        self.ids, self.labels = ids, labels
        self.x = np.zeros((len(x), dim), np.int64)
        self.x[:, :x.shape[1]] = x
        self.order = np.argsort(self.x, axis=0, kind="stable")
        self.depths = [0, *(d for d in DEPTHS if d < len(ids)), len(ids)]
        value = np.take_along_axis(self.x, self.order, 0)
        at = np.array(self.depths[:-1])
        self.low, self.high = value[at].astype(float), value[len(ids) - 1 - at].astype(float)
        self.small = float(np.abs(self.x).max(initial=0))

    def thresholds(self, anchors: np.ndarray) -> np.ndarray:
        """What no row below each depth exceeds, a row for each anchor."""
        up, down = np.maximum(anchors, 0).astype(float), np.minimum(anchors, 0).astype(float)
        most = np.abs(anchors).sum(1, dtype=float)[:, None] * self.small
        return up @ self.high.T + down @ self.low.T + np.where(most < EXACT, 0.0, most * 1e-12)

    def search(self, a: np.ndarray, bounds: np.ndarray, allowed: np.ndarray, windows: list[Best]) -> int:
        """Fill ``windows`` with the allowed rows; returns how many rows were scored."""
        n, read = len(self.ids), 0
        plus, minus = np.flatnonzero(a > 0), np.flatnonzero(a < 0)
        unseen = allowed.copy()
        exact = float(np.abs(a).sum()) * self.small < EXACT
        for bound, start, stop in zip(bounds, self.depths, self.depths[1:], strict=False):
            if all(bound < w.floor() for w in windows):
                return read
            met = np.zeros(n, bool)
            if stop == n:
                met[:] = True
            else:
                met[self.order[n - stop:n - start, plus]] = True
                met[self.order[start:stop, minus]] = True
            new = np.flatnonzero(met & unseen)
            unseen[new] = False
            read += len(new)
            if len(new):
                rows = self.x[new]
                scores = (rows.astype(float) @ a.astype(float)).astype(np.int64) if exact else rows @ a
                for w in windows:
                    w.add(scores, self.ids[new])
        return read


def searched(tiles: DataFrame, blocks: DataFrame, n_tiles: int, n_blocks: int, k: int, low: int) -> DataFrame:
    """(anchor, win, id, score): the first ``k`` rows of every window within each (tile, slot).

    Anchors without windows look for rows of their own label (win -1), those
    with windows for rows of other labels, from ``low`` percent of each
    window's score up to it (win is its number).
    """
    spark = blocks.sparkSession
    slots = max(1, min(n_blocks, max(math.ceil(n_blocks / SLOT), spark.sparkContext.defaultParallelism)))
    number = lambda n: F.sequence(F.lit(0), F.lit(n - 1))
    stream = (tiles.withColumn("tile", F.pmod(F.xxhash64("part"), F.lit(n_tiles)).cast("int")).withColumn("slot", F.explode(number(slots)))
              .unionByName(blocks.withColumn("slot", F.pmod(F.xxhash64("part"), F.lit(slots)).cast("int"))
                           .withColumn("tile", F.explode(number(n_tiles)))))

    def run(batches):
        group, tile = None, []
        for batch in batches:
            for r in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                if group != (r["tile"], r["slot"]):
                    yield from found(tile)
                    group, tile = (r["tile"], r["slot"]), []
                ids, labels = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["labels"], np.int64)
                x = np.frombuffer(r["vectors"], np.int64).reshape(len(ids), r["dim"])
                if r["kind"] == 0:
                    tile.append(anchors(ids, labels, x, np.frombuffer(r["wins"], np.int64).reshape(len(ids), -1)))
                else:
                    for part in tile:
                        visit(part, ids, labels, x)
        yield from found(tile)

    def anchors(ids, labels, x, wins):
        windows = []
        for w in wins.tolist():
            w = w[1:1 + w[0]] if w else None
            windows.append([Best(k, -(1 << 63), (1 << 63) - 1)] if w is None else [Best(k, -(-low * p // 100), p) for p in w])
        return ids, labels, x, windows, wins.shape[1] > 0

    def visit(part, ids, labels, x):
        own, own_labels, a, windows, negatives = part
        dim = max(a.shape[1], x.shape[1])
        block = Block(ids, labels, x, dim)
        a = np.pad(a, ((0, 0), (0, dim - a.shape[1])))
        bounds = block.thresholds(a)
        for i in range(len(own)):
            if windows[i] and any(bounds[i, 0] >= w.floor() for w in windows[i]):
                allowed = labels != own_labels[i] if negatives else (labels == own_labels[i]) & (ids != own[i])
                if allowed.any():
                    block.search(a[i], bounds[i], allowed, windows[i])

    def found(tile):
        rows = [(own[i], n if negatives else -1, i_, -s) for own, _, _, windows, negatives in tile
                for i in range(len(own)) for n, w in enumerate(windows[i]) for s, i_ in w.rows]
        if rows:
            cols = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64()), strict=True)],
                                             names=["anchor", "win", "id", "score"])

    parts = min(20_000, 2 * slots * n_tiles)
    dealt = stream.repartition(parts, "tile", "slot").sortWithinPartitions("tile", "slot", "kind", "part")
    local = dealt.mapInArrow(run, "anchor long, win int, id long, score long").distinct()
    first = Window.partitionBy("anchor", "win").orderBy(F.desc("score"), "id")
    return local.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, scale: int = 256) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    From ``vectors(vec_id, embedding, label)``: each component x becomes
    floor(``scale`` * x). Anchors are the rows for which ``is_anchor``, a
    condition on ``vec_id``, holds. A positive is one of an anchor's first
    ``positives`` other rows (other vec_id) of its label, a negative one of
    the first ``negatives`` rows of other labels that score from ``low``
    percent of the positive's score up to it; first by score down, then vec_id
    up. Pairs without negatives give no row, nor do positives with a negative
    score (their window is empty).

    Null vec_ids, labels or vectors, null or non-finite components, and
    vectors so long that scores might not fit in a long (norm of 2**31 after
    scaling) take no part. Equal rows count once; of anchor rows that differ
    but share a vec_id, the least by (label, vector) is the anchor. Vectors of
    unlike lengths are compared as if filled with zeros, empty ones too.
    Other columns are ignored. Empty tables give no rows.
    """
    names = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    rows = saved(quantised(vectors, scale), "negatives-rows")
    blocks = saved(packed(rows, 1, BLOCK), "negatives-blocks")
    chosen = (rows.withColumnRenamed("id", "vec_id").filter(is_anchor).groupBy(F.col("vec_id").alias("id"))
              .agg(F.min(F.struct("label", "v")).alias("r")).select("id", "r.label", "r.v"))
    chosen = saved(chosen, "negatives-anchors")
    n_anchors, n_blocks = chosen.count(), blocks.count()  # two numbers
    if not n_anchors:
        return vectors.sparkSession.createDataFrame([], names)
    n_tiles = math.ceil(n_anchors / TILE)
    near = searched(saved(packed(chosen, 0, 1024), "negatives-tiles"), blocks, n_tiles, n_blocks, positives, low)
    near = saved(near.select("anchor", "id", "score", "rank"), "negatives-positives")
    # windows of an anchor: how many, then their scores in order; filled up to a fixed length
    wins = near.filter("score >= 0").groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("rank", "score")))["score"].alias("s"))
    tile = chosen.join(wins, chosen["id"] == wins["anchor"]).select(
        "id", "label", "v", F.array(F.array(F.size("s").cast("long")),
                                    F.slice(F.concat("s", F.array_repeat(F.lit(0).cast("long"), positives)), 1, positives)).alias("wins"))
    far = searched(saved(packed(tile, 0, 1024, True), "negatives-windows"), blocks, n_tiles, n_blocks, negatives, low)
    pairs = near.select("anchor", (F.col("rank") - 1).alias("win"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return far.join(pairs, ["anchor", "win"]).select(
        F.col("anchor").alias("anchor_id"), "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))


ORACLE_SQL = """
WITH r AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
                 CAST(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i])) AS BIGINT) AS score
          FROM r a JOIN r b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
pos AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS k FROM pairs WHERE same) WHERE k <= 5),
neg AS (SELECT p.anchor_id, p.vec_id AS positive_id, p.score AS positive_score, n.vec_id AS negative_id, n.score AS negative_score,
               CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank
        FROM pos p JOIN pairs n ON p.anchor_id = n.anchor_id AND NOT n.same
        WHERE 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM neg WHERE rank <= 5
"""
