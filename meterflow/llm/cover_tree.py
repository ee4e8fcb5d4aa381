"""Embedding near-duplicates by dual traversal of cover trees (operator 1).

Distances are angles, which obey the triangle inequality; cosine >= 0.9 is an
angle up to acos 0.9. Equal vectors are one point with a weight. Points go to
the nearest of some centres (a greedy farthest-first cover of a bounded
sample), large cells are split by hash, and every block gets a cover tree:
nested levels whose radii halve from a right angle on, each node with the
exact covering radius of what hangs below it. Blocks are numbered along the
cells and meet in tiles of two groups of them, so that a tree moves once for
each tile of a whole group of partners; tiles whose cells' covering radii rule
every link out are left out. Two trees are descended together: a
pair of nodes goes on only while centre distance minus both radii is within
the threshold. What remains at the leaves is decided by the cosine in doubles.

A pair of blocks returns, for each point with links, the weight of its links
and one edge to the smallest point it is joined with inside the pair; so the
result is linear in the points although every linked pair is found.
"""

from __future__ import annotations

import math
import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.llm.components import connected_components
from meterflow.llm.scratch import saved

SAMPLE = 2048  # points that the centres are chosen from
CENTRES = 64
BLOCK = 1024
GROUP = 16  # blocks of a side of a tile
SLACK = 1e-3  # of an angle: bounds are computed in single precision; it prunes a little less and decides nothing


def angles(cos) -> np.ndarray:
    return np.arccos(np.clip(cos, -1.0, 1.0))


def unit(vectors: np.ndarray) -> np.ndarray:
    x = vectors.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # squares of large numbers stay finite
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def greedy_cover(x: np.ndarray, first: np.ndarray, radius: float, most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(centres, centre of each point): ``first`` stay centres, further points become
    centres, farthest first, until all are within ``radius`` of one."""
    centres = list(first)
    cos = x @ x[first].T
    at, best = cos.argmax(axis=1), cos.max(axis=1)
    limit = math.cos(radius)
    while len(centres) < min(len(x), most or len(x)):
        far = int(best.argmin())
        if best[far] >= limit:
            break
        mine = x @ x[far]
        closer = mine > best
        at[closer], best = len(centres), np.maximum(best, mine)
        best[far] = 2.0
        at[far] = len(centres)
        centres.append(far)
    return np.array(centres), at


@dataclass
class CoverTree:
    """Nested levels, coarse to fine; the last level holds every point."""

    x: np.ndarray
    centres: list[np.ndarray]  # points that are nodes of a level
    parent: list[np.ndarray]  # node of the level above, for each node
    radius: list[np.ndarray]  # largest angle to a point below the node

    @classmethod
    def build(cls, x: np.ndarray) -> CoverTree:
        levels = [np.zeros(min(len(x), 1), np.int64)]
        radius = math.pi / 2
        while radius > 0.05 and len(levels[-1]) < len(x):
            levels.append(greedy_cover(x, levels[-1], radius)[0])
            radius /= 2
        if len(levels[-1]) < len(x):
            rest = np.setdiff1d(np.arange(len(x)), levels[-1])
            levels.append(np.concatenate([levels[-1], rest]))
        parent = [np.zeros(1, np.int64)]
        for up, low in zip(levels, levels[1:]):
            parent.append((x[low] @ x[up].T).argmax(axis=1))
            parent[-1][:len(up)] = np.arange(len(up))  # a node is below itself
        radii, node = [], np.arange(len(levels[-1]))
        for k in range(len(levels) - 1, -1, -1):
            r = np.zeros(len(levels[k]))
            np.maximum.at(r, node, angles((x[levels[-1]] * x[levels[k]][node]).sum(axis=1)))
            radii.append(r)
            node = parent[k][node]
        return cls(x, levels, parent, radii[::-1])


def dual_traversal(a: CoverTree, b: CoverTree, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """All (point of a, point of b) with a dot product of ``cosine`` or more."""
    theta = math.acos(cosine)
    none = np.zeros(0, np.int64)
    if not len(a.x) or not len(b.x):
        return none, none
    xa, xb = a.x.astype(np.float32), b.x.astype(np.float32)
    ka = kb = 0
    alive = np.ones((1, 1), bool)
    while True:
        ca, cb = a.centres[ka], b.centres[kb]
        rows, cols = np.flatnonzero(alive.any(axis=1)), np.flatnonzero(alive.any(axis=0))
        if not len(rows):
            return none, none
        alive = alive[np.ix_(rows, cols)]
        if ka == len(a.centres) - 1 and kb == len(b.centres) - 1:
            break
        reach = (a.radius[ka][rows] + theta + SLACK).astype(np.float32)[:, None] + b.radius[kb][cols].astype(np.float32)[None, :]
        np.minimum(reach, np.float32(math.pi), out=reach)
        near = (xa[ca[rows]] @ xb[cb[cols]].T >= np.cos(reach) - np.float32(1e-5)) & alive
        alive = np.zeros((len(ca), len(cb)), bool)
        alive[np.ix_(rows, cols)] = near
        if ka < len(a.centres) - 1:
            ka += 1
            alive = alive[a.parent[ka]]
        if kb < len(b.centres) - 1:
            kb += 1
            alive = alive[:, b.parent[kb]]
    i, j = np.nonzero(alive)
    if 8 * len(i) > alive.size:  # many are left: all products at once
        good = (a.x[ca[rows]] @ b.x[cb[cols]].T)[i, j] >= cosine
    else:
        good = np.concatenate([none.astype(bool), *((a.x[ca[rows[i[k:k + 65536]]]] * b.x[cb[cols[j[k:k + 65536]]]]).sum(axis=1) >= cosine
                                                    for k in range(0, len(i), 65536))])
    return ca[rows[i[good]]], cb[cols[j[good]]]


def points(vectors: DataFrame, name: str) -> DataFrame:
    """(id, n, v): distinct usable vectors with their smallest vec_id and number of rows."""
    usable = (F.col("embedding").isNotNull() & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
              & F.exists("embedding", lambda x: x != 0))
    v = vectors.filter(F.col("vec_id").isNotNull() & F.coalesce(usable, F.lit(False)))
    return saved(v.groupBy(F.col("embedding").alias("v")).agg(F.min("vec_id").alias("id"), F.count("*").alias("n")), name)


def packed_blocks(distinct: DataFrame, total: int, theta: float) -> tuple[DataFrame, DataFrame]:
    """(blocks, tiles): (block, ids, weights, tree), one row a block; groups (ga, gb) that may hold links."""
    spark = distinct.sparkSession
    share = min(1.0, SAMPLE / max(total, 1))
    sample = distinct.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < share * (1 << 30)).orderBy("id").limit(2 * SAMPLE).select("v").collect()
    chosen = {}  # vectors of each length form a space of their own
    for d in sorted({len(r.v) for r in sample}):
        x = unit(np.array([r.v for r in sample if len(r.v) == d]))
        chosen[d] = x[greedy_cover(x, np.zeros(1, np.int64), 0.0, max(1, min(CENTRES, total // BLOCK)))[0]]
    shared = spark.sparkContext.broadcast(chosen)  # CENTRES vectors for each length

    def assign(batches):
        for batch in batches:
            cells, far = [], []
            for v in batch.column("v").to_pylist():
                c = shared.value.get(len(v))
                cos = c @ unit(np.array([v]))[0] if c is not None else np.ones(1)
                cells.append((len(v) << 16) + int(cos.argmax()))
                far.append(float(angles(cos.max())) if c is not None else math.pi)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells, pa.int64()), pa.array(far, pa.float64())], names=["id", "n", "v", "cell", "far"])

    cells = saved(distinct.select("id", "n", "v").mapInArrow(assign, "id long, n long, v array<double>, cell long, far double"), "cover-cells")
    sizes = cells.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).cast("long").alias("parts"), F.max("far").alias("far"))
    dealt = cells.join(sizes.drop("far"), "cell").withColumn("part", F.pmod(F.xxhash64(F.lit(1), "id"), F.col("parts")))
    known = sorted(sizes.collect(), key=lambda r: r.cell)  # at most CENTRES rows for each length
    ends = np.cumsum([r.parts for r in known])
    first = {r.cell: int(e - r.parts) for r, e in zip(known, ends, strict=True)}  # number of the first block of a cell
    groups = {r.cell: (first[r.cell] // GROUP, int(e - 1) // GROUP) for r, e in zip(known, ends, strict=True)}
    pairs = []
    for p in known:
        for q in known:
            if p.cell <= q.cell and p.cell >> 16 == q.cell >> 16:
                c = chosen.get(p.cell >> 16)
                apart = 0.0 if c is None else float(angles(c[p.cell & 65535] @ c[q.cell & 65535]))
                if apart <= p.far + q.far + theta + SLACK:
                    pairs.append((*groups[p.cell], *groups[q.cell]))
    tiles = spark.createDataFrame(pairs, "a0 long, a1 long, b0 long, b1 long").select("b0", "b1", F.explode(F.sequence("a0", "a1")).alias("ga"))
    tiles = tiles.select("ga", F.explode(F.sequence("b0", "b1")).alias("gb")).filter("ga <= gb").distinct()

    def pack(key, table):
        table = table.sort_by("id")
        tree = CoverTree.build(unit(np.array(table.column("v").to_pylist())))
        return pa.Table.from_pydict({
            "block": [first[key[0].as_py()] + key[1].as_py()], "ids": [table.column("id").to_numpy().tobytes()],
            "weights": [table.column("n").to_numpy().tobytes()], "tree": [pickle.dumps(tree)]})

    return dealt.select("cell", "part", "id", "n", "v").groupBy("cell", "part").applyInArrow(
        pack, "block long, ids binary, weights binary, tree binary"), tiles


def pair_links(a: tuple, b: tuple, same: bool, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, links, smallest id joined with) of the points with links between two blocks (ids, weights, tree), or in one."""
    (ia, wa, ta), (ib, wb, tb) = a, b
    i, j = dual_traversal(ta, tb, cosine)
    links_a, links_b = np.bincount(i, weights=wb[j], minlength=len(ia)), np.bincount(j, weights=wa[i], minlength=len(ib))
    ids = np.concatenate([ia, ib])
    left, right = i, j + len(ia)
    root = np.argsort(np.argsort(ids, kind="stable"), kind="stable")  # smallest id first
    while True:  # labels of least rank run along the links
        new = root.copy()
        np.minimum.at(new, left, root[right])
        np.minimum.at(new, right, new[left])
        if (new == root).all():
            break
        root = new
    smallest = np.sort(ids)[root]
    if same:
        ids, smallest, links = ia, np.minimum(smallest[:len(ia)], smallest[len(ia):]), links_a
    else:
        links = np.concatenate([links_a, links_b])
    some = links > 0
    return ids[some], links[some].astype(np.int64), smallest[some]


def tile_links(blocks: DataFrame, tiles: DataFrame, cosine: float) -> DataFrame:
    """(id, links, root) for the points with links in each pair of blocks of the tiles (at most 2 * GROUP trees each)."""
    group = blocks.withColumn("g", F.floor(F.col("block") / GROUP).cast("long"))
    moved = tiles.join(group, F.col("ga") == F.col("g")).union(tiles.filter("ga < gb").join(group, F.col("gb") == F.col("g")))

    def run(key, table):
        ga, gb = (k.as_py() for k in key)
        held = {ga: [], gb: []}
        for r in table.sort_by("block").to_pylist():
            held[r["g"]].append((r["block"], (np.frombuffer(r["ids"], np.int64), np.frombuffer(r["weights"], np.int64), pickle.loads(r["tree"]))))
        found = [pair_links(a, b, i == j, cosine) for i, a in held[ga] for j, b in held[gb] if i <= j and a[2].x.shape[1] == b[2].x.shape[1]]
        ids, links, root = (np.concatenate([np.zeros(0, np.int64), *(f[k] for f in found)]) for k in range(3))
        return pa.table({"id": ids, "links": links, "root": root})

    return moved.select("ga", "gb", "g", "block", "ids", "weights", "tree").groupBy("ga", "gb").applyInArrow(run, "id long, links long, root long")


def near_duplicates(vectors: DataFrame, cosine: float = 0.9) -> DataFrame:
    """One row per row of ``vectors(vec_id, embedding)``: vec_id, n_links, component_id, kept.

    Two rows are linked when their cosine in doubles is ``cosine`` or more,
    equal vectors included. Vectors that are null, empty, zero, or hold null or
    non-finite components are linked with nothing, as are rows without vec_id
    (component_id null, kept) and vectors of different lengths among each
    other. Repeated rows are rows. Other columns, labels included, are ignored.
    """
    vectors = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    distinct = points(vectors, "cover-points")
    total = distinct.count()
    if not total:
        return vectors.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    blocks, tiles = packed_blocks(distinct, total, math.acos(cosine))
    links = saved(tile_links(saved(blocks, "cover-blocks"), tiles, cosine), "cover-links")
    own = links.groupBy("id").agg(F.sum("links").alias("links"))
    label = connected_components(links.select(F.col("id").alias("u"), F.col("root").alias("v")), "cover")
    final = saved(distinct.join(own, "id", "left").join(label, distinct["id"] == label["node"], "left")
                  .select("v", (F.coalesce("links", F.lit(1).cast("long")) - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id")), "cover-final")
    out = vectors.join(final, (vectors["embedding"] == final["v"]) & vectors["vec_id"].isNotNull(), "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"),
                      F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))
