"""MinHash near-duplicates by fast similarity sketching (operator 10).

Sketch: in round ``i`` every shingle is hashed into one of ``t`` bins and the
least value of a bin stays; a bin filled in one round is not touched by a
later one. From round ``t`` on, round ``t + j`` throws all shingles into bin
``j``, so after ``2 t`` rounds every coordinate is filled, whatever the size of
the set, with the concentration of ``t`` independent coordinates and close to
one pass of hashing for long texts.

Links: rows of coordinates are banded; a band shared by two documents makes
them candidates, and each candidate is decided on the full sets with integers.

Work per bucket of a band stays linear where documents are alike: equal sets
are one class; each class is compared with its bucket's least class; the
classes that this leaves in another component than their bucket's largest one
are then compared with the whole bucket. Pairs inside a component need no
check, as they cannot change a component, nor do pairs whose sets are too
unequal in size or hold too many shingles that no other set has; so no link
between components is missed among the candidates.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.llm.components import connected_components
from meterflow.llm.scratch import saved
from meterflow.llm.texts import U64, mix, shingles, signed, slices

SKETCH_SCHEMA = "doc_id long, n_shingles long, f1 long, f2 long, bands array<long>"
FULL = np.iinfo(np.uint64).max


def fill_bins(hashes: np.ndarray, row: np.ndarray, n: int, t: int) -> np.ndarray:
    """The ``n x t`` sketch of rows of hashed elements (rows without elements stay FULL)."""
    sketch = np.full(n * t, FULL, U64)
    row = row.astype(np.int64)
    for i in range(2 * t):
        if not len(hashes):
            break
        value = mix(hashes + U64((i + 1) * 0xD1B54A32D192ED03 & 0xFFFFFFFFFFFFFFFF))
        value -= value == FULL
        if i < t:
            place = row * t + ((value >> U64(32)) * U64(t) >> U64(32)).astype(np.int64)
        else:
            place = row * t + (i - t)
        if i:
            free = sketch[place] == FULL
            np.minimum.at(sketch, place[free], value[free])
        else:
            np.minimum.at(sketch, place, value)
        open_rows = (sketch.reshape(n, t) == FULL).any(axis=1)
        keep = open_rows[row]
        hashes, row = hashes[keep], row[keep]
    return sketch.reshape(n, t)


def band_keys(sketch: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key for each band of ``rows`` coordinates."""
    n, t = sketch.shape
    keys = np.zeros((n, t // rows), U64)
    parts = sketch.reshape(n, t // rows, rows)
    for j in range(rows):
        keys = mix(keys * U64(0x9E3779B97F4A7C15) + parts[:, :, j])
    return keys


def sketches(docs: DataFrame, k: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, n_shingles, f1, f2, bands): set size, a 128-bit fingerprint of the set, band keys."""
    t = bands * rows

    def run(batches):
        for part in slices(batches):
            h, row, n = shingles(part.column("text"), k)
            count = np.bincount(row, minlength=n)
            f1, f2 = np.zeros(n, U64), np.zeros(n, U64)
            np.add.at(f1, row, mix(h + U64(0x5851F42D4C957F2D)))
            np.add.at(f2, row, mix(h ^ U64(0x14057B7EF767814F)))
            keys = band_keys(fill_bins(h, row, n, t), rows)
            lists = pa.ListArray.from_arrays(np.arange(0, n * bands + 1, bands, dtype=np.int32), pa.array(signed(keys.reshape(-1))))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), pa.array(count.astype(np.int64)), pa.array(signed(f1)), pa.array(signed(f2)), lists],
                names=["doc_id", "n_shingles", "f1", "f2", "bands"])

    return docs.select("doc_id", "text").mapInArrow(run, SKETCH_SCHEMA)


def overlaps(pairs: DataFrame, k: int, percent: int) -> DataFrame:
    """The rows of ``pairs(u, v, text_u, text_v)`` with 100 * intersection >= percent * union."""
    def run(batches):
        for part in slices(batches, "text_u", 2 << 20, "text_v"):
            a, ra, n = shingles(part.column("text_u"), k)
            b, rb, _ = shingles(part.column("text_v"), k)
            h, row = np.concatenate([a, b]), np.concatenate([ra, rb])
            order = np.lexsort((h, row))
            h, row = h[order], row[order]
            both = np.bincount(row[1:][(h[1:] == h[:-1]) & (row[1:] == row[:-1])], minlength=n)
            union = np.bincount(row, minlength=n) - both
            good = (union > 0) & (100 * both >= percent * union)
            yield pa.RecordBatch.from_arrays([part.column(c).filter(pa.array(good)) for c in ("u", "v")], names=["u", "v"])

    return pairs.select("u", "v", "text_u", "text_v").mapInArrow(run, "u long, v long")


def exploded_shingles(texts: DataFrame, k: int) -> DataFrame:
    """(doc_id, h): the distinct hashed shingles of each row of ``texts(doc_id, text)``."""
    def run(batches):
        for part in slices(batches):
            h, row, _ = shingles(part.column("text"), k)
            yield pa.RecordBatch.from_arrays([part.column("doc_id").take(pa.array(row)), pa.array(signed(h))], names=["doc_id", "h"])

    return texts.select("doc_id", "text").mapInArrow(run, "doc_id long, h long")


def shingle_sets(texts: DataFrame, k: int) -> DataFrame:
    """(doc_id, hashes): the distinct hashed shingles of each row of ``texts(doc_id, text)`` as one array."""
    def run(batches):
        for part in slices(batches):
            h, row, n = shingles(part.column("text"), k)
            ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=n))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends), pa.array(signed(h)))], names=["doc_id", "hashes"])

    return texts.select("doc_id", "text").mapInArrow(run, "doc_id long, hashes array<long>")


def near_duplicates(docs: DataFrame, k: int = 3, percent: int = 85, bands: int = 25, rows: int = 5) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, n_shingles, component_id, kept.

    Documents are linked when the Jaccard similarity of their sets of distinct
    ``k``-word shingles is ``percent`` or more; ``component_id`` is the
    smallest doc_id that links reach. With 25 bands of 5 rows, a pair at 0.85
    escapes all bands with probability 4e-7; 32 bands of 4 give 5e-8 at 0.8.

    Null or empty texts, and texts without words, have n_shingles 0 and are
    linked with nothing. A row without doc_id is linked with nothing: its
    component_id is null and it is kept. Repeated rows give repeated rows.
    Other columns are ignored. An empty table gives an empty result.
    """
    docs = docs.select("doc_id", "text")
    sketch = saved(sketches(docs, k, bands, rows), "minhash-sketches")
    known = sketch.filter("n_shingles > 0 and doc_id is not null")
    # classes of equal sets, each with its smallest document
    classes = saved(known.groupBy("f1", "f2", "n_shingles").agg(F.min("doc_id").alias("rep")), "minhash-classes")
    reps = known.join(classes.select("rep"), known["doc_id"] == F.col("rep"), "left_semi").dropDuplicates(["doc_id"])
    keys = reps.select("doc_id", "n_shingles", F.posexplode("bands").alias("band", "key"))
    full = keys.groupBy("band", "key").agg(F.count("*").alias("n"), F.min("doc_id").alias("lead")).filter("n > 1")
    near = saved(keys.join(full.drop("n"), ["band", "key"]), "minhash-buckets")
    # the texts of candidates, read in each of the two comparisons
    ids = near.select("doc_id").distinct()
    texts = saved(docs.join(ids, "doc_id", "left_semi").dropDuplicates(["doc_id"]), "minhash-texts")

    def confirmed(pairs, name):
        with_v = pairs.join(texts.select(F.col("doc_id").alias("v"), F.col("text").alias("text_v")), "v")
        with_u = with_v.join(texts.select(F.col("doc_id").alias("u"), F.col("text").alias("text_u")), "u")
        return saved(overlaps(with_u, k, percent), name)

    first = confirmed(near.filter("doc_id != lead").select(F.col("lead").alias("u"), F.col("doc_id").alias("v")).distinct(),
                      "minhash-first")
    label = connected_components(first, "minhash-first")
    now = saved(near.join(label, near["doc_id"] == label["node"], "left")
                .select("band", "key", "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component")), "minhash-now")
    # buckets that hold several components: all outside the largest are compared with the bucket
    held = now.groupBy("band", "key", "component").agg(F.count("*").alias("n"))
    main = (held.groupBy("band", "key").agg(F.count("*").alias("parts"), F.max(F.struct("n", "component"))["component"].alias("main"))
            .filter("parts > 1").drop("parts"))
    mixed = saved(now.join(main, ["band", "key"]), "minhash-mixed")
    # what a document can share with others at most: its shingles less those that no other one here has
    own = (exploded_shingles(texts.join(mixed.select("doc_id").distinct(), "doc_id", "left_semi"), k).groupBy("h")
           .agg(F.count("*").alias("n"), F.min("doc_id").alias("doc_id")).filter("n = 1").groupBy("doc_id").agg(F.count("*").alias("alone")))
    shared = F.col("n_shingles") - F.coalesce("alone", F.lit(0))
    able = saved(mixed.join(own, "doc_id", "left").withColumn("shared", shared)
                 .filter(F.lit(100) * F.col("shared") >= F.lit(percent) * F.col("n_shingles")).drop("alone"), "minhash-able")
    sets = shingle_sets(texts.join(able.select("doc_id").distinct(), "doc_id", "left_semi"), k)
    able = saved(able.join(sets, "doc_id"), "minhash-sets")
    outside = able.filter("component != main").select(
        "band", "key", F.col("doc_id").alias("o"), F.col("n_shingles").alias("no"), F.col("shared").alias("so"),
        F.col("component").alias("co"), F.col("hashes").alias("ho"))
    most = F.least("shared", "so")  # of the intersection, so the union is at least what follows
    both = F.size(F.array_intersect("hashes", "ho"))
    # the whole test is the condition of the join: only links leave it
    second = saved(able.join(outside, (able["band"] == outside["band"]) & (able["key"] == outside["key"])
                             & (F.col("component") != F.col("co"))
                             & (F.lit(100) * most >= F.lit(percent) * (F.col("n_shingles") + F.col("no") - most))
                             & (F.lit(100) * both >= F.lit(percent) * (F.col("n_shingles") + F.col("no") - both)))
                   .select(F.least("doc_id", "o").alias("u"), F.greatest("doc_id", "o").alias("v")).distinct(), "minhash-second")
    label = connected_components(first.union(second), "minhash")
    final = saved(classes.join(label, classes["rep"] == label["node"], "left")
                  .select("f1", "f2", F.col("n_shingles").alias("n"), F.coalesce("component", "rep").alias("component_id")),
                  "minhash-final")
    s = sketch.select("doc_id", "n_shingles", "f1", "f2")
    out = s.join(final, (s["f1"] == final["f1"]) & (s["f2"] == final["f2"]) & (s["n_shingles"] == final["n"])
                 & s["doc_id"].isNotNull(), "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))
