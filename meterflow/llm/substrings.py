"""Substring dedup by seed and extend (operator 12).

A passage of ``length`` words that stands at two places is removed at both.

1. Seeds. Of all runs of ``seed`` words in a window of ``length`` words, the
   one with the least hash is the window's anchor (winnowing). Equal windows
   have their anchors at the same offset, so anchors alone find all of them:
   about one word in eleven is stored instead of every word.
2. Join. Anchors are grouped by hash; those that stand at one place only go.
3. Extend. Each place is extended both ways as far as its windows reach.
   Places with equal extensions are one class; a class with two places is a
   repeat to its full extent. Where an anchor has several classes, one place
   of each is extended step by step: every window that has this anchor is a
   row with the class's count, and windows that two places share are repeats.
4. The repeat around a place runs from its first to its last repeated window
   (all hold the anchor, so they leave no hole). Its words go.

Rows grow with words, never with pairs of places: a passage that stands on a
third of all documents is one class, or one window row for each class. Every
grouping is combined before its shuffle, and joins have one row a key on one
side, so hot keys can be split. Windows are compared by two hashes of 64 bits
over 64-bit hashes of their words.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.llm.scratch import saved
from meterflow.llm.texts import U64, buffer, mix, signed, slices, word_hashes, word_starts

SEED = 15
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse
BACK = pow(BASE, -1, 1 << 64)
OTHER = U64(0x5851F42D4C957F2D)


class Rolling:
    """Hashes of any runs of words from prefix sums: sum of word * BASE**i, shifted back by BASE**-start."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        power = np.full(n + 1, U64(BASE))
        power[0] = U64(1)
        power = np.cumprod(power, dtype=U64)
        back = np.full(n + 1, U64(BACK))
        back[0] = U64(1)
        self.back = np.cumprod(back, dtype=U64)
        self.sums = np.zeros(n + 1, U64)
        np.cumsum(words * power[:n], out=self.sums[1:], dtype=U64)

    def of(self, start: np.ndarray, stop: np.ndarray, key: U64 = U64(0)) -> np.ndarray:
        return mix((self.sums[stop] - self.sums[start]) * self.back[start] + key)


def least_in_windows(x: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` values the position of the least, of equal ones the last."""
    pos = np.arange(len(x))
    step = 1
    best, value = pos, x
    while step * 2 <= width:  # runs of 1, 2, 4, ... values
        a, b = value[:-step], value[step:]
        right = b <= a
        best = np.where(right, best[step:], best[:-step])
        value = np.where(right, b, a)
        step *= 2
    rest = width - step
    if rest:
        a, b = value[:len(value) - rest], value[rest:]
        best = np.where(b <= a, best[rest:], best[:len(best) - rest])
    return best


def anchors(words: np.ndarray, row: np.ndarray, length: int):
    """Hashes of runs and of seeds, window starts and their anchors, for all windows within one row of ``words``."""
    if len(words) < length:
        return None
    rolling = Rolling(words)
    at = np.arange(len(words) - SEED + 1)
    seeds = rolling.of(at, at + SEED)
    best = least_in_windows(seeds, length - SEED + 1)
    start = np.flatnonzero(row[:len(best)] == row[length - 1:length - 1 + len(best)])
    return rolling, seeds, start, best[start]


def text_words(column: pa.Array):
    """Hashes of all words of a column, the row of each, and where each row's words begin."""
    data, offsets = buffer(column)
    starts, row = word_starts(data, offsets)
    begin = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(offsets) - 1))])
    return word_hashes(data, starts, offsets), row, begin


def places(docs: DataFrame, length: int) -> DataFrame:
    """(doc_id, t, pos, h, c, lo, hi): the anchors of every text.

    pos is the anchor's first word; windows that have it start lo to hi words
    before; h hashes the seed, c all words that these windows reach.
    """
    def run(batches):
        for part in slices(batches, "text"):
            words, row, begin = text_words(part.column("text"))
            found = anchors(words, row, length)
            if found is None or not len(found[2]):
                continue
            rolling, seeds, start, best = found
            # windows of one anchor follow each other
            first = np.flatnonzero(np.concatenate([[True], best[1:] != best[:-1]]))
            last = np.concatenate([first[1:], [len(best)]]) - 1
            p, hi, lo = best[first], best[first] - start[first], best[first] - start[last]
            c = rolling.of(p - hi, p - lo + length, U64(1)) ^ mix((hi * 256 + lo).astype(U64))
            r = row[p]
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id").take(pa.array(r)), part.column("t").take(pa.array(r)), pa.array((p - begin[r]).astype(np.int32)),
                pa.array(signed(seeds[p])), pa.array(signed(c)), pa.array(lo.astype(np.int16)), pa.array(hi.astype(np.int16))],
                names=["doc_id", "t", "pos", "h", "c", "lo", "hi"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.xxhash64("text").alias("t"), "text").filter("text is not null").mapInArrow(
        run, f"doc_id {kind}, t long, pos int, h long, c long, lo short, hi short")


def windows(docs: DataFrame, reps: DataFrame, length: int) -> DataFrame:
    """(h, c, n, l, a, b): every window of the places in ``reps``; l is the anchor's offset, a and b hash the window."""
    need = reps.groupBy(F.col("doc_id").alias("_d"), F.col("t").alias("_t")).agg(F.collect_set(F.struct("pos", "h", "c", "lo", "hi", "n")).alias("at"))
    texts = docs.select("doc_id", F.xxhash64("text").alias("t"), "text").filter("text is not null")
    both = texts.join(need, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("t") == F.col("_t"))).select("text", "at")

    def run(batches):
        for part in slices(batches, "text"):
            words, _, begin = text_words(part.column("text"))
            rolling = Rolling(words)
            lists = part.column("at")
            rows = lists.flatten()
            owner = np.repeat(np.arange(part.num_rows), np.diff(lists.offsets.to_numpy()))
            pos, h, c, lo, hi, n = (rows.field(k).to_numpy() for k in range(6))
            many = (hi - lo + 1).astype(np.int64)
            i = np.repeat(np.arange(len(pos)), many)
            back = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + lo[i]
            start = begin[owner[i]] + pos[i] - back
            a, b = rolling.of(start, start + length), rolling.of(start, start + length, OTHER)
            for cut in range(0, len(i), 1 << 18):
                s = slice(cut, cut + (1 << 18))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (
                    h[i[s]], c[i[s]], n[i[s]], back[s].astype(np.int16), signed(a[s]), signed(b[s]))], names=["h", "c", "n", "l", "a", "b"])

    return both.mapInArrow(run, "h long, c long, n long, l short, a long, b long")


def repeats(docs: DataFrame, length: int) -> DataFrame:
    """(doc_id, t, start, stop): maximal runs of words around an anchor that repeated windows cover."""
    every = saved(places(docs, length), "substring-places")
    seeds = saved(every.groupBy("h").agg(F.count("*").alias("n"), F.min("c").alias("c1"), F.max("c").alias("c2"))
                  .filter("n > 1").select("h", (F.col("c1") == F.col("c2")).alias("one")), "substring-seeds")
    shared = saved(every.join(seeds, "h"), "substring-shared")
    whole = shared.filter("one").select("doc_id", "t", (F.col("pos") - F.col("hi")).alias("start"), (F.col("pos") - F.col("lo") + length).alias("stop"))
    mixed = shared.filter("not one")
    place = F.min(F.struct(F.col("doc_id").isNull().alias("o"), "doc_id", "t", "pos", "lo", "hi"))
    classes = mixed.groupBy("h", "c").agg(F.count("*").alias("n"), place.alias("p"))
    reps = saved(classes.select("h", "c", "n", "p.doc_id", "p.t", "p.pos", "p.lo", "p.hi"), "substring-classes")
    rows = saved(windows(docs, reps, length).distinct(), "substring-windows")
    twice = saved(rows.groupBy("l", "a", "b").agg(F.sum("n").alias("n")).filter("n > 1").select("l", "a", "b"), "substring-repeated")
    extent = saved(rows.join(twice, ["l", "a", "b"], "left_semi").groupBy("h", "c").agg(F.min("l").alias("l1"), F.max("l").alias("l2")),
                   "substring-extents")
    partly = mixed.join(extent, ["h", "c"]).select("doc_id", "t", (F.col("pos") - F.col("l2")).alias("start"), (F.col("pos") - F.col("l1") + length).alias("stop"))
    return whole.union(partly).distinct()


def merged(spans) -> list:
    """Runs of words in order, overlapping ones as one."""
    out = []
    for s in sorted((x["start"], x["stop"]) for x in spans or ()):
        if out and s[0] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], s[1])
        else:
            out.append(list(s))
    return out


def drop_repeats(docs: DataFrame, length: int = 35, digest: bool = False) -> DataFrame:
    """``docs(doc_id, text)`` without repeated passages: doc_id, n_words, n_removed,
    spans (start and stop word of each removed run), and text (kept words joined
    by one space), or kept_sha256, its lowercase hex digest, with ``digest``.

    A word is ``[^\\x20\\x09-\\x0D]+``, unchanged. It goes if a window of
    ``length`` consecutive words that covers it also starts at another place,
    in the same text too (places may overlap). Windows are judged on the input.

    Every row stays a row; rows that repeat a document are copies of it, so
    their windows repeat. A null text counts as an empty one: no words, empty
    result. A null doc_id is a value like another. Texts of fewer than
    ``length`` words stay whole. Other columns are ignored. ``length`` is from
    ``SEED`` + 1 to ``SEED`` + 255.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    docs = docs.select("doc_id", "text")
    spans = saved(repeats(docs, length), "substring-spans")
    at = spans.groupBy(F.col("doc_id").alias("_d"), F.col("t").alias("_t")).agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    both = docs.withColumn("t", F.xxhash64("text")).join(at, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("t") == F.col("_t")), "left")
    last = "kept_sha256" if digest else "text"

    def clean(text, spans):
        words = text.encode().split() if text else []  # bytes split at exactly these six blanks
        spans = merged(spans)
        kept, at = [], 0
        for start, stop in spans:
            kept += words[at:start]
            at = stop
        kept = b" ".join(kept + words[at:] if spans else words)
        return (len(words), sum(b - a for a, b in spans), [{"start": a, "stop": b} for a, b in spans],
                hashlib.sha256(kept).hexdigest() if digest else kept.decode())

    def run(batches):
        run_type = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
        for part in slices(batches, "text", 4 << 20):
            rows = [clean(t, s) for t, s in zip(part.column("text").to_pylist(), part.column("spans").to_pylist(), strict=True)]
            n, gone, runs, out = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()),
                                              pa.array(runs, run_type), pa.array(out, pa.string())],
                                             names=["doc_id", "n_words", "n_removed", "spans", last])

    return both.select("doc_id", "text", "spans").mapInArrow(
        run, f"doc_id {kind}, n_words long, n_removed long, spans array<struct<start:int,stop:int>>, {last} string")


ORACLE_SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
w AS (SELECT r, i, md5(array_to_string(list_slice(words, i, i + 34), ' ')) AS h FROM d, unnest(range(1, len(words) - 33)) AS u(i)),
twice AS (SELECT h FROM w GROUP BY h HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS p FROM w JOIN twice USING (h)),
word AS (SELECT r, p, words[p] AS word FROM d, unnest(range(1, len(words) + 1)) AS u(p)),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY p) AS rest, count(*) AS n FROM word ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(rest, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""
