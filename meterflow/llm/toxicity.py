"""Toxicity by nearest labelled examples (operator 8).

Terms are all the words of the examples, and the first four or five letters of
longer words (stems stand for unseen endings); their inverse document
frequencies are counted over all documents and weighted by how the term goes
with the label among the examples, never by 0; how much, the examples' own
leave-one-out votes decide. Examples are unit vectors
of these weights. Weights of common terms are multiplied in full; the others are in
an inverted index whose postings come in blocks of examples, each
with the largest weight of a term in the block. Like examples lie in one
block (halved along the main directions), so that most blocks of another
language or topic have low bounds. A document's cosine with the
examples of a block is bounded by these and the common part, and the k-th
largest common part is a floor for the k-th nearest, so only blocks that can
reach it are searched and the neighbours are exact. Their votes, weighted by cosine, are calibrated by
logistic regression on leave-one-out votes of the examples.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.llm.scratch import bounded_batches
from meterflow.llm.texts import STEP, U64, mix, slices

PER_LABEL = 1500  # examples of each label, chosen by hash
FLOORS = (0.05, 0.2, 1.0)  # weight of a term that is as frequent with either label, 1 more of one that tells them apart; leave-one-out votes choose
BLOCK = 64
COMMON = 1024  # at most so many terms, of a sixteenth of the examples each, are held as full rows
NEIGHBOURS = 15
SLACK = 1e-4  # above the error of a single-precision sum over COMMON terms of unit vectors
PIECE = 1 << 20  # code points that are hashed at once, more where a word goes on
STEM = U64(0xD1B54A32D192ED03)
WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> Counter:
    return Counter(WORD.findall((text or "").lower()))


def forms(word: str) -> list[str]:
    """The word and its stems, which end in a hyphen."""
    return [word, *(word[:n] + "-" for n in (4, 5) if len(word) > n)]


@lru_cache(1)
def code_points() -> tuple[np.ndarray, np.ndarray]:
    """(whether it is a letter of a word, a random odd key) of each code point."""
    letter = np.zeros(0x110000, bool)
    for run in WORD.finditer("".join(map(chr, range(0x110000)))):
        letter[run.start():run.end()] = True
    return letter, mix(np.arange(0x110000, dtype=U64)) | U64(1)


def form_hashes(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, 64-bit hash) of the forms of every word of ``texts``, by pieces that end between words."""
    letter, keys = code_points()
    low = [(t or "").lower() for t in texts]
    joined, first = "\n".join(low), np.cumsum([0, *(len(t) + 1 for t in low[:-1])])
    at = 0
    while at < len(joined):
        word = WORD.match(joined, at + PIECE)
        end = word.end() if word else min(at + PIECE, len(joined))
        code = np.frombuffer(joined[at:end].encode("utf-32-le", "surrogatepass"), np.uint32)
        place = np.flatnonzero(letter[code])
        if len(place):
            new = np.ones(len(place), bool)
            new[1:] = place[1:] != place[:-1] + 1
            begin = np.flatnonzero(new)
            n = np.diff(begin, append=len(place))
            row = np.repeat(np.arange(len(low)), np.diff(np.searchsorted(place[begin] + at, first), append=len(begin)))
            powers = np.cumprod(np.full(int(n.max()), STEP, U64), dtype=U64)
            value = keys[code[place]] * powers[np.arange(len(place)) - np.repeat(begin, n)]
            four, five = np.flatnonzero(n > 4), np.flatnonzero(n > 5)
            stem = np.zeros(len(n), U64)
            stem[four] = sum((value[begin[four] + i] for i in range(4)), np.zeros(len(four), U64))
            yield (np.concatenate([row, row[four], row[five]]),
                   mix(np.concatenate([np.add.reduceat(value, begin), stem[four] ^ STEM, (stem[five] + value[begin[five] + 4]) ^ STEM])))
        at = end


class Terms(Mapping):
    """The number of each term, which is its place in an ascending Arrow array without repeats."""

    def __init__(self, names: pa.Array):
        self.names = names

    def __len__(self) -> int:
        return len(self.names)

    def __iter__(self) -> Iterator[str]:
        return iter(self.names.to_pylist())

    def __getitem__(self, name: str) -> int:
        at = bisect_left(self.names, name, key=lambda x: x.as_py())
        if at == len(self) or self.names[at].as_py() != name:
            raise KeyError(name)
        return at

    def values(self) -> range:
        return range(len(self))


class TermCounter:
    """Counts of known terms in texts; a term is known by the 64-bit hash of its letters."""

    def __init__(self, terms: Mapping[str, int]):
        self.size = max(len(terms), 1)
        names = np.array([t.rstrip("-") for t in terms], object)
        stems = np.array([t.endswith("-") for t in terms], bool)
        whole, numbers = np.zeros(len(names), U64), np.fromiter(terms.values(), np.int64, len(terms))
        letter, keys = code_points()
        length = np.array([len(t) for t in names], np.int64)
        code = np.frombuffer("".join(names).encode("utf-32-le", "surrogatepass"), np.uint32)
        if len(code):
            begin = np.cumsum(length) - length
            powers = np.cumprod(np.full(int(length.max()), STEP, U64), dtype=U64)
            whole = np.add.reduceat(keys[code] * powers[np.arange(len(code)) - np.repeat(begin, length)], begin)
        self.shift = 64 - max(4, (4 * len(names)).bit_length())
        self.term = np.full(1 << (64 - self.shift), -1, np.int32)
        self.key = np.zeros(len(self.term), U64)
        hashes = mix(np.where(stems, whole ^ STEM, whole))
        place, todo = (hashes >> U64(self.shift)).astype(np.int64), np.arange(len(names))
        while len(todo):
            free = todo[self.term[place[todo]] < 0]
            self.term[place[free]], self.key[place[free]] = numbers[free], hashes[free]
            todo = todo[self.term[place[todo]] != numbers[todo]]
            place[todo] = (place[todo] + 1) & (len(self.term) - 1)

    def known(self, hashes: np.ndarray) -> np.ndarray:
        """The term of each hash, or -1."""
        place = (hashes >> U64(self.shift)).astype(np.int64)
        found = self.term[place]
        todo = np.flatnonzero((found >= 0) & (self.key[place] != hashes))
        while len(todo):
            place[todo] = (place[todo] + 1) & (len(self.term) - 1)
            found[todo] = self.term[place[todo]]
            todo = todo[(found[todo] >= 0) & (self.key[place[todo]] != hashes[todo])]
        return found

    def counts(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, term, how often it is there), in order of rows and terms."""
        key, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for row, hashes in form_hashes(texts):
            term = self.known(hashes)
            here = term >= 0
            more, times = np.unique(row[here] * self.size + term[here], return_counts=True)
            if len(key):
                more, at = np.unique(np.concatenate([key, more]), return_inverse=True)
                times = np.bincount(at, np.concatenate([n, times]), len(more)).astype(np.int64)
            key, n = more, times
        return key // self.size, key % self.size, n

    def arrays(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(terms in ascending order, their counts) of each text."""
        row, term, n = self.counts(texts)
        cut = np.searchsorted(row, np.arange(1, len(texts)))
        return list(zip(np.split(term, cut), np.split(n, cut), strict=True))

    def __call__(self, text: str | None) -> dict[int, int]:
        _, term, n = self.counts([text])
        return dict(zip(term.tolist(), n.tolist(), strict=True))


def spans(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the numbers of all ranges, one range after the other; how many each has)."""
    n = end - begin
    return np.repeat(end - np.cumsum(n), n) + np.arange(n.sum()), n


@dataclass
class BlockMaxIndex:
    """Inverted index of unit vectors: the postings of a term lie in blocks of BLOCK examples.

    The full rows of the common terms are made when first asked for, and not pickled.
    """

    size: int  # examples
    begin: np.ndarray  # of each term: the first of its blocks, and the end
    block: np.ndarray  # of each (term, block): the block
    largest: np.ndarray  # its largest weight
    start: np.ndarray  # its first posting, and the end
    example: np.ndarray  # of each posting
    weight: np.ndarray
    common: np.ndarray  # of each term: its row among the common terms, which have no postings, or -1
    commons: int  # common terms
    held_by: np.ndarray  # of each weight of a common term: the example
    held: np.ndarray  # its row
    held_weight: np.ndarray  # the weight

    @cached_property
    def full(self) -> np.ndarray:
        """Examples x common terms: the weights."""
        out = np.zeros((self.size, self.commons))
        out[self.held_by, self.held] = self.held_weight
        return out

    @cached_property
    def single(self) -> np.ndarray:
        """Common terms x examples: the same in single precision."""
        return self.full.T.astype(np.float32)

    def __getstate__(self) -> dict:
        return {k: x for k, x in self.__dict__.items() if k not in ("full", "single")}

    @classmethod
    def build(cls, matrix: np.ndarray) -> BlockMaxIndex:
        """From a matrix of examples x terms."""
        at = [np.flatnonzero(r) for r in matrix]
        return cls.of([(t, r[t]) for t, r in zip(at, matrix, strict=True)], matrix.shape[1])

    @classmethod
    def of(cls, rows: list[tuple[np.ndarray, np.ndarray]], terms: int) -> BlockMaxIndex:
        """From (terms, weights) of each example."""
        row = np.repeat(np.arange(len(rows), dtype=np.int32), [len(t) for t, _ in rows])
        col = np.concatenate([np.zeros(0, np.int32), *(t for t, _ in rows)], dtype=np.int32)
        val = np.concatenate([np.zeros(0), *(x for _, x in rows)])
        held = np.bincount(col, minlength=terms)
        often = np.lexsort((np.arange(terms), -held))[:COMMON]
        often = often[16 * held[often] >= max(len(rows), 16)]
        common = np.full(terms, -1, np.int32)
        common[often] = np.arange(len(often))
        rare = common[col] < 0
        commons = row[~rare], common[col[~rare]], val[~rare]
        row, col, val = row[rare], col[rare], val[rare]
        order = np.lexsort((row, col))
        row, col, val = row[order], col[order], val[order]
        new = np.ones(len(col), bool)
        new[1:] = (col[1:] != col[:-1]) | (row[1:] // BLOCK != row[:-1] // BLOCK)
        start = np.flatnonzero(new)
        largest = np.maximum.reduceat(val, start) if len(val) else val
        return cls(len(rows), np.searchsorted(col[start], np.arange(terms + 1)), row[start] // BLOCK, largest,
                   np.append(start, len(val)), row, val, common, len(often), *commons)

    def of_common(self, vectors: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """What the common terms add to the cosine of each vector (terms, weights) with each example, within ``SLACK``."""
        queries = np.zeros((len(vectors), len(self.single)), np.float32)
        for q, (terms, weights) in zip(queries, vectors, strict=True):
            here = self.common[terms]
            q[here[here >= 0]] = weights[here >= 0]
        return queries @ self.single

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int, skip: int = -1, base: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(examples, cosines) of the ``k`` nearest with a cosine above 0; ties go to the smaller example.

        ``base`` is the vector's row of ``of_common``, if there is one already.
        The k-th largest of it is a floor of the k-th cosine: blocks whose bound
        is lower are left out. All that single precision can't tell from the
        nearest stays until the cosines are there in double precision.
        """
        if not self.size:
            return np.zeros(0, np.int64), np.zeros(0)
        if base is None:
            base = self.of_common([(terms, weights)])[0]
        if skip >= 0:
            base = base.copy()
            base[skip] = 0
        common = self.common[terms]
        rare = common < 0
        term, x = terms[rare], weights[rare]
        entry, n = spans(self.begin[term], self.begin[term + 1])
        block, by_entry = self.block[entry], np.repeat(x, n)
        bound = np.maximum.reduceat(base, np.arange(0, self.size, BLOCK)) + np.bincount(block, by_entry * self.largest[entry], -(-self.size // BLOCK))
        kth = max(self.size - k, 0)
        chosen = bound >= np.partition(base, kth)[kth] - 2 * SLACK
        if 4 * chosen.sum() < len(chosen):
            here = chosen[block]
            x, entry = by_entry[here], entry[here]
            posting, n = spans(self.start[entry], self.start[entry + 1])
        else:  # whole lists are read faster than a large part of their blocks
            posting, n = spans(self.start[self.begin[term]], self.start[self.begin[term + 1]])
        more = np.bincount(self.example[posting], np.repeat(x, n) * self.weight[posting], self.size).astype(float)
        if skip >= 0:
            more[skip] = 0
        near = base + more
        ids = np.flatnonzero((near > 0) & (near >= np.partition(near, kth)[kth] - 2 * SLACK))
        cos = more[ids] + self.full[ids[:, None], common[~rare]] @ weights[~rare]
        best = np.lexsort((ids, -np.round(cos, 12)))[:k]
        return ids[best], cos[best]


def unit(at: np.ndarray, n: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(terms, weights of unit length) from terms and their counts."""
    x = (1 + np.log(n)) * weight[at]
    return at, x / np.sqrt(x @ x) if len(x) else x


def arranged(rows: list[tuple[np.ndarray, np.ndarray]], size: int = BLOCK, width: int = 512) -> list[int]:
    """An order of unit vectors (terms, weights) in which each run of ``size`` holds like ones.

    The vectors, hashed to ``width`` signed sums, are halved again and again
    along the direction in which they vary most, at a multiple of ``size``.
    """
    dense = np.zeros((len(rows), width))
    for r, (at, x) in zip(dense, rows, strict=True):
        h = mix(at.astype(U64))
        np.add.at(r, (h % U64(width)).astype(np.int64), np.where(h >> U64(63), x, -x))
    out, todo = [], [np.arange(len(rows))]
    while todo:
        part = todo.pop()
        if len(part) <= size:
            out += part.tolist()
            continue
        x = dense[part] - dense[part].mean(0)
        axis = x[np.argmax((x * x).sum(1))]
        for _ in range(12):
            axis = x.T @ (x @ axis)
            axis /= max(np.sqrt(axis @ axis), 1e-300)
        part = part[np.lexsort((part, np.round(x @ axis, 9)))]
        half = max(size, round(len(part) / 2 / size) * size)
        todo += [part[half:], part[:half]]
    return out


@dataclass
class ToxicityModel:
    terms: Mapping[str, int]
    weight: np.ndarray  # of each term: inverse document frequency x association
    index: BlockMaxIndex
    doc_ids: np.ndarray
    toxic: np.ndarray
    prior: float  # of the votes, as if of half a neighbour
    slope: float
    offset: float
    none: float  # score of a text without any term

    def vector(self, found: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
        """(terms, weights) of unit length from counts of terms, empty without terms."""
        return unit(np.fromiter(found.keys(), np.int64, len(found)), np.fromiter(found.values(), float, len(found)), self.weight)

    def vote(self, ids: np.ndarray, cos: np.ndarray) -> float:
        return float((cos @ self.toxic[ids] + 0.5 * self.prior) / (cos.sum() + 0.5))

    def scores(self, found: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[float, np.ndarray, np.ndarray]]:
        """(calibrated score, neighbours, cosines) from the terms and counts of each text."""
        vectors = [unit(at, n, self.weight) for at, n in found]
        for i in range(0, len(vectors), 256):
            part = vectors[i:i + 256]
            for (at, x), base in zip(part, self.index.of_common(part), strict=True):
                if len(at):
                    ids, cos = self.index.nearest(at, x, NEIGHBOURS, base=base)
                    yield self.calibrated(self.vote(ids, cos)), ids, cos
                else:
                    yield self.none, np.zeros(0, np.int64), np.zeros(0)

    def calibrated(self, vote: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * vote + self.offset, -30, 30))))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset by Newton's method with a little shrinkage."""
    a = np.stack([x, np.ones_like(x)], axis=1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (weight * p * (1 - p))[:, None]).T @ a + 1e-2 * np.eye(2), a.T @ (weight * (y - p)) - 1e-2 * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def held_out(doc_id="doc_id"):
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL, seed: int = 31) -> ToxicityModel:
    """Learns from ``labels(doc_id, toxic)`` of rows that are not held out.

    Of a doc_id labelled twice the larger label counts; null ids and labels are left out.
    """
    spark = docs.sparkSession
    known = (labels.filter(~held_out() & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
             .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic")))
    count = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    n1, n0 = count.get(1, 0), sum(c for y, c in count.items() if y != 1)
    rate = n1 / max(n1 + n0, 1)
    share = F.when(F.col("toxic") == 1, min(1.0, per_label / max(n1, 1))).otherwise(min(1.0, per_label / max(n0, 1)))
    chosen = known.filter(F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 30)) < share * (1 << 30)).limit(4 * per_label).collect()
    label = {r.doc_id: int(r.toxic == 1) for r in chosen}
    few = F.broadcast(spark.createDataFrame(list(label.items()), "doc_id long, toxic int"))  # at most 4 * per_label rows
    examples = docs.select("doc_id", "text").join(few, "doc_id")

    def example_words(batches):
        for part in slices(batches, "text", 8 << 20):
            for y, t in zip(part.column("toxic").to_pylist(), part.column("text").to_pylist(), strict=True):
                w = sorted({f for word in words_of(t) for f in forms(word)})
                yield pa.RecordBatch.from_arrays([pa.array(w, pa.string()), pa.array([y] * len(w), pa.int64())], names=["word", "y"])

    all1, all0 = n1, n0
    n1, n0 = max(sum(label.values()), 1), max(len(label) - sum(label.values()), 1)
    counted = (bounded_batches(examples).mapInArrow(example_words, "word string, y long").groupBy("word")
               .agg(F.sum("y").alias("a"), F.sum(1 - F.col("y")).alias("b")).toArrow().sort_by("word"))  # the words of at most 4 * per_label texts
    terms = Terms(counted["word"].combine_chunks())
    a, b = (counted[c].to_numpy().astype(float) for c in "ab")
    chi = (n1 + n0) * (a * (n0 - b) - b * (n1 - a)) ** 2 / (n1 * n0 * (a + b) * np.maximum(n1 + n0 - a - b, 1.0))
    association = np.sqrt(np.minimum(chi / (n1 + n0), 1.0))
    shared = spark.sparkContext.broadcast(terms)

    def frequencies(batches):
        n, count = 0, TermCounter(shared.value)
        held = np.zeros(count.size, np.int64)
        for part in slices(batches):
            n += part.num_rows
            held += np.bincount(count.counts(part.column("text").to_pylist())[1], minlength=count.size)
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int64()), pa.array(np.append(held[at], n), pa.int64())], names=["term", "n"])

    held = bounded_batches(docs.select("text")).mapInArrow(frequencies, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    known_term = held["term"].to_numpy() >= 0
    total = int(held["n"].to_numpy()[~known_term].sum())
    seen = np.zeros(len(terms))
    seen[held["term"].to_numpy()[known_term]] = held["n"].to_numpy()[known_term]
    idf = np.log((1 + total) / (1 + seen)) + 1

    def term_counts(batches):
        count = TermCounter(shared.value)
        for part in slices(batches):
            found = count.arrays(part.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), pa.array([at.astype(np.int32) for at, _ in found], pa.list_(pa.int32())),
                 pa.array([n.astype(np.int32) for _, n in found], pa.list_(pa.int32()))], names=["doc_id", "at", "n"])

    rows = bounded_batches(examples).mapInArrow(term_counts, "doc_id long, at array<int>, n array<int>").limit(8 * per_label).toArrow().combine_chunks()
    shared.destroy()
    found: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for i, at, n in zip(rows["doc_id"].to_pylist(), rows["at"], rows["n"], strict=True):
        new = at.values.to_numpy(zero_copy_only=False), n.values.to_numpy(zero_copy_only=False)
        if i not in found or [x.tolist() for x in found[i]] < [x.tolist() for x in new]:  # of rows that share a doc_id, one
            found[i] = new
    with_terms = sorted(i for i, (at, _) in found.items() if len(at))
    bare = [label[i] for i, (at, _) in found.items() if not len(at)]
    none = float((sum(bare) * all1 / n1 + 0.01) / (sum(bare) * all1 / n1 + (len(bare) - sum(bare)) * all0 / n0 + 1))
    y = {i: float(label[i]) for i in with_terms}

    def vectors_of(floor: float) -> tuple[np.ndarray, dict[int, tuple[np.ndarray, np.ndarray]]]:
        weight = (floor + association) * idf
        return weight, {i: unit(found[i][0], found[i][1].astype(float), weight) for i in with_terms}

    def model_of(weight: np.ndarray, vectors: dict[int, tuple[np.ndarray, np.ndarray]], ids: list[int], slope: float, offset: float) -> ToxicityModel:
        index = BlockMaxIndex.of([vectors[i] for i in ids], len(terms))
        return ToxicityModel(terms, weight, index, np.array(ids, np.int64), np.array([y[i] for i in ids]), rate, slope, offset, none)

    def voted(floor: float) -> tuple[float, float, list[int], float, float]:
        """(log loss of the calibrated leave-one-out votes, floor, order of the examples, slope, offset); the index goes."""
        weight, vectors = vectors_of(floor)
        ids = [with_terms[k] for k in arranged([vectors[i] for i in with_terms])]
        model = model_of(weight, vectors, ids, 0.0, float(np.log((rate + 1e-6) / (1 - rate + 1e-6))))
        truth, index = model.toxic, model.index
        if len(set(truth.tolist())) < 2:
            return 0.0, floor, ids, model.slope, model.offset
        stands_for = np.where(truth == 1, all1 / n1, all0 / n0)  # labelled rows that an example was drawn from
        votes = [model.vote(*index.nearest(*vectors[i], NEIGHBOURS, skip=at + row, base=base)) for at in range(0, len(ids), 256)
                 for row, (i, base) in enumerate(zip(ids[at:at + 256], index.of_common([vectors[i] for i in ids[at:at + 256]]), strict=True))]
        model.slope, model.offset = logistic(np.array(votes), truth, stands_for)
        p = np.clip([model.calibrated(v) for v in votes], 1e-9, 1 - 1e-9)
        return float(-(stands_for * np.where(truth == 1, np.log(p), np.log(1 - p))).sum()), floor, ids, model.slope, model.offset

    _, floor, *fitted = min(map(voted, FLOORS), key=lambda x: x[0])
    return model_of(*vectors_of(floor), *fitted)


def scores(docs: DataFrame, model: ToxicityModel, threshold: float = 0.7) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, held_out, score, predicted, evidence.

    ``evidence`` are the doc_ids of up to three nearest toxic examples with
    their cosines. Texts without any word or stem of an example, null and empty
    ones among them, get the rate of such examples. A null doc_id is not held out.
    Other columns are not read; repeated rows score alike.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # terms and postings of at most 4 * PER_LABEL examples

    def run(batches):
        m = shared.value
        count = TermCounter(m.terms)
        for part in slices(batches):
            found = list(m.scores(count.arrays(part.column("text").to_pylist())))
            score = [s for s, _, _ in found]
            evidence = [[{"doc_id": int(m.doc_ids[i]), "cosine": float(c)} for i, c in zip(ids, cos, strict=True) if m.toxic[i]][:3] for _, ids, cos in found]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), part.column("held_out"), pa.array(score, pa.float64()), pa.array([int(s >= threshold) for s in score], pa.int32()),
                 pa.array(evidence, pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64())])))],
                names=["doc_id", "held_out", "score", "predicted", "evidence"])

    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    return bounded_batches(rows).mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int, evidence array<struct<doc_id:long,cosine:double>>")
