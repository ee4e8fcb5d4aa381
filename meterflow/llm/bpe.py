"""Byte-level BPE encoding and decoding with a minimal transducer lexicon (operator 2).

Frequent words of the corpus and their ids are compiled into a minimal acyclic
automaton: words share prefixes and suffixes, and the counts on its edges sum
to the rank of a word, under which its ids stand. The automaton is one array
of integers in a file of the shared folder; Spark brings the file to every
executor and the workers memory-map it. Words outside it are merged exactly,
many at once. So the lexicon decides the speed only, never the ids. Workers
handle the distinct words of a slice of texts as arrays, never one by one.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.llm.scratch import bounded_batches, new_path
from meterflow.llm.texts import buffer, slices

LEXICON_WORDS = 1 << 16
COUNTED = 400_000  # words that a worker counts before it passes counts on
LONG = 200  # bytes from which a word is merged by itself
NONE = np.int64(1 << 40)
NOTHING, SPACE = pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string())
# blanks are Unicode White_Space, as in the library (Python's \s has x1C-x1F besides)
BLANK = r"\t-\r \x85\xa0  -     　"
SPLIT_RUN = rf"[{BLANK}] (?:[{BLANK}]|\z)"  # for Arrow
CHUNK = regex.compile(rf" ?[^{BLANK}]+|[{BLANK}]+(?![^{BLANK}])|[{BLANK}]+", regex.V0)
#: The public pre-tokenisation pattern of the byte-level tokenizer (a fixed value).
WORD = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{BLANK}\p{{L}}\p{{N}}]+|[{BLANK}]+(?![^{BLANK}])|[{BLANK}]+", regex.V0)


@cache
def classes() -> np.ndarray:
    """Of every code point: 0 for a blank, 1 for a letter, 2 for a number, 3 for others."""
    out = np.full(0x110000, 3, np.uint8)
    shown = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for k, c in enumerate((f"[{BLANK}]", r"\p{L}", r"\p{N}")):
        out[np.frombuffer("".join(regex.findall(c, shown, regex.V0)).encode("utf-32-le"), np.uint32)] = k
    return out


def spread(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Positions of the parts that begin at ``first`` and have ``size`` entries, one part after the other."""
    end = np.cumsum(size)
    return np.arange(end[-1] if len(end) else 0) + np.repeat(first - (end - size), size)


def cut_words(units: pa.Array, whole: pa.Array | None = None) -> tuple[pa.Array, np.ndarray]:
    """(words, how many of each unit): what ``WORD`` finds in every unit, for all units at once.

    Units that stand in ``whole`` are words.
    """
    data, offsets = buffer(units)
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    n = len(points)
    stop = np.concatenate([[0], np.cumsum(1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000))])
    unit = np.searchsorted(stop, offsets)
    kind = classes()[points]
    edge = np.zeros(n + 3, bool)
    edge[unit] = True
    begin = edge.copy()
    begin[1:n] |= kind[1:] != kind[:-1]
    # of blanks before something else the last one stands by itself, or goes with it if it is a space
    last = np.flatnonzero((kind[:-1] == 0) & (kind[1:] != 0) & ~edge[1:n]) if n else np.zeros(0, np.int64)
    begin[last] = True
    begin[last[points[last] == 32] + 1] = False
    at = np.flatnonzero((points == 39) & begin[:n])  # a word that starts with ' may be a contraction
    after = np.concatenate([points, [0, 0]])
    a, b = after[at + 1], after[at + 2]
    size = np.where(np.isin(a, [*b"stmd"]), 1, np.where(((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l")), 2, 0))
    size[edge[at + 1] | (size == 2) & edge[at + 2]] = 0
    at, size = at[size > 0], size[size > 0]
    begin[at + 1] = False
    begin[at + 1 + size] = True
    if whole is not None:
        for i in np.flatnonzero(pc.is_in(units, value_set=whole).to_numpy(zero_copy_only=False)).tolist():
            begin[unit[i] + 1:unit[i + 1]] = False
    begin = begin[:n]
    ends = np.concatenate([stop[:-1][begin], stop[-1:]])
    words = pa.LargeStringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends), pa.py_buffer(data.tobytes()))
    return words, np.diff(np.concatenate([[0], np.cumsum(begin)])[unit])


def byte_chars() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + others.index(b)) for b in range(256)]


def joined(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, lengths) of ``words``, one after the other."""
    return np.frombuffer(b"".join(words), np.uint8), np.fromiter(map(len, words), np.int64, len(words))


@dataclass
class Vocabulary:
    """What a tokenizer file says, as arrays (some 50,000 entries)."""

    token_bytes: list[bytes]
    first_ids: np.ndarray  # of the 256 bytes
    slots: np.ndarray  # hash table of merges: left << 32 | right
    ranks: np.ndarray
    results: np.ndarray  # by rank
    probes: int
    specials: dict[str, int] = field(default_factory=dict)

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        chars = byte_chars()
        of = {c: b for b, c in enumerate(chars)}
        vocab = data["model"]["vocab"]
        specials = {t["content"]: t["id"] for t in data["added_tokens"]}
        token_bytes = [b""] * (1 + max([*vocab.values(), *specials.values()]))
        for token, i in vocab.items():
            token_bytes[i] = bytes(of[c] for c in token)
        for token, i in specials.items():
            token_bytes[i] = token.encode()
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in data["model"]["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in merges], np.int64)
        size = 1 << 18
        slots, ranks, probes = np.full(size, -1, np.int64), np.zeros(size, np.int64), 1
        for rank, (key, at) in enumerate(zip(keys.tolist(), cls.place(keys).tolist(), strict=True)):
            n = 1
            while slots[at] >= 0 and slots[at] != key:
                at, n = (at + 1) % size, n + 1
            if slots[at] < 0:  # of equal merges the first counts
                slots[at], ranks[at] = key, rank
            probes = max(probes, n)
        return cls(token_bytes, np.array([vocab[c] for c in chars], np.int64), slots, ranks,
                   np.array([vocab[a + b] for a, b in merges], np.int64), probes, specials)

    @staticmethod
    def place(keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(46)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids, NONE where they don't merge."""
        keys = left << 32 | right
        at, out = self.place(keys), np.full(len(keys), NONE, np.int64)
        rest = np.arange(len(keys))
        for _ in range(self.probes):
            here = self.slots[at[rest]]
            hit = here == keys[rest]
            out[rest[hit]] = self.ranks[at[rest[hit]]]
            rest = rest[~hit & (here >= 0)]
            if not len(rest):
                break
            at[rest] = (at[rest] + 1) % len(self.slots)
        return out

    def merge_one(self, word: bytes) -> list[int]:
        """Merges of one word from a heap of pairs: for long words."""
        ids = self.first_ids[np.frombuffer(word, np.uint8)].tolist()
        pair = {int(k): int(r) for k, r in zip(self.slots, self.ranks, strict=True) if k >= 0} if not hasattr(self, "_pair") else self._pair
        self._pair = pair
        nxt, prev, n = [*range(1, len(ids)), -1], [*range(-1, len(ids) - 1)], len(ids)
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := pair.get(ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = nxt[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j], nxt[i] = int(self.results[r]), -1, nxt[j]
            if nxt[j] >= 0:
                prev[nxt[j]] = i
            for x, y in ((prev[i], i), (i, nxt[i])):
                if x >= 0 and y >= 0 and (r := pair.get(ids[x] << 32 | ids[y])) is not None:
                    heapq.heappush(heap, (r, x, ids[x], ids[y]))
        return [x for x in ids if x >= 0]

    def merge(self, words: list[bytes]) -> list[list[int]]:
        """Ids of each word."""
        n, ids = self.merge_all(*joined(words))
        flat, stops = ids.tolist(), np.cumsum(n).tolist()
        return [flat[a:b] for a, b in zip([0, *stops], stops)]

    def merge_all(self, data: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of ids, ids) of words that stand in ``data`` one after the other.

        All words are merged at once, each by its own pair of least rank.
        """
        short = length < LONG
        ids = self.first_ids[data[np.repeat(short, length)]]
        word = np.repeat(np.flatnonzero(short), length[short])
        rank = np.full(len(ids), NONE, np.int64)
        inside = np.flatnonzero(word[1:] == word[:-1])
        rank[inside] = self.rank(ids[inside], ids[inside + 1])
        done_ids, done_word = [], []
        end = np.cumsum(length)
        for i in np.flatnonzero(~short).tolist():
            done_ids.append(np.array(self.merge_one(data[end[i] - length[i]:end[i]].tobytes()), np.int64))
            done_word.append(np.full(len(done_ids[-1]), i))
        while len(ids):
            start = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            size = np.diff(start, append=len(ids))
            least = np.repeat(np.minimum.reduceat(rank, start), size)
            over = least == NONE
            if over.any():
                done_ids.append(ids[over])
                done_word.append(word[over])
                ids, word, rank, least = ids[~over], word[~over], rank[~over], least[~over]
                if not len(ids):
                    break
            hit = rank == least
            if (hit[1:] & hit[:-1]).any():  # x x x: every second one, from the left
                at = np.arange(len(hit))
                begin = np.maximum.accumulate(np.where(hit & ~np.concatenate([[False], hit[:-1]]), at, -1))
                hit &= (at - begin) % 2 == 0
            at = np.flatnonzero(hit)
            ids[at] = self.results[rank[at]]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            place = np.cumsum(keep) - 1
            ids, word, rank, at = ids[keep], word[keep], rank[keep], place[at]
            near = np.zeros(len(ids) + 1, bool)
            near[at] = near[at - 1] = True  # what stands before the first goes to the spare end
            new = np.flatnonzero(near[:-1])
            rank[new] = NONE
            new = new[new + 1 < len(ids)]
            new = new[word[new] == word[new + 1]]
            rank[new] = self.rank(ids[new], ids[new + 1])
        if not done_ids:
            return np.zeros(len(length), np.int64), ids
        ids, word = np.concatenate(done_ids), np.concatenate(done_word)
        return np.bincount(word, minlength=len(length)), ids[np.argsort(word, kind="stable")]

    def decode(self, ids) -> str:
        """Text of ids; bytes that are no UTF-8 become U+FFFD, special tokens their own text."""
        return b"".join(map(self.token_bytes.__getitem__, ids)).decode("utf-8", "replace")


def compile_lexicon(words: list[bytes], ids: list[list[int]]) -> np.ndarray:
    """The minimal automaton of ``words`` (any order, distinct) with their ids, as one array.

    Built incrementally over the sorted words: the part of a word that the next
    one doesn't share is replaced by equal states met before. Layout: sizes of
    the five parts, then edge keys (state << 8 | byte, ascending), edge
    targets, words passed by an edge, first id of each word, all ids.
    """
    order = sorted(range(len(words)), key=words.__getitem__)
    edges: list[dict[int, int]] = [{}]
    final, known = [False], {}
    path, last = [0], b""

    def settle(keep: int) -> None:
        while len(path) > keep + 1:
            state = path.pop()
            mark = (final[state], tuple(edges[state].items()))
            same = known.setdefault(mark, state)
            edges[path[-1]][last[len(path) - 1]] = same

    for i in order:
        word, shared = words[i], 0
        while shared < min(len(word), len(last)) and word[shared] == last[shared]:
            shared += 1
        settle(shared)
        last = word
        for b in word[shared:]:
            edges.append({})
            final.append(False)
            edges[path[-1]][b] = len(edges) - 1
            path.append(len(edges) - 1)
        final[path[-1]] = True
    settle(0)
    names, stack, below = {0: 0}, [0], {}
    while stack:  # the states that are left, numbered as met
        for to in edges[stack.pop()].values():
            if to not in names:
                names[to] = len(names)
                stack.append(to)

    def count(root: int) -> None:
        todo = [root]
        while todo:
            s = todo[-1]
            open_ = [t for t in edges[s].values() if t not in below]
            if open_:
                todo += open_
            else:
                below[s] = final[s] + sum(below[t] for t in edges[s].values())
                todo.pop()

    count(0)
    rows = []
    for s, name in names.items():
        passed = int(final[s])
        for b in sorted(edges[s]):
            to = edges[s][b]
            rows.append((name << 8 | b, names[to] << 1 | final[to], passed))
            passed += below[to]
    table = np.array(sorted(rows), np.int64).reshape(-1, 3)
    lists = [ids[i] for i in order]
    first = np.cumsum([0, *map(len, lists)])
    flat = np.fromiter(chain.from_iterable(lists), np.int64, int(first[-1]))
    parts = [table[:, 0], table[:, 1], table[:, 2], first, flat]
    return np.concatenate([[len(p) for p in parts], *parts]).astype(np.int64)


class Lexicon:
    """Lookups in a compiled lexicon (an array, or the path of its file, which is memory-mapped)."""

    def __init__(self, source):
        data = source if isinstance(source, np.ndarray) else np.memmap(source, np.int64, "r")
        ends = np.cumsum(data[:5]) + 5
        self.keys, self.targets, self.passed, self.first, self.ids = (data[a:b] for a, b in zip([5, *ends[:-1]], ends, strict=True))

    def find(self, words: list[bytes]) -> np.ndarray:
        """Rank of each word, -1 for words outside."""
        return self.find_all(*joined(words))

    def find_all(self, data: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The same for words that stand in ``data`` one after the other."""
        rank = np.zeros(len(length), np.int64)
        if not len(self.keys):
            return rank - 1
        begin = np.cumsum(length) - length
        state, alive = np.zeros(len(length), np.int64), length > 0
        here = np.flatnonzero(alive)
        at = 0
        while len(here):
            keys = (state[here] >> 1) << 8 | data[begin[here] + at]
            j = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            ok = self.keys[j] == keys
            alive[here[~ok]] = False
            here, j = here[ok], j[ok]
            state[here] = self.targets[j]
            rank[here] += self.passed[j]
            at += 1
            here = here[length[here] > at]
        return np.where(alive & (state & 1 == 1), rank, -1)

    def ids_of(self, ranks: np.ndarray) -> list[tuple[int, ...]]:
        """Ids of the words with these ranks."""
        first, size = self.first[ranks], self.first[ranks + 1] - self.first[ranks]
        flat, stops = self.ids[spread(first, size)].tolist(), np.cumsum(size).tolist()
        return [tuple(flat[a:b]) for a, b in zip([0, *stops], stops)]


class Encoder:
    """Ids of texts: Arrow numbers their distinct words, the lexicon or exact merging gives the ids of each."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon | None = None):
        self.vocabulary, self.lexicon = vocabulary, lexicon
        self.specials = pa.array(list(vocabulary.specials), pa.large_string())
        self.special_ids = np.array(list(vocabulary.specials.values()), np.int64)
        self.split = regex.compile("(" + "|".join(map(regex.escape, sorted(vocabulary.specials, key=len, reverse=True))) + ")") if vocabulary.specials else None

    def odd(self, texts: pa.Array) -> np.ndarray:
        """Which texts can't be cut at every space.

        Only a run of blanks that holds a space in its midst or at the end of
        the text spans several parts; a special token is a part of its own.
        """
        out = pc.match_substring_regex(texts, SPLIT_RUN)
        for s in self.specials.to_pylist():
            out = pc.or_(out, pc.match_substring(texts, s))
        return out.to_numpy(zero_copy_only=False)

    def parts(self, text: str) -> list[str]:
        """Units of a text that can't be cut at every space."""
        parts = [text] if self.split is None else self.split.split(text)
        return [u for k, part in enumerate(parts) for u in ([part] if k % 2 else CHUNK.findall(part))]

    def units(self, texts: pa.Array, odd: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """Parts of texts whose words don't depend on their neighbours: (distinct parts, which
        of them stand in the texts, how many in each text), odd texts last."""
        spaced = pc.split_pattern(texts.filter(pa.array(~odd)), " ")  # the space before a part belongs to it
        others = [self.parts(t) for t in texts.filter(pa.array(odd)).to_pylist()]
        size = np.concatenate([pc.list_value_length(spaced).to_numpy(), np.fromiter(map(len, others), np.int64, len(others))]).astype(np.int64)
        parts = pa.concat_arrays([spaced.flatten(), pa.array(list(chain.from_iterable(others)), pa.large_string())])
        whole = np.zeros(len(parts), bool)
        whole[(np.cumsum(size) - size)[:len(spaced)]] = True
        whole[size[:len(spaced)].sum():] = True
        coded = parts.dictionary_encode()
        code = coded.indices.to_numpy().astype(np.int64) * 2 + whole
        seen = np.zeros(2 * len(coded.dictionary), bool)
        seen[code] = True
        distinct = np.flatnonzero(seen)
        before = pc.if_else(pa.array(distinct % 2 == 1), NOTHING, SPACE)
        return pc.binary_join_element_wise(before, coded.dictionary.take(pa.array(distinct >> 1)), NOTHING), (np.cumsum(seen) - 1)[code], size

    def words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, where those of each word begin there, how many they are) for distinct words."""
        data, offsets = buffer(words)
        length = np.diff(offsets)
        first, n, ids = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64), np.zeros(0, np.int64)
        rank = np.full(len(words), -1)
        if self.lexicon is not None:
            rank = self.lexicon.find_all(data, length)
            known = rank >= 0
            first[known], n[known], ids = self.lexicon.first[rank[known]], np.diff(self.lexicon.first)[rank[known]], self.lexicon.ids
        rest = rank < 0
        n[rest], more = self.vocabulary.merge_all(data[np.repeat(rest, length)], length[rest])
        first[rest] = len(ids) + np.cumsum(n[rest]) - n[rest]
        special = pc.index_in(words, value_set=self.specials)
        at = special.is_valid().to_numpy(zero_copy_only=False)
        first[at], n[at] = len(ids) + len(more) + special.drop_null().to_numpy(), 1
        return np.concatenate([ids, more, self.special_ids]), first, n

    def encode_column(self, texts: pa.Array) -> pa.Array:
        """Lists of ids of a column of texts without nulls."""
        texts = texts.cast(pa.large_string())
        odd = self.odd(texts)
        units, unit, size = self.units(texts, odd)
        words, per_unit = cut_words(units, self.specials)
        coded = words.dictionary_encode()
        ids, first, n = self.words(coded.dictionary)
        word = coded.indices.to_numpy()
        # ids of the distinct units, then of the texts
        ids, stop = ids[spread(first[word], n[word])].astype(np.int32), np.concatenate([[0], np.cumsum(n[word])])
        stop = stop[np.concatenate([[0], np.cumsum(per_unit)])]
        first, n = stop[:-1], np.diff(stop)
        n = n[unit]
        stop = np.concatenate([[0], np.cumsum(n)])[np.concatenate([[0], np.cumsum(size)])]
        out = pa.LargeListArray.from_arrays(pa.array(stop), pa.array(ids[spread(first[unit], n)]))
        return out.take(pa.array(np.argsort(np.argsort(odd, kind="stable")))) if odd.any() else out

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.encode_column(pa.array(texts, pa.large_string())).to_pylist()


_LAST: dict[str, Encoder] = {}


def worker_encoder(name: str, vocabulary) -> Encoder:
    """The encoder of this worker process for the lexicon file ``name``; later tasks find it again."""
    if name not in _LAST:
        _LAST.clear()
        _LAST[name] = Encoder(vocabulary.value, Lexicon(SparkFiles.get(name)))
    return _LAST[name]


def frequent_words(docs: DataFrame, limit: int) -> list[str]:
    """The words of fewer than ``LONG`` bytes with the highest counts over all texts, at most ``limit``.

    A worker adds up what stands between spaces and passes on what it saw
    twice or more; a word that no task sees twice is not frequent. The words
    that start a text are counted as if a space stood before them.
    """
    def added(tables):
        return pa.concat_tables(tables).group_by("unit", use_threads=False).aggregate([("n", "sum")]).rename_columns(["unit", "n"])

    def out(units):
        units = units.filter(pc.greater(units["n"], 1)).combine_chunks()
        text = pc.binary_join_element_wise(SPACE, units["unit"], NOTHING).combine_chunks()
        words, per_unit = cut_words(text)
        coded = words.dictionary_encode()
        n = np.zeros(len(coded.dictionary), np.int64)
        np.add.at(n, coded.indices.to_numpy(), np.repeat(units["n"].to_numpy(), per_unit))
        return pa.RecordBatch.from_arrays([coded.dictionary.cast(pa.string()), pa.array(n)], names=["word", "n"])

    def run(batches):
        tables, rows = [], 0
        for part in slices(batches):
            counted = pc.split_pattern(part.column("text").cast(pa.large_string()).fill_null(""), " ").flatten().value_counts()
            tables.append(pa.table({"unit": counted.field("values"), "n": counted.field("counts")}))
            rows += len(counted)
            if rows > 2 * COUNTED:
                tables = [added(tables)]
                rows = len(tables[0])
                if rows > COUNTED:
                    yield out(tables[0])
                    tables, rows = [], 0
        if tables:
            yield out(added(tables))

    counts = bounded_batches(docs.select("text")).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return [r.word for r in counts.filter(F.octet_length("word") < LONG).orderBy(F.desc("n"), "word").limit(limit).collect()]


def shared_file(spark, data: bytes, name: str) -> str:
    """Write ``data`` to the shared folder and have Spark bring it to every executor; its name there."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(new_path(spark, name))
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    to = fs.create(path)
    to.write(bytearray(data))
    to.close()
    spark.sparkContext.addFile(fs.makeQualified(path).toString())
    return path.getName()


def prepared(docs: DataFrame, path: str, words: int = LEXICON_WORDS):
    """(broadcast vocabulary, name of the lexicon file) for ``docs``."""
    spark = docs.sparkSession
    vocabulary = Vocabulary.load(path)
    frequent = frequent_words(docs, words)
    raw = [w.encode() for w in frequent]
    data = compile_lexicon(raw, vocabulary.merge(raw))
    return spark.sparkContext.broadcast(vocabulary), shared_file(spark, data.tobytes(), "lexicon")


def in_a_row(shown: pa.Array, ids: pa.LargeListArray) -> Iterator[bytes]:
    """What ``shown`` has for the ids of each list, one after the other."""
    data, offsets = buffer(shown.take(ids.flatten()).view(pa.large_string()))
    stops = offsets[np.cumsum(pc.list_value_length(ids).to_numpy())].tolist()
    for a, b in zip([0, *stops], stops):
        yield data[a:b].tobytes()


def encoded(docs: DataFrame, path: str, words: int = LEXICON_WORDS, with_ids: bool = True) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, ids (if ``with_ids``), n_tokens,
    ids_sha256 (of the decimal ids joined by commas), decoded_sha256 (of the decoded text).

    Ids are those of the tokenizers library for the file at ``path`` without
    added special tokens; a special token's own text gets its id, as there.
    Null and empty texts have no ids. Repeated rows and null doc_ids are
    carried through; other columns are ignored.
    """
    vocabulary, name = prepared(docs, path, words)

    def run(batches):
        encoder = worker_encoder(name, vocabulary)
        shown = pa.array([f"{i}," for i in range(len(encoder.vocabulary.token_bytes))], pa.large_string())
        token_bytes = pa.array(encoder.vocabulary.token_bytes, pa.large_binary())
        for part in slices(batches):
            ids = encoder.encode_column(part.column("text").fill_null(""))
            n = pc.list_value_length(ids)
            columns = [part.column("doc_id").cast(pa.int64()), n.cast(pa.int64()),
                       pa.array([sha256(x[:-1]).hexdigest() for x in in_a_row(shown, ids)], pa.string()),
                       pa.array([sha256(x.decode("utf-8", "replace").encode()).hexdigest() for x in in_a_row(token_bytes, ids)], pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns.append(ids.cast(pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return bounded_batches(docs.select("doc_id", "text")).mapInArrow(run, schema + ", ids array<int>" * with_ids)


def decoded(rows: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); null ids give a null text."""
    vocabulary = rows.sparkSession.sparkContext.broadcast(Vocabulary.load(path))

    def run(batches):
        for part in batches:
            texts = [None if x is None else vocabulary.value.decode(x) for x in part.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return rows.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
