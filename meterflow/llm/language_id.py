"""Language identification (operator 3).

A text is the average of the embeddings of its hashed subwords (byte n-grams
of its lower-cased words, word edges marked), followed by a linear softmax.
Both are trained together by stochastic gradient descent in numpy on a bounded
sample; a held-back part of the sample, its short pieces, and pieces with
their letters in random order set the temperature and the shrinkage of short
texts that calibrate the probabilities, and the threshold under which a
prediction is not accepted.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.llm.scratch import bounded_batches
from meterflow.llm.texts import U64, mix, slices

BUCKETS = 1 << 15
WIDTH = 16
GRAMS = (2, 3, 4)
PER_LANGUAGE = 600  # examples of each language, chosen by hash; a fifth calibrates
SHRINK = (10, 50, 200, 800)  # n-grams without evidence that stand beside a text's own, so short texts stay unsure; calibration picks one
PIECES = (1, 2, 4, 8, 16)  # words of the short pieces that calibrate besides whole texts
ACCEPTED = 0.995  # accuracy that accepted predictions shall reach on the calibration part
LETTER = regex.compile(r"\p{L}")
FOLD = np.full(256, 32, np.uint8)  # letters stay, all else is a word edge
FOLD[97:123] = np.arange(97, 123)
FOLD[128:] = np.arange(128, 256)


def subwords(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, row) of every n-gram that lies within a word and its two edges."""
    raw = [b" " + t.lower().encode() + b" " for t in texts]
    data = FOLD[np.frombuffer(b"".join(raw), np.uint8)]
    row = np.repeat(np.arange(len(raw)), [len(r) for r in raw])
    edge = data == 32
    buckets, rows = [], []
    for n in GRAMS:
        m = len(data) - n + 1
        if m <= 0:
            continue
        value = np.full(m, n, U64)
        inner = np.zeros(m, bool)
        for j in range(n):
            value = value << U64(8) | data[j:j + m]
            if 0 < j < n - 1:
                inner |= edge[j:j + m]
        inner |= (edge[:m] & edge[n - 1:] if n == 2 else False) | (row[:m] != row[n - 1:])
        keep = ~inner
        buckets.append((mix(value[keep]) % U64(BUCKETS)).astype(np.int64))
        rows.append(row[:m][keep])
    return np.concatenate(buckets) if buckets else np.zeros(0, np.int64), np.concatenate(rows) if rows else np.zeros(0, np.int64)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


@dataclass
class LanguageModel:
    languages: list[str]
    table: np.ndarray  # bucket -> logits: embedding times softmax weights
    bias: np.ndarray
    temperature: float
    shrink: float
    threshold: float

    def probabilities(self, texts: list[str]) -> np.ndarray:
        bucket, row = subwords(texts)
        n = np.bincount(row, minlength=len(texts))
        logits = np.stack([np.bincount(row, weights=self.table[bucket, k], minlength=len(texts)) for k in range(len(self.languages))], axis=1)
        return softmax((logits / (n + self.shrink)[:, None] + self.bias) / self.temperature)


def train(examples: list[tuple[np.ndarray, np.ndarray]], label: np.ndarray, classes: int, epochs: int = 12, seed: int = 5):
    """(embeddings, weights, bias) by gradient descent; an example is (buckets, shares)."""
    rng = np.random.default_rng(seed)
    emb, w, b = rng.normal(0, 0.1, (BUCKETS, WIDTH)), rng.normal(0, 0.1, (WIDTH, classes)), np.zeros(classes)
    for epoch in range(epochs):
        rate = 1.0 * (1 - epoch / epochs) + 0.05
        for i in rng.permutation(len(examples)):
            at, share = examples[i]
            h = share @ emb[at]
            g = softmax(h @ w + b)
            g[label[i]] -= 1
            back = w @ g
            w -= rate * np.outer(h, g)
            b -= 0.1 * rate * g
            emb[at] -= 10 * rate * share[:, None] * back
    return emb, w, b


def pieces(text: str, seed: int) -> list[tuple[bool, str]]:
    """Short runs of words of a text, each as it stands and with its letters in random order (True: a reject)."""
    rng, words, out = np.random.default_rng(seed), text.split(), []
    for n in PIECES:
        if len(words) > n:
            at = int(rng.integers(len(words) - n))
            run = words[at:at + n]
            letters = list("".join(run))
            rng.shuffle(letters)
            cut = np.cumsum([0, *map(len, run)])
            out += [(False, " ".join(run)), (True, " ".join("".join(letters[i:j]) for i, j in zip(cut, cut[1:], strict=False)))]
    return out


def calibrate(logits: np.ndarray, n: np.ndarray, bias: np.ndarray, label: np.ndarray) -> tuple[float, float, float]:
    """(temperature, shrinkage, threshold from which predictions are ACCEPTED) for mean logits of ``n`` n-grams
    and a ``bias``; label -1 is a reject, which no language is right for.

    The first two have the least log loss, rejects against all languages
    alike, with a prior of the temperature around 1 that counts as ten texts.
    """
    if not len(label):
        return 1.0, float(SHRINK[0]), 0.0
    known = label >= 0

    def scaled(t, shrink):
        return softmax((logits * (n / (n + shrink))[:, None] + bias) / t)

    def loss(x):
        p = np.log(np.maximum(scaled(*x), 1e-12))
        return -p[known, label[known]].sum() - p[~known].mean(axis=1).sum() + 10 * np.log(x[0]) ** 2

    temperature, shrink = min(((t, s) for s in SHRINK for t in np.geomspace(0.02, 20, 60)), key=loss)
    p = scaled(temperature, shrink)
    best, right = p.max(axis=1), p.argmax(axis=1) == label
    order = np.argsort(-best, kind="stable")
    share = np.cumsum(right[order]) / np.arange(1, len(order) + 1)
    last = np.append(best[order][1:] < best[order][:-1], True)  # equal scores are accepted together
    good = np.flatnonzero((share >= ACCEPTED) & last)
    return float(temperature), float(shrink), float(best[order[good[-1]]]) if len(good) else 1.0


def held_out(doc_id="doc_id"):
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, seed: int = 21) -> LanguageModel:
    """Learns from text and lang of the rows that are not held out and have a language."""
    learn = docs.select("doc_id", "text", "lang").filter(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r.lang: r["count"] for r in learn.groupBy("lang").count().collect()}  # one row for each language
    languages = sorted(counts)
    if not languages:
        return LanguageModel(["und"], np.zeros((BUCKETS, 1)), np.zeros(1), 1.0, 1.0, 1.0)
    share = F.create_map(*(F.lit(x) for lang in languages for x in (lang, min(1.0, per_language / counts[lang]))))
    draw = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text"), F.lit(1 << 30)) < share[F.col("lang")] * (1 << 30)

    def examples(batches):
        for batch in slices(batches):
            rows = [(lang, part, 0, t) for lang, part, t in zip(*(batch.column(c).to_pylist() for c in ("lang", "part", "text")), strict=True)]
            rows += [(lang, part, 1 + reject, t) for lang, part, _, text in rows if part < 200 for reject, t in pieces(text, part)]
            langs, parts, kinds, texts = map(list, zip(*rows, strict=True))
            bucket, row = subwords(texts)
            at, x = [], []
            for mine in np.split(bucket, np.cumsum(np.bincount(row, minlength=len(texts)))[:-1]) if (np.diff(row) >= 0).all() else (bucket[row == i] for i in range(len(texts))):
                f, c = np.unique(mine, return_counts=True)
                at.append(f.astype(np.int32))
                x.append((c / max(len(mine), 1)).astype(np.float32))
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(parts, pa.int64()), pa.array(kinds, pa.int32()), pa.array(at, pa.list_(pa.int32())),
                                              pa.array(x, pa.list_(pa.float32())), pa.array(np.bincount(row, minlength=len(texts)))],
                                             names=["lang", "part", "kind", "at", "x", "n"])

    key = F.xxhash64(F.lit(seed + 1), "doc_id", "text")
    chosen = learn.filter(draw).select("lang", F.pmod(key, F.lit(1000)).alias("part"), "text", key.alias("key")).dropDuplicates(["lang", "key"])  # repeated rows once
    each = 2 + len(PIECES)  # a fifth of the texts come with pieces; the bound is never met in practice
    rows = (bounded_batches(chosen.select("lang", "part", "text")).mapInArrow(examples, "lang string, part long, kind int, at array<int>, x array<float>, n long")
            .filter("size(at) > 0").limit(each * per_language * len(languages)).toArrow())
    at, x = rows.column("at").combine_chunks(), rows.column("x").combine_chunks()
    found = sorted(((languages.index(lang), part, np.asarray(a.values), np.asarray(b.values), kind, n) for lang, part, kind, n, a, b in
                    zip(*(rows.column(c).to_pylist() for c in ("lang", "part", "kind", "n")), at, x, strict=True)),
                   key=lambda r: (r[1], r[4], r[0], r[5], len(r[2]), r[2].tobytes(), r[3].tobytes()))
    del rows
    hold = [r for r in found if r[1] < 200]
    learned = [r for r in found if r[1] >= 200] or [r for r in hold if r[4] == 0]
    emb, w, b = train([r[2:4] for r in learned], np.array([r[0] for r in learned], np.int64), len(languages))
    table = emb @ w
    logits = np.array([r[3] @ table[r[2]] for r in hold]).reshape(-1, len(languages))
    return LanguageModel(languages, table, b, *calibrate(logits, np.array([r[5] for r in hold], float), b,
                                                         np.array([r[0] if r[4] < 2 else -1 for r in hold], np.int64)))


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, held_out, lang_pred, score, accepted.

    ``score`` is the calibrated probability of ``lang_pred``; accepted: it
    reaches the model's threshold. A null text, or one without a letter, is
    ``und`` with score 0 and not accepted. A null doc_id is not held out.
    Other columns are not read; repeated rows are predicted alike.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS numbers for each language

    def run(batches):
        m = shared.value
        names = np.array(m.languages, object)
        for part in slices(batches):
            texts = [t or "" for t in part.column("text").to_pylist()]
            p = m.probabilities(texts)
            none = np.array([LETTER.search(t) is None for t in texts])
            lang, score = names[p.argmax(axis=1)], p.max(axis=1)
            lang[none], score[none] = "und", 0.0
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), part.column("held_out"), pa.array(lang, pa.string()), pa.array(score),
                 pa.array(~none & (score >= m.threshold))], names=["doc_id", "held_out", "lang_pred", "score", "accepted"])

    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    return bounded_batches(rows).mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, accepted boolean")
