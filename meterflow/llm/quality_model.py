"""Quality classifier from weak labels (operator 6).

Overlapping heuristic labellers vote good, bad or nothing on every document.
The corpus is grouped by vote pattern (at most 2 ** labellers rows, whatever
its size), and expectation-maximisation on these exact counts estimates how
often each labeller is right when it votes, and the share of good documents.
The posterior of a document's pattern is its soft label. On a bounded sample
of documents a hashed linear scorer learns these labels from word shapes, and
then scores every whole text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.llm.scratch import bounded_batches
from meterflow.llm.texts import U64, SPACE, buffer, mix, shingles, slices, word_hashes, word_starts

SAMPLE = 4000  # documents that the scorer is fitted on
DIM = 1 << 13
THRESHOLD = 0.2  # rejected below: a document must look bad, not merely unlike the best
ABSTAIN = 2
#: Shares that the labellers look at, per word or per character.
SHARES = ("symbols", "capitals", "stutter", "repeats", "shouts", "other", "signs")
#: name: (vote, {share: bound}); a labeller of bad votes where one share is at its bound or above,
#: a labeller of good where all are at theirs or below. Each kind of junk is seen by two labellers at least.
LABELLERS = {
    "symbols": (0, {"symbols": 0.25}),     # #*$%&|<> per word
    "capitals": (0, {"capitals": 0.6}),    # of ASCII letters
    "stutter": (0, {"stutter": 0.2}),      # words equal to the one before
    "repeats": (0, {"repeats": 0.4}),      # 3-word windows that the text holds already
    "shouts": (0, {"shouts": 0.4}),        # ! and ? per word
    "other": (0, {"other": 0.2, "signs": 0.15}),  # characters that are no letters or digits; words of one sign
    "calm": (1, {"symbols": 0.05, "shouts": 0.05}),
    "plain": (1, {"capitals": 0.3, "stutter": 0.05, "signs": 0.05}),
    "varied": (1, {"repeats": 0.15, "signs": 0.05, "other": 0.12}),
}
SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True
CLASS = np.zeros(256, np.uint8)  # of a byte, for word shapes; blanks stay blanks
CLASS[:] = ord("o")
CLASS[ord("a"):ord("z") + 1] = ord("a")
CLASS[ord("A"):ord("Z") + 1] = ord("A")
CLASS[ord("0"):ord("9") + 1] = ord("0")
CLASS[128:] = ord("a")
for _c in b".,;:'\"()-!?#*$%&|<>":
    CLASS[_c] = _c
CLASS[SPACE] = 32


def sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of set flags per row of a byte buffer."""
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[offsets[1:]] - total[offsets[:-1]]


def votes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(number of words, votes): votes are 1 good, 0 bad, 2 none; texts without words get none."""
    data, offsets = buffer(column)
    starts, row = word_starts(data, offsets)
    n = len(offsets) - 1
    words = np.bincount(row, minlength=n)
    hashes = word_hashes(data, starts, offsets)
    stutter = np.bincount(row[1:][(hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])], minlength=n)
    _, distinct, _ = shingles(column, 3)
    windows = np.maximum(words - 2, 1)
    kind = CLASS[data]
    upper, lower = sums(kind == ord("A"), offsets), sums((kind == ord("a")) & (data < 128), offsets)
    letters = upper + sums(kind == ord("a"), offsets)
    shown = sums(kind != 32, offsets)
    ends = np.minimum(starts + 1, max(len(data) - 1, 0))
    sign = (kind[starts] != ord("a")) & (kind[starts] != ord("A")) & (kind[starts] != ord("0"))
    alone = sign & ((kind[ends] == 32) | (ends == starts))
    per_word = np.maximum(words, 1)
    share = dict(zip(SHARES, (
        sums(SYMBOL[data], offsets) / per_word,
        upper / np.maximum(upper + lower, 1),
        stutter / per_word,
        1 - np.minimum(np.bincount(distinct, minlength=n) / windows, 1),
        sums((data == ord("!")) | (data == ord("?")), offsets) / per_word,
        1 - (letters + sums(kind == ord("0"), offsets)) / np.maximum(shown, 1),
        np.bincount(row[alone], minlength=n) / per_word), strict=True))
    vote = np.full((n, len(LABELLERS)), ABSTAIN)
    for j, (says, bounds) in enumerate(LABELLERS.values()):
        if says:
            vote[np.all([share[k] <= x for k, x in bounds.items()], axis=0), j] = 1
        else:
            vote[np.any([share[k] >= x for k, x in bounds.items()], axis=0), j] = 0
    vote[words == 0] = ABSTAIN
    return words, vote


def pattern(vote: np.ndarray) -> np.ndarray:
    return vote @ (3 ** np.arange(vote.shape[1]))


def unpack(codes: np.ndarray) -> np.ndarray:
    return codes[:, None] // 3 ** np.arange(len(LABELLERS)) % 3


@dataclass
class LabelModel:
    """P(good), and P(the labeller votes | class): row 0 for bad documents, row 1 for good ones."""

    prior: float
    votes: np.ndarray

    def posterior(self, vote: np.ndarray) -> np.ndarray:
        """P(good | votes). That a labeller stays silent counts too."""
        spoke = (vote != ABSTAIN).astype(float)
        like = spoke @ np.log(self.votes.T) + (1 - spoke) @ np.log(1 - self.votes.T)
        odds = np.log(self.prior / (1 - self.prior)) + like[:, 1] - like[:, 0]
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))

    def accuracy(self) -> np.ndarray:
        """P(the class is the one it names | it votes), for each labeller."""
        bad, good = self.votes[0] * (1 - self.prior), self.votes[1] * self.prior
        names_good = np.array([says == 1 for says, _ in LABELLERS.values()])
        return np.where(names_good, good, bad) / (good + bad)


def fit_label_model(codes: np.ndarray, counts: np.ndarray, rounds: int = 200) -> LabelModel:
    """EM. The start: three in ten documents of its class make a labeller of bad vote and nine
    in ten one of good; in the other class, one and thirty in a hundred (also ten pseudo-documents)."""
    vote, n = unpack(codes), counts.astype(float)
    spoke = (vote != ABSTAIN).astype(float)
    names_good = np.array([says == 1 for says, _ in LABELLERS.values()])
    start = np.stack([np.where(names_good, 0.3, 0.3), np.where(names_good, 0.9, 0.01)])
    model = LabelModel(0.8, start)
    for _ in range(rounds):
        good = model.posterior(vote)
        prior = float(np.clip((n * good).sum() / max(n.sum(), 1), 0.01, 0.99))
        weight = np.stack([n * (1 - good), n * good])
        rate = (weight @ spoke + 10 * start) / (weight.sum(1, keepdims=True) + 10)
        change = np.abs(rate - model.votes).max() + abs(prior - model.prior)
        model = LabelModel(prior, rate)
        if change < 1e-10:
            break
    return model


def shape_features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature, row, words per row): one hashed feature for each word, of its shape, the next shape and equality."""
    data, offsets = buffer(column)
    n = len(offsets) - 1
    starts, row = word_starts(data, offsets)
    words = np.bincount(row, minlength=n)
    if not len(starts):
        return np.zeros(0, np.int64), row, words
    kind = CLASS[data]
    first = np.ones(len(data), bool)  # of a run of one class, within a word
    first[1:] = kind[1:] != kind[:-1]
    first[starts] = True
    kept = np.cumsum(first) - 1
    shape = word_hashes(kind[first], kept[starts], None)
    same = word_hashes(data, starts, offsets)
    following, equal = np.zeros(len(shape), U64), np.zeros(len(shape), U64)
    inside = row[1:] == row[:-1]
    following[:-1] = np.where(inside, shape[1:], 0)
    equal[:-1] = inside & (same[1:] == same[:-1])
    return (mix(shape + following * U64(3) + equal) % U64(DIM)).astype(np.int64), row, words


def fit_scorer(features: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = 30, seed: int = 7) -> tuple[np.ndarray, float]:
    """Logistic regression on shares of features by stochastic gradient descent; classes weigh alike."""
    w, b, rng = np.zeros(DIM), 0.0, np.random.default_rng(seed)
    if not len(labels):
        return w, b
    share = float(np.clip(labels.mean(), 0.02, 0.98))
    weight = np.where(labels >= 0.5, 0.5 / share, 0.5 / (1 - share))
    for epoch in range(epochs):
        rate = 2.0 / (1 + 0.2 * epoch)
        for i in rng.permutation(len(labels)):
            at, x = features[i]
            p = 1 / (1 + np.exp(-np.clip(w[at] @ x + b, -30, 30)))
            step = rate * min(weight[i], 4.0) * (labels[i] - p)
            w[at] += step * x
            b += 0.1 * step
    return w, b


@dataclass
class QualityModel:
    labels: LabelModel
    weights: np.ndarray
    bias: float


def fit(docs: DataFrame, sample: int = SAMPLE, seed: int = 11) -> QualityModel:
    """EM on the vote patterns of all documents; the scorer on about ``sample`` of them, chosen by hash."""
    def run(batches):
        for part in slices(batches):
            _, vote = votes(part.column("text"))
            code, count = np.unique(pattern(vote), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(count)], names=["code", "n"])

    counts = bounded_batches(docs.select("text")).mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).collect()
    codes, n = np.array([r.code for r in counts], np.int64), np.array([r.n for r in counts], np.int64)
    model = fit_label_model(codes, n)
    if not len(codes):
        return QualityModel(model, np.zeros(DIM), 0.0)

    def examples(batches):
        for part in slices(batches):
            words, vote = votes(part.column("text"))
            feature, row, _ = shape_features(part.column("text"))
            at, x = [], []
            for i, mine in enumerate(np.split(feature, np.cumsum(words)[:-1])):
                f, c = np.unique(mine, return_counts=True)
                at.append(f.astype(np.int32))
                x.append((c / max(words[i], 1)).astype(np.float32))
            yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(pattern(vote)), pa.array(at, pa.list_(pa.int32())),
                                              pa.array(x, pa.list_(pa.float32()))], names=["words", "code", "at", "x"])

    chosen = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text"), F.lit(1 << 30)) < F.lit(int((1 << 30) * min(1.0, sample / n.sum())))
    rows = (docs.select("doc_id", "text").filter(chosen).select("text")
            .mapInArrow(examples, "words long, code long, at array<int>, x array<float>").filter("words > 0").limit(2 * sample).collect())
    rows = sorted(rows, key=lambda r: (r.code, r.words, r.at, r.x))  # as collected in any order
    posterior = model.posterior(unpack(np.array([r.code for r in rows], np.int64).reshape(-1)))
    w, b = fit_scorer([(np.array(r.at), np.array(r.x)) for r in rows], posterior)
    return QualityModel(model, w, b)


def score(docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, n_words, posterior, score, kept) for each row, in the order of the rows.

    ``posterior`` is the label model's P(good), ``score`` the scorer's; kept: score >= threshold.
    Null, empty and blank texts have score 0 and are rejected. Repeated rows
    score alike; a null doc_id is carried; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # DIM numbers

    def run(batches):
        m = shared.value
        for part in slices(batches):
            words, vote = votes(part.column("text"))
            feature, row, _ = shape_features(part.column("text"))
            total = np.bincount(row, weights=m.weights[feature], minlength=len(words))
            p = 1 / (1 + np.exp(-np.clip(total / np.maximum(words, 1) + m.bias, -30, 30)))
            p[words == 0] = 0.0
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), pa.array(words.astype(np.int64)), pa.array(m.labels.posterior(vote)),
                 pa.array(p), pa.array(p >= threshold)], names=["doc_id", "n_words", "posterior", "score", "kept"])

    return bounded_batches(docs.select("doc_id", "text")).mapInArrow(run, "doc_id long, n_words long, posterior double, score double, kept boolean")


def keep_good(docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` (all columns) that the scorer keeps; the texts don't move."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for part in slices(batches):
            feature, row, words = shape_features(part.column("text"))
            total = np.bincount(row, weights=m.weights[feature], minlength=len(words))
            p = 1 / (1 + np.exp(-np.clip(total / np.maximum(words, 1) + m.bias, -30, 30)))
            yield part.filter(pa.array((words > 0) & (p >= threshold)))

    return bounded_batches(docs).mapInArrow(run, docs.schema)
