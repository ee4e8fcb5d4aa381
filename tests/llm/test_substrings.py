"""Repeated passages against all windows in plain Python."""
import random
from collections import Counter
from hashlib import sha256

from meterflow.llm import substrings


def brute(rows, length):
    texts = [(i, (t or "").encode().split()) for i, t in rows]
    count = Counter(tuple(w[p:p + length]) for _, w in texts for p in range(len(w) - length + 1))
    out = []
    for i, w in texts:
        gone = set()
        for p in range(len(w) - length + 1):
            if count[tuple(w[p:p + length])] > 1:
                gone |= {*range(p, p + length)}
        kept = b" ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((i, len(w), len(gone), kept.decode()))
    return sorted(out, key=str)


def check(spark, rows, length):
    df = spark.createDataFrame([(i, t, 1, 2, "z") for i, t in rows], "doc_id long, text string, pos int, h int, spans string").repartition(4)
    got = substrings.drop_repeats(df, length).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.text) for r in got), key=str) == brute(rows, length)
    for r in got:
        assert r.n_removed == sum(s.stop - s.start for s in r.spans)
        assert all(a.stop < b.start for a, b in zip(r.spans, r.spans[1:]))
    hashed = {(r.doc_id, r.kept_sha256) for r in substrings.drop_repeats(df, length, digest=True).collect()}
    assert hashed == {(r.doc_id, sha256(r.text.encode()).hexdigest()) for r in got}


def test_passages(spark):
    rng = random.Random(4)
    word = lambda: f"w{rng.randrange(5000)}"
    run = lambda n: [word() for _ in range(n)]
    passages = [run(n) for n in (34, 35, 36, 40, 60, 150)]
    rows = []
    for i in range(90):
        text = run(rng.randrange(50))
        for _ in range(rng.randrange(3)):
            text += rng.choice(passages) + run(rng.randrange(40))
        rows.append((i, " ".join(text)))
    near = run(200)
    for i in range(20):  # one word differs, at another place each
        rows.append((200 + i, " ".join(near[:10 * i] + [f"x{i}"] + near[10 * i + 1:])))
    # parts of one passage that overlap, so neighbours of an anchor differ
    rows += [(300 + i, " ".join(run(3) + passages[5][i:i + 50] + run(3))) for i in range(0, 100, 7)]
    for length in (35, 20):
        check(spark, rows, length)


def test_edges(spark):
    rng = random.Random(6)
    unique = " ".join(f"u{i}" for i in range(100))
    rows = [(0, None), (1, ""), (2, " \n\t"), (3, "one"), (4, " ".join(["same"] * 34)), (5, " ".join(["loop"] * 36)), (6, " ".join("ab"[i % 2] + "q" for i in range(60))),
            (7, unique), (7, unique), (8, "x y " * 80), (None, "n " * 40), (None, unique + " tail"), (9, "\n".join(f"v{i}" for i in range(35))),
            (10, "\x0b".join(f"v{i}" for i in range(35))), (11, " ".join(f"r{rng.randrange(9)}" for _ in range(30_000))), (12, "\x85".join(f"v{i}" for i in range(35)))]
    check(spark, rows, 35)
    check(spark, rows[:4], 35)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert substrings.drop_repeats(empty).count() == 0
