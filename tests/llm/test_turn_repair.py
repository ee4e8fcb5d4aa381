"""Repairs against an exhaustive search, and the whole operator against plain Python."""
import heapq
import random
from collections import Counter, defaultdict
from hashlib import sha256

import pytest

from meterflow.llm import turn_repair as tr

LEGAL = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}


def search(symbols: str) -> tuple[int, str]:
    """Uniform-cost search over single edits, first by cost, then by audit."""
    heap, done = [(0, "", 0, 0)], set()
    while True:
        cost, audit, i, state = heapq.heappop(heap)
        if i == len(symbols) and state in (0, 3):
            return cost, audit
        if (i, state) in done:
            continue
        done.add((i, state))
        fill = "a" if state == 2 else "u"
        heapq.heappush(heap, (cost + 2, audit + "I", i, LEGAL[state, fill]))
        if i < len(symbols):
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state))
            x = symbols[i]
            if x != "D":
                late = x.isupper()
                if (state, x.lower()) in LEGAL:
                    heapq.heappush(heap, (cost + late, audit + "K", i + 1, LEGAL[state, x.lower()]))
                heapq.heappush(heap, (cost + 2 + late, audit + "R", i + 1, LEGAL[state, fill]))


def test_matrices_and_ropes():
    rng = random.Random(3)
    plain, rules = tr.Grammar([]), tr.Grammar(["ua", "ĀĀ", "āā", "DD", "uU", "au"])
    seqs = ["", "s", "u", "a", "o", "D", "ua", "au", "ss"] + ["".join(rng.choices(tr.SYMBOLS, k=n)) for n in range(1, 14) for _ in range(25)]
    for seq in seqs + ["ua" * 40 + "uu" + "ua" * 30]:
        want = search(seq)
        assert plain.repair(seq) == want and rules.repair(seq) == want, seq
        for cuts in (1, 3):
            at = sorted(rng.randrange(len(seq) + 1) for _ in range(cuts))
            group = [{"seq": seq[i:j]} for i, j in zip([0, *at], [*at, len(seq)])]
            cost, edits = tr.folded(group, rules)
            assert (cost, "".join(edits)) == want and len(edits) == len(group)
            assert [sum(e != "I" for e in x) for x in edits] == [len(g["seq"]) for g in group]


def test_ropes_compare_as_texts():
    rng = random.Random(5)
    made = [""]
    for _ in range(300):
        made.append(rng.choice([tr.join(rng.choice(made), rng.choice(made)), rng.choice("DIKR") * rng.randrange(70), (rng.choice(made), "K")]))
        made = [m for m in made if len(tr.flat(m)) < 400]
        a, b = rng.choice(made), rng.choice(made)
        assert tr.less(a, b) == (tr.flat(a) < tr.flat(b))


def brute(rows):
    """{conv_id: (gaps, blank, duplicate, truncated, illegal, cost, audit, hash)} of (conv_id, turn, role, text, n)."""
    convs = defaultdict(list)
    for c, turn, role, text, n in rows:
        convs[c] += [(turn, role or "", text or "")] * n
    out = {}
    for c, turns in convs.items():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, symbols, count = set(), "", Counter()
        for _, role, text in turns:
            bare = text.strip(tr.BLANKS)
            fault = ("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
            count[fault] += 1
            x = role[:1] if role[:1] in ("s", "u", "a") else "o"
            symbols += "D" if fault in ("blank", "duplicate") else x.upper() if fault else x
        known = [t for t, _, _ in turns if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        cost, audit = search(symbols)
        left, i, state = [], 0, 0
        for e in audit:
            fill = "a" if state == 2 else "u"
            name = {"a": "assistant", "u": "user"}[fill]
            if e == "I":
                left.append((name, ""))
            if e in "KR":
                left.append((turns[i][1] if e == "K" else name, turns[i][2]))
            if e != "D":
                state = LEGAL[state, turns[i][1][0] if e == "K" else fill]
            i += e != "I"
        text = "\n".join(f"{r}:{t}" for r, t in left)
        out[c] = (gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, sha256(text.encode()).hexdigest())
    return out


def table(spark, rows):
    return spark.createDataFrame([(*r, 7, "x") for r in rows], "conv_id long, turn long, role string, text string, n int, k int, seq string").repartition(5)


def check(spark, rows):
    done = tr.repair(table(spark, rows))
    got = {r[0]: tuple(r)[1:] for r in done.summary().collect()}
    assert got == brute(rows)
    texts = defaultdict(list)
    for r in sorted(done.turns().collect(), key=lambda r: (r.pid, r.at, r.pos)):
        texts[r.conv_id].append(f"{r.role}:{r.text}")
    for c, x in got.items():
        assert sha256("\n".join(texts[c]).encode()).hexdigest() == x[-1]


def made(seed, convs, most):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "what", "", " \t\n", None, "A long one. And", "ok?", "é .", " "]
    rows = []
    for c in convs:
        for _ in range(rng.randrange(most)):
            turn = rng.choice([None, *range(-2, 9)])
            rows.append((c, turn, rng.choice(["user", "assistant", "system", "tool", None, "", "USER", "usr"]), rng.choice(texts), rng.choice([0, 1, 1, 1, 2, 3])))
    return rows


def test_edges(spark):
    rows = made(1, [*range(60), None, -5], 14) + [(900, 1, "user", "x.", 0), (901, None, None, None, 1), (902, 5, "assistant", "y" * 3_000_000 + ".", 1)]
    check(spark, rows)
    assert tr.repair(table(spark, rows[:1]).limit(0)).summary().count() == 0
    ids = spark.createDataFrame([("b", "1"), (None, "2"), ("a", None)], "conv_id string, text string").selectExpr("conv_id", "1 as turn", "'user' as role", "text", "1 as n")
    assert {r.conv_id: r.audit for r in tr.repair(ids).summary().collect()} == {"b": "D", None: "D", "a": "D"}


@pytest.mark.parametrize("part", [1, 7])
def test_long_conversations_are_cut(spark, monkeypatch, part):
    monkeypatch.setattr(tr, "PART", part)
    rows = made(2, [1], 1500) + made(3, [2, 3, 4], 40) + [(5, i, "user" if i % 2 == 0 else "assistant", f"turn {i}.", 1) for i in range(300)] + [(6, None, "user", "same.", 50)]
    check(spark, rows)


def test_damage(spark):
    rows = [(i, t, "assistant", "One. Two!") for i in range(40) for t in (0, 1, None)] + [(None, 3, None, None)]
    from zlib import crc32
    want = Counter()
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        fate = crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if fate == 0:
            want[c, None, "", "", 0] += 1
        else:
            text = {1: "", 2: text.translate({ord(x): None for x in ".!?"})}.get(fate, text)
            want[c, t, "user" if fate == 4 else role, text, 2 if fate == 3 else 1] += 1
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert Counter(map(tuple, tr.damaged(df).collect())) == want
