"""Conversation structure repair by grammar-compressed dynamic programming (operator 11).

A turn is one of nine symbols: the initial of its role (s, u, a, or o for any
other; in capitals if its text is truncated), or D if it must go. A
conversation is a sequence of symbols.

* Re-Pair: over the distinct sequences of all conversations, the most frequent
  neighbouring pairs become new symbols, round after round. Each round counts
  the pairs of all sequences in one aggregation; only the chosen pairs, at most
  ``RULES`` in all, reach the driver.
* Every rule has one min-plus transfer matrix over the four states of
  ``(s?(ua)+)?``: the least cost from state to state, and the first audit of
  that cost as a rope that shares the ropes of the rule's two halves. Matrices
  are evaluated bottom-up once and used by all conversations.
* A sequence is the product of the matrices of its few symbols. Audits of equal
  cost and length of input are never prefixes of each other (an insertion
  costs), so the first whole audit is made of first parts.

Conversations are cut into parts of bounded size by their order, whatever
their length; a part is a matrix, and only the parts' matrices and symbols of
a long conversation meet in one task, as a stream. Its texts are hashed as a
stream too (a digest of one text can't be split).
"""

from __future__ import annotations

import hashlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterflow.llm.scratch import saved

BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "suaoSUAOD"
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
ENDS = (START, ASSISTANT)
STEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
REROLE, DELETE, INSERT = 2, 3, 2
RULES, ROUNDS = 256, 10
PART, PART_BYTES = 4096, 1 << 20  # symbols and bytes of text a part
FLAT = 64  # ropes up to this length are strings


def fill(state: int) -> str:
    """The role that a reroled or inserted turn must have next."""
    return "a" if state == USER else "u"


# ropes: a string, or a pair of ropes

def join(a, b):
    if not a or not b:
        return a or b
    if isinstance(a, str) and isinstance(b, str) and len(a) + len(b) <= FLAT:
        return a + b
    return a, b


def leaves(rope):
    stack = [rope]
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            if x:
                yield x
        else:
            stack += (x[1], x[0])


def flat(rope) -> str:
    return rope if isinstance(rope, str) else "".join(leaves(rope))


def less(a, b) -> bool:
    """Whether the text of rope ``a`` comes before that of ``b``."""
    while not isinstance(a, str) and not isinstance(b, str) and a[0] is b[0]:
        a, b = a[1], b[1]
    if a is b:
        return False
    one, two, s, t = leaves(a), leaves(b), "", ""
    while True:
        s, t = s or next(one, ""), t or next(two, "")
        n = min(len(s), len(t))
        if not n:
            return bool(t)
        if s[:n] != t[:n]:
            return s[:n] < t[:n]
        s, t = s[n:], t[n:]


# transfer matrices: entry [p][q] is (cost, rope), or None if q can't be reached from p

def better(x, y):
    if x is None or y is None:
        return x or y
    return y if y[0] < x[0] or y[0] == x[0] and less(y[1], x[1]) else x


def product(a, b):
    out = []
    for row in a:
        new = [None] * 4
        for r in STATES:
            if row[r] is not None:
                for q in STATES:
                    if b[r][q] is not None:
                        new[q] = better(new[q], (row[r][0] + b[r][q][0], join(row[r][1], b[r][q][1])))
        out.append(new)
    return out


def insertions():
    """From state to state by inserted turns alone."""
    out = [[(0, "") if p == q else None for q in STATES] for p in STATES]
    for p in STATES:
        at = p
        for n in (1, 2):
            at = STEP[at, fill(at)]
            out[p][at] = better(out[p][at], (INSERT * n, "I" * n))
    return out


def turn(symbol: str):
    """Insertions, then one turn of this symbol deleted, kept or given another role."""
    out = [[None] * 4 for _ in STATES]
    for p in STATES:
        out[p][p] = (DELETE, "D")
        if symbol == "D":
            continue
        role, late = symbol.lower(), int(symbol.isupper())
        if (p, role) in STEP:
            out[p][STEP[p, role]] = better(out[p][STEP[p, role]], (late, "K"))
        q = STEP[p, fill(p)]
        out[p][q] = better(out[p][q], (REROLE + late, "R"))
    return product(insertions(), out)


class Grammar:
    """Re-Pair rules in the order of their making, with a matrix for each symbol."""

    def __init__(self, pairs: list[str]):
        self.rules = [(pair, chr(0x100 + i)) for i, pair in enumerate(pairs)]
        self.matrix = {c: turn(c) for c in SYMBOLS}
        for pair, symbol in self.rules:
            self.matrix[symbol] = product(self.matrix[pair[0]], self.matrix[pair[1]])
        self.last = insertions()

    def compressed(self, seq: str) -> str:
        for pair, symbol in self.rules:
            if len(seq) < 2:
                break
            seq = seq.replace(pair, symbol)
        return seq

    def matrix_of(self, seq: str, starts=STATES):
        """Rows of the matrix of a sequence for some start states."""
        rows = [[(0, "") if p == q else None for q in STATES] for p in starts]
        for symbol in self.compressed(seq):
            rows = product(rows, self.matrix[symbol])
        return rows

    def repair(self, seq: str) -> tuple[int, str]:
        """(cost, audit) of a whole conversation."""
        row = product(self.matrix_of(seq, [START]), self.last)[0]
        best = None
        for q in ENDS:
            best = better(best, row[q])
        return best[0], flat(best[1])


def learn(sequences: DataFrame) -> Grammar:
    """Rules for ``sequences(seq, n)``, n being how often a sequence stands."""
    pairs: list[str] = []
    for _ in range(ROUNDS):
        grammar = Grammar(pairs)

        def run(batches, grammar=grammar):
            count = Counter()
            for batch in batches:
                for seq, n in zip(batch.column("seq").to_pylist(), batch.column("n").to_pylist(), strict=True):
                    seq = grammar.compressed(seq)
                    for a, b in zip(seq, seq[1:], strict=False):
                        count[a + b] += n
            yield pa.RecordBatch.from_arrays([pa.array(list(count), pa.string()), pa.array(list(count.values()), pa.int64())], names=["pair", "n"])

        counted = sequences.mapInArrow(run, "pair string, n long").groupBy("pair").agg(F.sum("n").alias("n"))
        top = counted.filter("n > 1").orderBy(F.desc("n"), "pair").limit(RULES).collect()
        used, more = set(), []
        for r in top:  # pairs of one round have no symbol in common
            if len(pairs) + len(more) < RULES and not used & {*r.pair}:
                more.append(r.pair)
                used |= {*r.pair}
        if not more:
            break
        pairs += more
    return Grammar(pairs)


PART_SCHEMA = ("pid int, at int, seq string, roles array<string>, texts array<string>, blank long, duplicate long, truncated long, "
               "illegal long, first string, last string, turns long, low long, high long")
SUMS = ("blank", "duplicate", "truncated", "illegal", "turns")
LEGAL = ("su", "ua", "au")


def parts(rows: DataFrame) -> DataFrame:
    """Conversations in order, cut into parts: (k, conv_id, pid, at, seq, ...).

    seq has a symbol for each turn; roles and texts are those of the turns
    that need not go. k names the conversation.
    """
    k = F.coalesce(F.concat(F.lit("v"), F.col("conv_id").cast("string")), F.lit("n"))
    rows = rows.select(k.alias("k"), "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
                       F.coalesce("text", F.lit("")).alias("text"), F.col("n").cast("long").alias("n"))
    rows = rows.groupBy("k", "conv_id", "turn", "role", "text").agg(F.sum("n").alias("n"))
    rows = saved(rows.withColumn("h1", F.xxhash64("role", "text")).withColumn("h2", F.xxhash64(F.lit(1), "text", "role")), "turns-rows")
    when = F.struct(F.col("turn").isNotNull().alias("set"), "turn")
    again = saved(rows.filter("n > 0").groupBy("k", "h1", "h2").agg(F.min(when).alias("since"), F.count("*").alias("m")).filter("m > 1")
                  .drop("m"), "turns-repeated")
    bare = F.btrim("text", F.lit(BLANKS))
    blank = bare == ""
    late = ~F.right(bare, F.lit(1)).isin(".", "!", "?")
    initial = F.when(F.substring("role", 1, 1).isin("s", "u", "a"), F.substring("role", 1, 1)).otherwise("o")
    rows = (rows.join(again, ["k", "h1", "h2"], "left").withColumn("dup", F.coalesce(when > F.col("since"), F.lit(False)))
            .select("k", "conv_id", "turn", "role", "text", "n", "dup", blank.alias("blank"), late.alias("late"),
                    F.when(blank | F.col("dup"), "D").when(late, F.upper(initial)).otherwise(initial).alias("symbol")))
    order = ["k", F.col("turn").asc_nulls_first(), "role"]
    rows = rows.repartitionByRange(*order, F.substring("text", 1, 32)).sortWithinPartitions(*order, "text")
    conv = rows.schema["conv_id"].dataType
    kinds = T.StructType([T.StructField("k", T.StringType()), T.StructField("conv_id", conv),
                          *T.StructType.fromDDL(PART_SCHEMA).fields])
    names = [f.name for f in kinds.fields]

    def run(batches):
        from pyspark import TaskContext
        pid, conv_type = TaskContext.get().partitionId(), None
        now, out, size = None, [], 0

        def fresh(k, conv_id, at):
            return {"k": k, "conv_id": conv_id, "pid": pid, "at": at, "seq": [], "roles": [], "texts": [], **dict.fromkeys(SUMS, 0),
                    "first": None, "last": None, "low": None, "high": None, "bytes": 0, "size": 0}

        def close(p):
            p["seq"] = "".join(p["seq"])
            out.append(p)

        def cut():  # a new part of the same conversation that knows where the last one ended
            nonlocal now
            close(now)
            now = fresh(now["k"], now["conv_id"], now["at"] + 1) | {"last": now["last"], "high": now["high"]}

        def batch_of(rows):
            cols = [pa.array([r[c] for r in rows], conv_type if c == "conv_id" else ARROW[c]) for c in names]
            return pa.RecordBatch.from_arrays(cols, names=names)

        for batch in batches:
            conv_type = batch.schema.field("conv_id").type
            for at in range(0, batch.num_rows, 512):
                for r in batch.slice(at, 512).to_pylist():
                    if now is None or now["k"] != r["k"]:
                        if now is not None:
                            close(now)
                        now = fresh(r["k"], r["conv_id"], 0)
                    n, init = r["n"], r["role"][:1]
                    if not n:
                        continue
                    if r["turn"] is not None:
                        now["turns"] += r["turn"] != now["high"]
                        now["low"] = r["turn"] if now["low"] is None else now["low"]
                        now["high"] = r["turn"]
                    if now["first"] is None:
                        now["first"] = init
                    now["illegal"] += (now["last"] is not None and now["last"] + init not in LEGAL) + n - 1
                    now["last"] = init
                    if r["blank"]:
                        now["blank"] += n
                    elif r["dup"]:
                        now["duplicate"] += n
                    else:
                        now["duplicate"] += n - 1
                        now["truncated"] += r["late"]
                    if r["symbol"] != "D":
                        now["roles"].append(r["role"])
                        now["texts"].append(r["text"])
                        now["seq"].append(r["symbol"])
                        now["bytes"] += len(r["text"])
                        now["size"] += 1
                        n -= 1
                    while n or now["size"] >= PART or now["bytes"] >= PART_BYTES:
                        more = max(0, min(n, PART - now["size"]))
                        now["seq"].append("D" * more)
                        now["size"] += more
                        n -= more
                        if now["size"] >= PART or now["bytes"] >= PART_BYTES:
                            cut()
                size = sum(p["bytes"] for p in out)
                if size > 4 * PART_BYTES or len(out) > 4096:
                    yield batch_of(out)
                    out.clear()
        if now is not None:
            close(now)
        if out:
            yield batch_of(out)

    return rows.mapInArrow(run, kinds)


ARROW = {"k": pa.string(), "pid": pa.int32(), "at": pa.int32(), "seq": pa.string(), "roles": pa.list_(pa.string()), "texts": pa.list_(pa.string()),
         "first": pa.string(), "last": pa.string(), "low": pa.int64(), "high": pa.int64(), **dict.fromkeys(SUMS, pa.int64())}


def edited(audit: str, symbols: str, roles: list[str], texts: list[str], state: int) -> tuple[list[tuple[str, str]], int]:
    """The turns that the edits leave, and the state after them."""
    out, i, j = [], 0, 0
    for e in audit:
        if e == "I":
            new = fill(state)
            out.append((("user", "assistant")[new == "a"], ""))
            state = STEP[state, new]
            continue
        live = symbols[i] != "D"
        if e != "D":
            new = symbols[i].lower() if e == "K" else fill(state)
            out.append((roles[j] if e == "K" else ("user", "assistant")[new == "a"], texts[j]))
            state = STEP[state, new]
        i, j = i + 1, j + live
    return out, state


def folded(group: list[dict], grammar: Grammar) -> tuple[int, list[str]]:
    """(cost, edits for each part) of the parts of one conversation in order; the last gets the insertions at the end."""
    # chains: (cost, rope of all edits, (chain before, edits here))
    now = [(0, "", None) if p == START else None for p in STATES]

    def step(matrix):
        new = [None] * 4
        for p in STATES:
            if now[p] is not None:
                for q in STATES:
                    if matrix[p][q] is not None:
                        cost, edits = matrix[p][q]
                        one = (now[p][0] + cost, (now[p][1], edits), (now[p][2], edits))
                        if new[q] is None or one[0] < new[q][0] or one[0] == new[q][0] and less(one[1], new[q][1]):
                            new[q] = one
        return new

    for r in group:
        now = step(grammar.matrix_of(r["seq"]))
    now = step(grammar.last)
    best = None
    for q in ENDS:
        if now[q] is not None and (best is None or now[q][0] < best[0] or now[q][0] == best[0] and less(now[q][1], best[1])):
            best = now[q]
    edits, chain = [], best[2]
    while chain is not None:
        edits.append(flat(chain[1]))
        chain = chain[0]
    edits.reverse()
    edits[-2:] = ["".join(edits[-2:])]
    return best[0], edits


def total(group: list[dict]) -> dict:
    """Counts of a conversation from its parts in order."""
    out = {c: sum(r[c] for r in group) for c in SUMS}
    low = next((r["low"] for r in group if r["low"] is not None), None)
    last = high = None
    for r in group:
        if r["at"] == 0:  # begins a task's rows: the part before it is unknown to it
            out["illegal"] += last is not None and r["first"] is not None and last + r["first"] not in LEGAL
            out["turns"] -= high is not None and r["low"] == high
        last, high = r["last"] if r["last"] is not None else last, r["high"] if r["high"] is not None else high
    out["gaps"] = 0 if low is None else high - low + 1 - out["turns"]
    return out


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def lines(turns: list[tuple[str, str]]) -> str:
    return "\n".join(f"{role}:{text}" for role, text in turns)


def groups(batches, columns):
    """Runs of rows with equal k of a sorted stream, as lists of dicts without texts."""
    held = []
    for batch in batches:
        for r in batch.select(columns).to_pylist():
            if held and held[-1]["k"] != r["k"]:
                yield held
                held = []
            held.append(r)
    if held:
        yield held


class Repaired:
    """What ``repair`` found: ``plan`` has a row for each part, with its edits and the state before it."""

    def __init__(self, short: DataFrame, long: DataFrame, long_plan: DataFrame, grammar: Grammar):
        self.short, self.long, self.long_plan, self.grammar = short, long, long_plan, grammar

    def turns(self) -> DataFrame:
        """(conv_id, pid, at, pos, role, text): the repaired turns, in this order within a conversation."""
        return self._mapped("conv_id, pid, at, pos, role, text", lambda r, turns: [
            (r["conv_id"], r["pid"], r["at"], n, role, text) for n, (role, text) in enumerate(turns)],
            "pid int, at int, pos int, role string, text string")

    def _mapped(self, names: str, f, kinds: str) -> DataFrame:
        grammar, names = self.grammar, names.split(", ")
        need = ["k", "conv_id", "pid", "at", "seq", "roles", "texts"]
        both = self.short.select(*need, F.lit(None).cast("string").alias("edits"), F.lit(START).alias("state")).unionByName(
            self.long.join(self.long_plan.select("k", "pid", "at", "edits", "state"), ["k", "pid", "at"]).select(*need, "edits", "state"))
        conv = both.schema["conv_id"].dataType
        schema = T.StructType([T.StructField("conv_id", conv), *T.StructType.fromDDL(kinds).fields])

        def run(batches):
            seen = {}
            for batch in batches:
                for at in range(0, batch.num_rows, 64):
                    out = []
                    for r in batch.slice(at, 64).to_pylist():
                        edits = r["edits"]
                        if edits is None:
                            if len(seen) > 50_000:
                                seen.clear()
                            edits = seen.get(r["seq"]) or seen.setdefault(r["seq"], grammar.repair(r["seq"])[1])
                        out += f(r, edited(edits, r["seq"], r["roles"], r["texts"], r["state"])[0])
                    if out:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (
                            batch.schema.field("conv_id").type, *(pa.string() if x.endswith("string") else pa.int32() for x in kinds.split(", "))),
                            strict=True)], names=names)

        return both.mapInArrow(run, schema)

    def summary(self) -> DataFrame:
        """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
        grammar, counts = self.grammar, COUNTS
        conv = T.StructField("conv_id", self.short.schema["conv_id"].dataType)
        schema = T.StructType([conv, *(T.StructField(c, T.LongType()) for c in counts), T.StructField("audit", T.StringType()),
                               T.StructField("repaired_sha256", T.StringType())])

        def one(batches):  # whole conversations
            seen = {}
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    out = []
                    for r in batch.slice(at, 256).to_pylist():
                        if len(seen) > 50_000:
                            seen.clear()
                        cost, audit = seen.get(r["seq"]) or seen.setdefault(r["seq"], grammar.repair(r["seq"]))
                        text = lines(edited(audit, r["seq"], r["roles"], r["texts"], START)[0])
                        out.append(total([r]) | {"conv_id": r["conv_id"], "cost": cost, "audit": audit,
                                                 "repaired_sha256": hashlib.sha256(text.encode()).hexdigest()})
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r[f.name] for r in out], batch.schema.field("conv_id").type if f.name == "conv_id" else
                                  pa.int64() if f.name in counts else pa.string()) for f in schema.fields], names=schema.names)

        def digest(batches):  # texts of parts in order
            k, h, any_yet = None, None, False
            for batch in batches:
                for at in range(0, batch.num_rows, 16):
                    for r in batch.slice(at, 16).to_pylist():
                        if k is not None and r["k"] != k:
                            yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([h.hexdigest()])], names=["k", "repaired_sha256"])
                        if r["k"] != k:
                            k, h, any_yet = r["k"], hashlib.sha256(), False
                        if r["text"]:
                            h.update((b"\n" if any_yet else b"") + r["text"].encode())
                            any_yet = True
            if k is not None:
                yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([h.hexdigest()])], names=["k", "repaired_sha256"])

        def applied(batches):
            for batch in batches:
                for at in range(0, batch.num_rows, 16):
                    rows = batch.slice(at, 16).to_pylist()
                    text = [lines(edited(r["edits"], r["seq"], r["roles"], r["texts"], r["state"])[0]) for r in rows]
                    yield pa.RecordBatch.from_arrays([pa.array([r["k"] for r in rows]), pa.array([r["pid"] for r in rows], pa.int32()),
                                                      pa.array([r["at"] for r in rows], pa.int32()), pa.array(text)], names=["k", "pid", "at", "text"])

        pieces = (self.long.join(self.long_plan.select("k", "pid", "at", "edits", "state"), ["k", "pid", "at"])
                  .select("k", "pid", "at", "seq", "roles", "texts", "edits", "state").mapInArrow(applied, "k string, pid int, at int, text string"))
        hashes = pieces.repartition("k").sortWithinPartitions("k", "pid", "at").mapInArrow(digest, "k string, repaired_sha256 string")
        heads = self.long_plan.filter("audit is not null").select("k", "conv_id", *counts, "audit")
        return self.short.mapInArrow(one, schema).unionByName(heads.join(hashes, "k").select(*schema.names))


def repair(rows: DataFrame) -> Repaired:
    """Cheapest repairs of the conversations in ``rows(conv_id, turn, role, text, n)``.

    n tells how often a row stands (0: it only names its conversation). The
    rows of a conversation are taken by turn (nulls first), equal turns by
    role and text. The first fault of a row counts: blank (no character but
    blanks), duplicate (same role and text earlier), truncated (the last
    character that is no blank is none of ``.!?``). Edits: Keep 0, Rerole to
    user or assistant 2, Delete 3 (blank rows and duplicates must go), Insert
    an empty turn of user or assistant 2; a truncated row that stays adds 1.
    The initials of the roles then read ``(s?(ua)+)?``. Of equally cheap
    edits, the first audit by code point is taken.

    A null conv_id is a conversation like another; null roles and texts are
    empty. Conversations without rows have zeros, an empty audit and no turns.
    Other columns are ignored.
    """
    cut = saved(parts(rows), "turns-parts")
    narrow = cut.drop("roles", "texts")
    grammar = learn(saved(narrow.groupBy("seq").agg(F.count("*").alias("n")), "turns-sequences"))
    many = saved(narrow.groupBy("k").agg(F.count("*").alias("m")).filter("m > 1").select("k"), "turns-long")
    short, long = cut.join(many, "k", "left_anti"), cut.join(many, "k", "left_semi")
    conv = narrow.schema["conv_id"].dataType
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("conv_id", conv), *T.StructType.fromDDL(
        "pid int, at int, edits string, state int, audit string").fields, *(T.StructField(c, T.LongType()) for c in COUNTS)])

    def fold(batches):
        kind = None

        def typed(bs):
            nonlocal kind
            for b in bs:
                kind = b.schema.field("conv_id").type
                yield b

        for group in groups(typed(batches), narrow_names):
            cost, edits = folded(group, grammar)
            head = total(group) | {"cost": cost, "audit": "".join(edits)}
            state, out = START, []
            for r, e in zip(group, edits, strict=True):
                out.append({"k": r["k"], "conv_id": r["conv_id"], "pid": r["pid"], "at": r["at"], "edits": e, "state": state})
                state = edited(e, r["seq"], [""] * len(r["seq"]), [""] * len(r["seq"]), state)[1]
            rows = [{**dict.fromkeys(head), **r} for r in out]
            rows[0] |= head
            yield pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in rows], kind if f.name == "conv_id" else pa.string() if f.name in
                                             ("k", "edits", "audit") else pa.int32() if f.name in ("pid", "at", "state") else pa.int64())
                                              for f in schema.fields], names=schema.names)

    narrow_names = narrow.columns
    plan = long.select(*narrow_names).repartition("k").sortWithinPartitions("k", "pid", "at").mapInArrow(fold, schema)
    return Repaired(short, long, saved(plan, "turns-plan"), grammar)


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, n): rows broken by crc32 of ``conv_id:turn`` modulo 20.

    0 drops a row, 1 empties its text, 2 takes out ``.!?``, 3 doubles it, 4
    makes it a user's. Nulls in the key, the role and the text are one space.
    """
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", said("role").alias("role"), said("text").alias("text"), fate.alias("fate"))
    gone = F.col("fate") == 0
    text = F.when(gone | (F.col("fate") == 1), "").when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(gone, "").when(F.col("fate") == 4, "user").otherwise(F.col("role"))
    return rows.select("conv_id", F.when(~gone, F.col("turn")).alias("turn"), role.alias("role"), text.alias("text"),
                       F.when(gone, 0).when(F.col("fate") == 3, 2).otherwise(1).alias("n"))


ORACLE_SQL = r"""
WITH RECURSIVE c AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
f AS (SELECT *, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(key) + 1), lambda i: CAST(ascii(substr(key, i, 1)) AS BIGINT))),
        lambda s, b: list_reduce(list_prepend(xor(s, b), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))),
        4294967295) % 20 AS fate FROM c),
d AS (SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
             CASE fate WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
      FROM f, unnest(range(CASE fate WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS u(copy)),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
             trim(text, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)) AS bare FROM d),
m AS (SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                     WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
             left(role, 1) AS r, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair FROM o),
per AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) AS n, count(*) FILTER (fault = 'blank') AS blank,
               count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
               count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM m GROUP BY conv_id),
ids AS (SELECT DISTINCT conv_id FROM conversations),
dp AS (SELECT conv_id, CAST(0 AS BIGINT) AS i, {'c': 0, 'a': ''} AS v0, {'c': 1000000000, 'a': ''} AS v1, {'c': 1000000000, 'a': ''} AS v2, {'c': 1000000000, 'a': ''} AS v3 FROM ids
  UNION ALL
  SELECT w.conv_id, w.i + 1, {'c': w.v0.c + 3, 'a': w.v0.a || 'D'},
    least({'c': w.v1.c + 3, 'a': w.v1.a || 'D'}, {'c': w.v0.c + CASE WHEN live AND r = 's' THEN late ELSE 1000000000 END, 'a': w.v0.a || 'K'}),
    least({'c': w.w2.c + 3, 'a': w.w2.a || 'D'}, {'c': w.v0.c + put, 'a': w.v0.a || u}, {'c': w.v1.c + put, 'a': w.v1.a || u}, {'c': w.w3.c + put, 'a': w.w3.a || u}),
    least({'c': w.w3.c + 3, 'a': w.w3.a || 'D'}, {'c': w.w2.c + CASE WHEN NOT live THEN 1000000000 WHEN r = 'a' THEN late ELSE late + 2 END,
                                               'a': w.w2.a || CASE WHEN r = 'a' THEN 'K' ELSE 'R' END})
  FROM (SELECT *, least(v3, {'c': w2.c + 2, 'a': w2.a || 'I'}) AS w3
        FROM (SELECT *, least(v2, {'c': v0.c + 2, 'a': v0.a || 'I'}, {'c': v1.c + 2, 'a': v1.a || 'I'}, {'c': v3.c + 2, 'a': v3.a || 'I'}) AS w2 FROM dp)) w
  JOIN (SELECT conv_id, i, r, fault NOT IN ('blank', 'duplicate') AS live, CAST(fault = 'truncated' AS INTEGER) AS late,
               CASE WHEN fault IN ('blank', 'duplicate') THEN 1000000000 WHEN r = 'u' THEN 0 ELSE 2 END + CAST(fault = 'truncated' AS INTEGER) AS put,
               CASE WHEN r = 'u' THEN 'K' ELSE 'R' END AS u FROM m) s
    ON w.conv_id IS NOT DISTINCT FROM s.conv_id AND s.i = w.i + 1),
best AS (SELECT ids.conv_id, least(dp.v0, dp.v3, {'c': dp.v2.c + 2, 'a': dp.v2.a || 'I'}, {'c': dp.v1.c + 4, 'a': dp.v1.a || 'II'}) AS b
         FROM ids LEFT JOIN per ON ids.conv_id IS NOT DISTINCT FROM per.conv_id
         JOIN dp ON dp.conv_id IS NOT DISTINCT FROM ids.conv_id AND dp.i = coalesce(per.n, 0)),
e AS (SELECT conv_id, p, substr(b.a, p, 1) AS e, p - length(replace(left(b.a, p), 'I', '')) AS inserted FROM best, unnest(range(1, length(b.a) + 1)) AS u(p)),
t AS (SELECT e.conv_id, p, e, role, text, r, row_number() OVER (PARTITION BY e.conv_id ORDER BY p) AS j FROM e
      LEFT JOIN m ON e.conv_id IS NOT DISTINCT FROM m.conv_id AND m.i = p - inserted AND e <> 'I' WHERE e <> 'D'),
h AS (SELECT conv_id, j, coalesce(text, '') AS text, e, role,
             max(CASE WHEN j = 1 AND e = 'K' AND r = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id) AS s FROM t),
g AS (SELECT conv_id, string_agg(CASE WHEN e = 'K' THEN role WHEN (j - s) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' ||
             CASE WHEN e = 'I' THEN '' ELSE text END, chr(10) ORDER BY j) AS whole FROM h GROUP BY conv_id)
SELECT ids.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(b.c AS BIGINT) AS cost, b.a AS audit,
       sha256(coalesce(whole, '')) AS repaired_sha256
FROM ids LEFT JOIN per ON ids.conv_id IS NOT DISTINCT FROM per.conv_id JOIN best ON ids.conv_id IS NOT DISTINCT FROM best.conv_id
LEFT JOIN g ON ids.conv_id IS NOT DISTINCT FROM g.conv_id
"""
