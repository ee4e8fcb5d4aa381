"""Mixing sources to target weights (operator 9), DataFrame functions only.

Targets: sources in code-point order (null last) weigh 5, 2, 1, repeating, and
share ``budget`` times all words by weight; no target exceeds ``most`` times
its source's words, and the excess is shared by the others.

Draw: the documents of a source fall into up to ``blocks`` blocks by hash. A
source takes whole passes over its blocks, then blocks in permuted order until
its target is reached; the last one is cut between documents.

Splitting tree: the number of block draws of each source is split between the
two halves of the output shards by a multivariate hypergeometric draw, each
half is split again, and so on down to single shards. A shard then owns that
many draws from the source's permutation, disjoint from those of all other
shards, and its rows are shuffled within the shard.

All randomness is a hash of the seed and the row, so reruns and retried tasks
agree. Windows run over sources, over the at most ``blocks`` blocks of one
source, and over the documents of the one block per source that is cut.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterflow.llm.scratch import saved

WEIGHTS = (5, 2, 1)
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def targets(sources: DataFrame, budget: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size, src, target) from (source, source_size); src is the rank of the source."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), ((F.col("src") - 1) % len(WEIGHTS) + 1).cast("int"))
    ranked = (sources.withColumn("src", F.row_number().over(order)).withColumn("w", weight)
              .withColumn("cap", F.lit(most) * F.col("source_size")))
    # sources reach their cap in the order of cap / weight; the level is what the rest share
    by = Window.orderBy(F.col("cap") / F.col("w"), "src")
    before, after = by.rowsBetween(Window.unboundedPreceding, -1), by.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    level = (F.lit(budget) * total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(after)
    levels = ranked.withColumn("level", level).withColumn("free", F.col("cap") / F.col("w") > F.col("level"))
    whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    water = F.min(F.when(F.col("free"), F.struct(F.col("cap") / F.col("w"), F.col("src"), F.col("level").alias("level"))))
    return levels.withColumn("water", water.over(whole)["level"]).select(
        "source", "source_size", "src", F.coalesce(F.least("cap", F.col("water") * F.col("w")), F.col("cap")).alias("target"))


def hypergeometric(total: str, good: str, draws: str, u: str) -> str:
    """SQL for the number of good ones among ``draws`` without replacement, by inverting the distribution at ``u``.

    The distribution is summed within ten standard deviations of its mode, which
    holds all of it in doubles. (One-element arrays hold values that are used
    more than once.)
    """
    ratio = "(p.k - x) * (p.m - x) / ((x + 1) * (p.n - p.k - p.m + x + 1))"
    near = "ceil(10 * sqrt(greatest(0D, p.m * (p.k / p.n) * (1 - p.k / p.n)))) + 10"
    mode = "floor((p.m + 1) * (p.k + 1) / (p.n + 2))"
    first = f"cast(greatest(0D, p.m - (p.n - p.k), {mode} - ({near})) as bigint)"
    last = f"cast(least(p.k, p.m, {mode} + ({near})) as bigint)"
    mass = f"""aggregate(sequence(r.a, r.b), named_struct('p', 1D, 's', 0D),
        (t, x) -> named_struct('p', t.p * {ratio}, 's', t.s + t.p), t -> t.s)"""
    found = f"""aggregate(sequence(r.a, r.b), named_struct('p', 1D, 's', 0D, 'x', r.a),
        (t, x) -> named_struct('p', t.p * {ratio}, 's', t.s + t.p, 'x', if(t.s < goal, x, t.x)), t -> t.x)"""
    return f"""element_at(transform(array(named_struct('n', cast({total} as double), 'k', cast({good} as double),
        'm', cast({draws} as double), 'u', {u})), p -> if(p.k <= 0 or p.m <= 0, 0L,
        element_at(transform(array(named_struct('a', {first}, 'b', greatest({first}, {last}))), r ->
        element_at(transform(array(p.u * {mass}), goal -> {found}), 1)), 1))), 1)"""


def shard_quotas(draws: DataFrame, shards: int, seed: int) -> DataFrame:
    """(src, shard, n): the draws of (src, n) split exactly among ``shards`` by the tree.

    A node holds the counts of all sources for a run of shards. Its left half
    takes its share of all draws; how many of these are of the first source is
    hypergeometric, of the second hypergeometric among what is left, and so on.
    """
    quota = "array<struct<src:int,n:bigint>>"
    nodes = draws.groupBy().agg(F.array_sort(F.collect_list(F.expr("struct(cast(src as int) as src, cast(n as bigint) as n)"))).alias("q"))
    nodes = nodes.selectExpr("0 as first", f"{shards} as width", f"cast(q as {quota}) as q")
    for depth in range(math.ceil(math.log2(shards)) if shards > 1 else 0):
        u = f"(shiftrightunsigned(xxhash64({seed}, {depth}, first, x.src), 11) + 0.5D) / {1 << 53}D"
        left = f"""aggregate(q, named_struct('n', total, 'm', total * half div width, 'out', cast(array() as {quota})),
            (s, x) -> element_at(transform(array({hypergeometric('s.n', 'x.n', 's.m', u)}), got -> named_struct(
                'n', s.n - x.n, 'm', s.m - got, 'out', concat(s.out, array(named_struct('src', x.src, 'n', got))))), 1),
            s -> s.out)"""
        kids = """if(width = 1, array(named_struct('first', first, 'width', width, 'q', q)), array(
            named_struct('first', first, 'width', half, 'q', l),
            named_struct('first', first + half, 'width', width - half,
                         'q', zip_with(q, l, (a, b) -> named_struct('src', a.src, 'n', a.n - b.n)))))"""
        sized = nodes.selectExpr("*", "cast(width div 2 as int) as half", "aggregate(q, 0L, (s, x) -> s + x.n) as total")
        split = sized.selectExpr("*", f"if(width = 1, null, {left}) as l").selectExpr(f"explode({kids}) as k")
        nodes = saved(split.selectExpr("k.first as first", "k.width as width", f"cast(k.q as {quota}) as q"), "mix-tree")
    return nodes.selectExpr("first as shard", "explode(q) as x").selectExpr("shard", "x.src", "x.n")


def block_plan(base: DataFrame, shards: int | None, seed: int, shard_words: int) -> DataFrame:
    """For each (source, block): what a document of it needs to know.

    source, block, source_size, target, passes (whole draws), cut (documents
    with a key up to it are drawn once more; null: none), shard_of (one shard
    for each draw).
    """
    blocks = saved(base.groupBy("source", "block").agg(F.sum("size").alias("words")), "mix-blocks")
    goals = saved(targets(blocks.groupBy("source").agg(F.sum("words").alias("source_size"))), "mix-targets")
    if shards is None:  # one number
        total = goals.agg(F.sum("target")).first()[0] or 0
        shards = max(1, math.ceil(total / shard_words))
    plan = blocks.join(goals, blocks["source"].eqNullSafe(goals["source"])).drop(goals["source"])
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    plan = plan.withColumn("passes", passes).withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size"))
    permuted = Window.partitionBy("src").orderBy(F.xxhash64(F.lit(seed), F.lit("cut"), "src", "block"), "block")
    plan = plan.withColumn("upto", F.sum("words").over(permuted.rowsBetween(Window.unboundedPreceding, 0)))
    start = F.col("upto") - F.col("words")
    whole = (F.col("upto") <= F.col("rest")) & (F.col("words") > 0)
    part = (start < F.col("rest")) & (F.col("upto") > F.col("rest"))
    plan = saved(plan.withColumn("whole", whole).withColumn("left", F.when(part, F.col("rest") - start)), "mix-plan")
    # the block that is cut: documents in the order of their keys, to the nearest end of a document
    cut = plan.filter("left is not null").select("source", "block", "src", "left")
    inside = base.filter("size > 0").join(cut, base["source"].eqNullSafe(cut["source"]) & (base["block"] == cut["block"]))
    order = Window.partitionBy("src").orderBy("key").rangeBetween(Window.unboundedPreceding, 0)
    ends = (inside.select("src", "key", "size", "left").withColumn("upto", F.sum("size").over(order))
            .filter(F.col("upto") - F.col("size") / 2 <= F.col("left")).groupBy("src").agg(F.max("key").alias("key")))
    plan = plan.join(ends.withColumnRenamed("src", "_s"), F.col("src") == F.col("_s"), "left").drop("_s")
    last = F.when(F.col("whole"), F.lit((1 << 63) - 1)).when(F.col("left").isNotNull(), F.col("key"))
    plan = saved(plan.withColumn("cut", last).withColumn(
        "n", F.when(F.col("words") > 0, F.col("passes") + F.col("cut").isNotNull().cast("int")).otherwise(0)), "mix-draws")
    # the tree, then each source's permuted draws dealt out by its quotas
    quotas = saved(shard_quotas(plan.groupBy("src").agg(F.sum("n").alias("n")), shards, seed), "mix-quotas")
    upto = F.sum("n").over(Window.partitionBy("src").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0))
    ranks = quotas.withColumn("upto", upto).filter("n > 0").select(
        "src", "shard", F.explode(F.sequence(F.col("upto") - F.col("n") + 1, F.col("upto"))).alias("rank"))
    draws = plan.filter("n > 0").select("src", "block", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("draw"))
    deal = Window.partitionBy("src").orderBy(F.xxhash64(F.lit(seed), F.lit("deal"), "src", "block", "draw"), "block", "draw")
    dealt = (draws.withColumn("rank", F.row_number().over(deal).cast("long")).join(ranks, ["src", "rank"])
             .groupBy(F.col("src").alias("_s"), F.col("block").alias("_b"))
             .agg(F.array_sort(F.collect_list(F.struct("draw", "shard")))["shard"].alias("shard_of")))
    plan = plan.join(dealt, (F.col("src") == F.col("_s")) & (F.col("block") == F.col("_b")), "left")
    return saved(plan.select(F.col("source").alias("plan_source"), F.col("block").alias("plan_block"), "source_size", "target",
                             "passes", "cut", "shard_of"), "mix-result")


def draws(docs: DataFrame, shards: int | None = None, blocks: int = 4096, seed: int = 1,
          shard_words: int = 5_000_000, carry: bool = False) -> DataFrame:
    """One row per row of ``docs(doc_id, source, text)``: doc_id, size, source_size,
    target, taken, shards (one shard for each copy that the mix takes).

    ``taken`` is ``size`` times 0, 1 or 2. Null and empty texts have size 0 and
    are never drawn; a null source is a source of its own, the last; a null
    doc_id is a value like another. Repeated rows are drawn alike. With
    ``carry``, the struct ``row`` holds all columns of ``docs``, so that no
    name of theirs can meet one of the plan. ``shards`` None: as many as give
    ``shard_words`` words each.
    """
    key = F.xxhash64(F.lit(seed), "doc_id", "text")
    base = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), key.alias("key"),
                       F.pmod(F.xxhash64(F.lit(seed), F.lit("block"), "doc_id", "text"), F.lit(blocks)).cast("int").alias("block"),
                       *([F.struct(*(docs[c] for c in docs.columns)).alias("row")] if carry else []))
    narrow = saved(base.select("doc_id", "source", "size", "key", "block"), "mix-base")
    plan = block_plan(narrow, shards, seed, shard_words)
    base = base if carry else narrow
    out = base.join(plan, base["source"].eqNullSafe(plan["plan_source"]) & (base["block"] == plan["plan_block"]))
    n = F.when(F.col("size") > 0, F.col("passes") + F.coalesce(F.col("key") <= F.col("cut"), F.lit(False)).cast("int")).otherwise(0)
    return out.withColumn("n", n).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("n")).alias("taken"),
        F.coalesce(F.slice("shard_of", F.lit(1), F.col("n")), F.array().cast("array<int>")).alias("shards"),
        *(["row"] if carry else []))


def mixed(docs: DataFrame, shards: int | None = None, blocks: int = 4096, seed: int = 1,
          shard_words: int = 5_000_000, parts: int = 16) -> DataFrame:
    """The mix itself: rows of ``docs`` (all columns, whatever their names), each as often as it is drawn.

    Rows of a shard are dealt over ``parts`` partitions and shuffled there.
    """
    copies = draws(docs, shards, blocks, seed, shard_words, True).select("row", F.explode("shards").alias("at"))
    mixer = F.xxhash64(F.lit(seed), F.lit("row"), "at", "row.doc_id", "row.text")
    copies = copies.withColumn("mix", mixer).withColumn("part", F.pmod("mix", F.lit(parts)))
    return (copies.repartition("at", "part").sortWithinPartitions("at", F.xxhash64(F.lit(seed + 1), "mix"))
            .select(*(F.col("row")[c].alias(c) for c in docs.columns)))
