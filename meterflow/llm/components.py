"""Connected components of an edge table by repeated contraction.

Every round each vertex points at the vertex of least hash among itself and
its neighbours, and the edges are rewritten to those targets; a round at least
shrinks the remaining vertices by a constant factor in expectation whatever
the shape (a star takes two rounds, a chain logarithmically many). Both steps
are joins and pre-aggregated groupings, so a vertex with a third of all edges
is no single task's work, and nothing is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.llm.scratch import saved


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component): every node of ``edges(u, v)`` and the smallest node it reaches.

    Self-links and repeated links are allowed; rows with a null end are no
    links. No edges give no rows.
    """
    def tidy(df):
        return df.filter("u != v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()

    first = edges.select("u", "v")
    loops = first.filter("u = v").select("u", F.col("u").alias("root")).distinct()
    rest, steps = saved(tidy(first), f"{name}-edges"), []
    while not rest.isEmpty():
        rank = lambda c, n=len(steps): F.struct(F.xxhash64(F.lit(n), c).alias("h"), F.col(c).alias("to"))
        both = rest.select("u", rank("v").alias("t")).union(rest.select(F.col("v").alias("u"), rank("u").alias("t")))
        to = saved(both.groupBy("u").agg(F.min("t").alias("t"))
                   .select("u", F.least("t", rank("u"))["to"].alias("to")), f"{name}-to")
        steps.append(to)
        rest = saved(tidy(rest.join(to.withColumnRenamed("to", "a"), "u")
                          .join(to.select(F.col("u").alias("v"), F.col("to").alias("b")), "v")
                          .select(F.col("a").alias("u"), F.col("b").alias("v"))), f"{name}-edges")
    if not steps:
        return loops.select(F.col("u").alias("node"), F.col("root").alias("component"))
    label = steps[0].select(F.col("u").alias("node"), F.col("to").alias("at"))
    for to in steps[1:]:
        label = label.join(to.select(F.col("u").alias("at"), "to"), "at", "left").select(
            "node", F.coalesce("to", "at").alias("at"))
    label = saved(label, f"{name}-labels")
    least = label.groupBy("at").agg(F.min("node").alias("component"))
    out = label.join(least, "at").select("node", "component")
    alone = loops.join(out, loops["u"] == out["node"], "left_anti")
    return out.union(alone.select("u", "root"))
