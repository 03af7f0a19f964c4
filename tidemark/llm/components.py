"""Connected components of an edge table, by contraction.

In each round every node hooks onto its least neighbour, chains of hooks are shortened, and edges
are rewritten between what is left, until none are. Rounds grow with the logarithm of a component's
size. Each round is written to the shared folder, so lineage stays short; edges are reduced to
distinct ones before they move, and nothing is gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Stored, stored


def components(edges: DataFrame) -> DataFrame:
    """node, root for every node of edges (columns a, b); root is the component's least node."""
    left = Stored(edges.where("a <> b").select("a", "b").distinct(), "edges")
    rounds: list[DataFrame] = []
    while not left.rows.isEmpty():
        edges = left.rows
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = both.groupBy(F.col("a").alias("node")).agg(
            F.least(F.min("b"), F.first("a")).alias("to")
        )
        single = Stored(hooks, "hooks")
        hooks = single.rows
        for _ in range(2):  # to the hook of the hook, twice: chains of up to four steps
            up = hooks.select(F.col("node").alias("to"), F.col("to").alias("top"))
            hooks = hooks.join(up, "to").select("node", F.col("top").alias("to"))
        hooks = stored(hooks, "hooks")
        single.drop()
        rounds.append(hooks)
        at_a = hooks.select(F.col("node").alias("a"), F.col("to").alias("a2"))
        at_b = hooks.select(F.col("node").alias("b"), F.col("to").alias("b2"))
        rewritten = edges.join(at_a, "a").join(at_b, "b").where("a2 <> b2")
        before = left
        left = Stored(
            rewritten.select(F.col("a2").alias("a"), F.col("b2").alias("b")).distinct(), "edges"
        )
        before.drop()
    if not rounds:
        return left.rows.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = rounds[-1].toDF("node", "root")
    for hooks in reversed(rounds[:-1]):
        # What a node hooked onto may itself have hooked on in a later round.
        later = roots.select(F.col("node").alias("to"), "root")
        roots = (
            hooks.join(later, "to", "left")
            .select("node", F.coalesce("root", "to").alias("root"))
        )
    return roots
