"""Connected components of an edge table, by contraction.

Each round every node points at its smallest neighbour (or itself), pointers
are doubled until they end at a root, and the edges are rewritten between
roots; edges inside one root disappear. The loop ends when no edge is left,
there is no round limit. Every round is a table in the shared folder, so a
lost executor costs a re-read, not a re-run, and plans stay small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmint.session import materialize


def connected_components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has
    an edge to another node.

    Edges with a null end and self loops are ignored; direction and repeats do
    not matter. No edges: an empty table.
    """
    e = edges.select(F.col(u).alias("a"), F.col(v).alias("b")).where("a is not null and b is not null and a <> b")
    e = materialize(e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "cc-edges")
    labels = None
    while not e.isEmpty():
        p = materialize(e.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("p")), "cc-parents")
        while True:
            q = p.select(F.col("a").alias("p"), F.col("p").alias("pp"))
            p = materialize(p.join(q, "p").select("a", F.col("pp").alias("p"), (F.col("pp") != F.col("p")).alias("moved")), "cc-parents")
            if p.where("moved").isEmpty():
                break
            p = p.select("a", "p")
        p = p.select("a", "p")
        to_b = p.select(F.col("a").alias("b"), F.col("p").alias("pb"))
        if labels is None:
            labels = p.select(F.col("a").alias("node"), F.col("p").alias("component"))
        else:
            nxt = p.select(F.col("a").alias("component"), F.col("p").alias("nxt"))
            labels = materialize(labels.join(nxt, "component", "left")
                                 .select("node", F.coalesce("nxt", "component").alias("component")), "cc-labels")
        e = materialize(e.join(p, "a").join(to_b, "b").where("p <> pb")
                        .select(F.col("p").alias("a"), F.col("pb").alias("b")).distinct(), "cc-edges")
    if labels is None:
        return e.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels
