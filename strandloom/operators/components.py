"""Connected components by parallel hooking and shortcutting over a parent table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.operators.skew import hot_keys, salted_join, skew_join
from strandloom.session import drop_table, materialize


def _shortcut(parent: DataFrame) -> DataFrame:
    """parent (node, parent, up) with every parent a root. up tells that the parent may have a parent of its own: only such
    nodes are joined, so those that have arrived at a large component's root burden no reducer."""
    while True:
        go = parent.filter("up").select("node", "parent")
        moving, hot = hot_keys(go, ["parent"])
        if not moving:
            return parent
        grand = parent.select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
        gone = salted_join(go, grand, ["parent"], "inner", hot).select("node", F.col("grand").alias("parent"), (F.col("grand") != F.col("parent")).alias("up"))
        after = materialize(parent.filter("not up").unionByName(gone), "jump")
        drop_table(parent)
        parent = after


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node in edges (u BIGINT, v BIGINT): root is the component's smallest node.

    Hooking: each node takes its least neighbour as parent if that is smaller than itself. Shortcutting: parents jump
    to their parents until every parent is a root. The edges are then drawn between roots and the round repeats on
    what is left, at most half the nodes. Self-links and repeated edges do no harm; null ends are dropped; ids may be
    any BIGINT; an empty table gives no rows. Rounds are written tables in the shared folder.
    """
    cur = materialize(edges.select("u", "v").filter("u is not null and v is not null"), "edges")
    rounds = []
    while True:
        both = cur.select(F.col("u").alias("node"), F.col("v").alias("to")).unionByName(cur.select(F.col("v").alias("node"), F.col("u").alias("to")))
        least = both.groupBy("node").agg(F.min("to").alias("to"))
        parent = _shortcut(materialize(least.select("node", F.least("node", "to").alias("parent"), (F.col("to") < F.col("node")).alias("up")), "hook")).select("node", "parent")
        rounds.append(parent)
        pu = parent.select(F.col("node").alias("u"), F.col("parent").alias("pu"))
        pv = parent.select(F.col("node").alias("v"), F.col("parent").alias("pv"))
        left = skew_join(skew_join(cur, pu, ["u"], "inner"), pv, ["v"], "inner").filter("pu <> pv").select(F.least("pu", "pv").alias("u"), F.greatest("pu", "pv").alias("v")).distinct()
        left = materialize(left, "edges")
        drop_table(cur)
        cur = left
        if cur.isEmpty():
            drop_table(cur)
            break
    label = rounds[-1]
    for earlier in rounds[-2::-1]:
        label = skew_join(earlier, label.select(F.col("node").alias("parent"), F.col("parent").alias("__root")), ["parent"], "left").select(
            "node", F.coalesce("__root", "parent").alias("parent")
        )
    return label.select("node", F.col("parent").alias("root"))
