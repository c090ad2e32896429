"""Parent-child links of unknown depth to full hierarchies (problem 3).

Level-wise frontier joins start at the roots and extend path and depth by one level per join. Only nodes that are
somebody's parent take part in the levels; all others get their row from one last join. Nodes that no frontier
reaches sit on a circle or below one: pointer doubling over them finds the circles (the nodes that repeat), and a
second frontier run starts from those. Descendants are counted from ancestor pairs, weighted by direct children.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.operators.skew import salted_join, skew_join
from strandloom.session import drop_table, materialize


#: A parent of more than 1/SHARE of all nodes is hot; its children are spread over SALTS reducers.
SHARE, SALTS = 200, 32


def _frontiers(inner: DataFrame, roots: DataFrame, levels_per_job: int, hot: list[int]) -> list[DataFrame]:
    """Tables (node, root, depth, path) of all nodes below roots, by level; path holds root ... node."""
    done, frontier, rest, depth, left = [], roots, inner, 0, inner.count()
    gone = since = 0
    while True:
        # one join a level: each row follows one line of children; nodes on several lines come once
        line = frontier.select(F.col("node").alias("at"), "root", "depth", "path", F.array().cast("array<bigint>").alias("down"))
        step = rest.select(F.col("parent").alias("at"), F.col("node").alias("child"))
        if hot:
            step = step.withColumn("salt", F.when(F.col("at").isin(hot), F.pmod("child", F.lit(SALTS))).otherwise(0).cast("int"))
        for i in range(levels_per_job):
            if hot:  # one copy of a hot node's line for each salt; the first keeps the line if it has no child
                line = line.withColumn("salt", F.explode(F.when(F.col("at").isin(hot), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))))
            line = line.join(step, ["at", "salt"] if hot else "at", "left" if i else "inner")
            if hot:
                line = line.filter("child is not null or salt = 0")
            line = line.select(
                F.col("child").alias("at"), "root", "depth", "path", F.when(F.col("child").isNull(), F.col("down")).otherwise(F.concat("down", F.array("child"))).alias("down")
            )
        block = line.select("root", "depth", "path", "down", F.posexplode("down").alias("i", "node")).dropDuplicates(["node"]).select(
            "node", "root", (F.col("depth") + F.col("i") + 1).alias("depth"), F.concat("path", F.slice("down", 1, F.col("i") + 1)).alias("path")
        )
        block = materialize(block, "levels")
        done.append(block)
        depth += levels_per_job
        found, deepest = block.agg(F.count("*"), F.max("depth")).first()
        if (deepest or 0) < depth:
            return done
        frontier = block.filter(F.col("depth") == depth)
        gone += found
        if gone * 4 > left:  # the links not yet followed are written anew when a good part of them is done with
            for b in done[since:]:
                rest = rest.join(b.select("node"), "node", "left_anti")
            rest, left, gone, since = materialize(rest, "rest"), left - gone, 0, len(done)


def hierarchy(edges: DataFrame, levels_per_job: int = 12) -> DataFrame:
    """(node, root, depth, n_desc, on_circle, path) for each row (node BIGINT unique, parent BIGINT) of edges.

    A null parent, or a parent that is no node of its own in the table, makes a root (depth 0). Nodes on a circle or
    below one have root -1, depth -1 and path null; on_circle tells the two apart. n_desc counts distinct
    descendants without the node itself. path runs from the root to the node. A self-link is a circle of one; an
    empty table gives no rows; repeated node rows are a caller's error and give repeated results.
    """
    edges = materialize(edges.select("node", "parent"), "edges")
    linked = edges.filter(F.col("parent").isNotNull())
    known = edges.select(F.col("node").alias("parent"))
    children = linked.groupBy("parent").agg(F.count("*").alias("kids")).join(known, "parent", "left_semi")
    children = materialize(children, "kids")
    # fewer than SHARE parents can be that large, whatever the data
    hot = [r[0] for r in children.filter(F.col("kids") * SHARE > edges.count()).select("parent").collect()]
    parents = children.select(F.col("parent").alias("node"), "kids")
    # rows without parent never meet in a join on it; a parent that has no row counts as none
    has = children.select("parent", F.lit(True).alias("__has"))
    below = salted_join(linked.join(parents, "node"), has, ["parent"], "left", [(h,) for h in hot])
    inner = below.select("node", F.when(F.col("__has"), F.col("parent")).alias("parent"), "kids").unionByName(edges.filter(F.col("parent").isNull()).join(parents, "node"))
    inner = materialize(inner, "inner")
    roots = inner.filter(F.col("parent").isNull()).select("node", F.col("node").alias("root"), F.lit(0).alias("depth"), F.array("node").alias("path"))
    links = inner.filter(F.col("parent").isNotNull()).select("node", "parent")
    blocks = _frontiers(links, roots, levels_per_job, hot)
    reached = roots
    for block in blocks:
        reached = reached.unionByName(block)
    reached = materialize(reached, "reached")
    lost = materialize(inner.join(reached.select("node"), "node", "left_anti"), "lost")
    pairs = reached.select(F.explode("path").alias("anc"), "node")
    kids = inner.select("node", "kids")
    tree = reached.join(pairs.join(kids, "node").groupBy("anc").agg(F.sum("kids").alias("n_desc")).withColumnRenamed("anc", "node"), "node").select(
        "node", "root", "depth", "n_desc", F.lit(False).alias("on_circle"), "path"
    )
    n_lost = lost.count()
    top = materialize(tree.unionByName(_circles(lost, levels_per_job, hot)) if n_lost else tree, "top")
    for done in (*blocks, reached, lost, inner):
        drop_table(done)
    parents = top.select(F.col("node").alias("parent"), F.col("root").alias("p_root"), F.col("depth").alias("p_depth"), F.col("path").alias("p_path"))
    leaf = lambda rows: rows.join(children.select(F.col("parent").alias("node")), "node", "left_anti")
    under = salted_join(leaf(linked), parents, ["parent"], "left", [(h,) for h in hot])
    lone, lost_leaf = F.col("p_root").isNull(), F.col("p_root") == -1
    row = lambda root, depth, path: ("node", root.alias("root"), depth.cast("int").alias("depth"), F.lit(0).cast("long").alias("n_desc"), F.lit(False).alias("on_circle"), path.alias("path"))
    return (
        top.unionByName(leaf(edges.filter(F.col("parent").isNull())).select(*row(F.col("node"), F.lit(0), F.array("node"))))
        .unionByName(under.select(*row(
            F.when(lone, F.col("node")).otherwise(F.col("p_root")),
            F.when(lone, 0).when(lost_leaf, -1).otherwise(F.col("p_depth") + 1),
            F.when(lone, F.array("node")).otherwise(F.concat("p_path", F.array("node"))),
        )))
    )


def _circles(lost: DataFrame, levels_per_job: int, hot: list[int]) -> DataFrame:
    """Rows of the inner nodes that no root reaches: on a circle, or on a tree that hangs from one."""
    # after enough doublings every pointer is on a circle, and each circle's nodes are exactly the targets
    jump = materialize(lost.select("node", F.col("parent").alias("to"), F.least("node", "parent").alias("low")), "jump")
    before = None
    while True:
        nxt = jump.select(F.col("node").alias("to"), F.col("to").alias("to2"), F.col("low").alias("low2"))
        twice = skew_join(jump, nxt, ["to"], "inner").select("node", F.col("to2").alias("to"), F.least("low", "low2").alias("low"), (F.col("low2") < F.col("low")).alias("lower"))
        after = materialize(twice, "jump")
        drop_table(jump)
        jump = after
        targets = jump.select(F.col("to").alias("node")).distinct()
        # targets that no longer get fewer are all circles; nodes of those whose least node no longer falls know it
        n, lower = jump.join(targets, "node", "left_semi").agg(F.count("*"), F.max("lower")).first()
        if n == before and not lower:
            break
        before = n
    circle = jump.join(targets, "node", "left_semi").select("node", F.col("low").alias("circle"))
    roots = circle.select("node", F.col("circle").alias("root"), F.lit(0).alias("depth"), F.array("node").alias("path"))
    links = lost.join(circle.select("node"), "node", "left_anti").select("node", "parent")
    below = None
    for block in _frontiers(links, roots, levels_per_job, hot):
        below = block if below is None else below.unionByName(block)
    kids = lost.select("node", "kids")
    whole = roots.select("node", "root").unionByName(below.select("node", "root")).join(kids, "node").groupBy("root").agg((F.sum("kids") - 1).alias("n_desc"))
    on = roots.join(whole, "root").select("node", "n_desc", F.lit(True).alias("on_circle"))
    pairs = below.select(F.explode(F.slice("path", 2, 1 << 30)).alias("anc"), "node").join(kids, "node")
    off = pairs.groupBy("anc").agg(F.sum("kids").alias("n_desc")).select(F.col("anc").alias("node"), "n_desc", F.lit(False).alias("on_circle"))
    return on.unionByName(off).select(
        "node", F.lit(-1).cast("long").alias("root"), F.lit(-1).alias("depth"), "n_desc", "on_circle", F.lit(None).cast("array<bigint>").alias("path")
    )
