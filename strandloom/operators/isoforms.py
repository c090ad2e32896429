"""Overlap graph of transcripts: edges, components, longest isoform, evidence and decisions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.operators.components import components

PLACE = ["species", "chrom", "strand"]

#: Weights of evidence sources, and the threshold of each feature in a pairwise decision.
SOURCE_WEIGHTS = {"P": 1.0, "E": 20.0, "C": 1.0, "M": 1.0}
EDGE_THRESHOLDS = (0.0, 0.0, 0.0, 0.0)


def overlap_pairs(spans: DataFrame, start: str, end: str, key: str, bin_bits: int = 13) -> DataFrame:
    """(place, a, b) with a < b: pairs of rows of one place whose closed intervals share a base, by an equi-join on
    coordinate bins; a pair counts in the bin where its shared part starts, so no distinct is needed.

    spans: species, chrom, strand, start, end, key (unique within a place). Give distinct transcripts only.
    """
    s = spans.select(*PLACE, F.col(start).alias("s"), F.col(end).alias("e"), F.col(key).alias("k"))
    s = s.withColumn("bin", F.explode(F.sequence(F.shiftright("s", bin_bits), F.shiftright("e", bin_bits))))
    other = s.select(*PLACE, "bin", F.col("s").alias("s2"), F.col("e").alias("e2"), F.col("k").alias("k2"))
    both = s.join(other, [*PLACE, "bin"]).filter("k < k2 and s <= e2 and s2 <= e")
    return both.filter(F.shiftright(F.greatest("s", "s2"), bin_bits) == F.col("bin")).select(*PLACE, F.col("k").alias("a"), F.col("k2").alias("b"))


def frame_edges(pairs: DataFrame, cds: DataFrame, ignore_phase: bool = False) -> DataFrame:
    """Pairs (place, a, b) whose coding rows share at least two bases in one frame.

    cds: species, chrom, strand, tx_id, start, end, phase ('.' and null count as 0). The rows of both transcripts are
    listed by start (then the one that ends first, phase, end) and neighbours in that list are compared: with more
    than one shared base, equal frame of the starts (on +) or of the ends makes an edge.
    """
    from pyspark.sql import Window as W

    rows = cds.select(*PLACE, "tx_id", F.col("start").alias("s"), F.col("end").alias("e"), F.coalesce(F.col("phase").try_cast("int"), F.lit(0)).alias("p"))
    last = rows.groupBy(*PLACE, "tx_id").agg(F.max("e").alias("tx_end"))
    p = pairs.join(last.withColumnsRenamed({"tx_id": "a", "tx_end": "ea"}), [*PLACE, "a"]).join(last.withColumnsRenamed({"tx_id": "b", "tx_end": "eb"}), [*PLACE, "b"])
    a_first = F.col("ea") <= F.col("eb")
    side = p.select(*PLACE, "a", "b", F.explode(F.array(F.struct(F.when(a_first, 0).otherwise(1).alias("side"), F.col("a").alias("t")), F.struct(F.when(a_first, 1).otherwise(0).alias("side"), F.col("b").alias("t")))).alias("x"))
    listed = side.select(*PLACE, "a", "b", F.col("x.side").alias("side"), F.col("x.t").alias("tx_id")).join(rows, [*PLACE, "tx_id"])
    w = W.partitionBy(*PLACE, "a", "b").orderBy("s", "side", "p", "e")
    prev = lambda c: F.lag(c).over(w)
    shares = prev("e") - F.col("s") > 0
    starts = (F.col("strand") == "+") & (F.abs(prev("s") - prev("p") - F.col("s") + F.col("p")) % 3 == 0)
    ends = F.abs(prev("e") + prev("p") - F.col("e") - F.col("p")) % 3 == 0
    hit = shares if ignore_phase else shares & (starts | ends)
    return listed.withColumn("hit", F.coalesce(hit, F.lit(False))).groupBy(*PLACE, "a", "b").agg(F.bool_or("hit").alias("edge")).filter("edge").drop("edge")


def component_of(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """nodes(node BIGINT, ...) with component: the smallest node of its component, itself where it has no edge."""
    roots = components(edges.select(F.col("a").alias("u"), F.col("b").alias("v")))
    return nodes.join(roots, "node", "left").withColumn("component", F.coalesce("root", "node")).drop("root")


def longest_isoforms(nodes: DataFrame) -> DataFrame:
    """(component, node, cds_len): of each component the node with most coding bases, ties to the smallest node."""
    return nodes.groupBy("component").agg(F.max(F.struct("cds_len", -F.col("node"))).alias("x"), F.count("*").alias("n_tx")).select(
        "component", (-F.col("x")["col2"]).alias("node"), F.col("x.cds_len").alias("cds_len"), "n_tx"
    )


def evidence_features(parts: DataFrame, hints: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """(species, tx_id, n_parts, relative, absolute, mean): support of a transcript's parts by hints at the same place.

    parts: species, chrom, strand, tx_id, kind, start, end; hints: species, chrom, strand, kind, start, end, src, mult.
    relative is the share of parts with a hint; absolute the log of the weighted multiplicities, mean that of their
    mean over the parts. Transcripts without parts have no row (their relative support counts as 1).
    """
    weights = weights or SOURCE_WEIGHTS
    weight = F.coalesce(*[F.when(F.col("src") == s, F.lit(w)) for s, w in weights.items()], F.lit(1.0))
    at = ["species", "chrom", "strand", "kind", "start", "end"]
    support = hints.groupBy(*at).agg(F.sum(weight * F.col("mult")).alias("w"))
    joined = parts.select("tx_id", *at).distinct().join(support, at, "left")
    return joined.groupBy("species", "tx_id").agg(
        F.count("*").alias("n_parts"), F.try_divide(F.count("w"), F.count("*")).alias("relative"), F.log(F.coalesce(F.sum("w"), F.lit(0.0)) + 1e-5).alias("absolute"),
        F.log(F.coalesce(F.sum("w"), F.lit(0.0)) / F.count("*") + 1e-5).alias("mean"),
    )


def supported(nodes: DataFrame, inner: str, outer: str, least_inner: float = 0.0, least_outer: float = 0.0, single: str | None = None) -> DataFrame:
    """nodes whose inner (intron) or outer (start/stop codon) support reaches its threshold; with ``single``, the name of
    a flag, single-exon nodes also need some outer support. Null support reaches nothing."""
    ok = F.coalesce(F.col(inner) >= least_inner, F.lit(False)) | F.coalesce(F.col(outer) >= least_outer, F.lit(False))
    return nodes.filter(ok & ~(F.col(single) & (F.coalesce(outer, F.lit(0.0)) == 0)) if single else ok)


def decided(nodes: DataFrame, edges: DataFrame, features: list[str], thresholds: tuple[float, ...] = EDGE_THRESHOLDS) -> DataFrame:
    """Nodes that lose no edge: along an edge (a, b) the first feature that differs by more than its threshold removes
    the weaker node. nodes: node and the features; null features (as intron support of a single-exon transcript) differ
    from nothing."""
    f = nodes.select("node", *features)
    ab = edges.join(f.select(F.col("node").alias("a"), *[F.col(c).alias(f"a_{c}") for c in features]), "a").join(f.select(F.col("node").alias("b"), *[F.col(c).alias(f"b_{c}") for c in features]), "b")
    loser = None
    for c, t in zip(features, thresholds):
        d = F.col(f"a_{c}") - F.col(f"b_{c}")
        loser = F.when(d > t, F.col("b")).when(-d > t, F.col("a")) if loser is None else loser.when(d > t, F.col("b")).when(-d > t, F.col("a"))
    gone = ab.select(loser.alias("node")).filter("node is not null").distinct()
    return nodes.join(gone, "node", "left_anti")
