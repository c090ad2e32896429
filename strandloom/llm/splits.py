"""Splits that keep related records together (problem 4).

Relations become sparse edges between record tables; parallel hooking and shortcutting over a parent table finds the
components; a subset-sum bitset over the component sizes and their multiplicities picks the split totals.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandloom.operators.components import components
from strandloom.operators.skew import skew_join
from strandloom.session import materialize

#: Width of a coordinate bin: no window sees more than 2**BIN_BITS rows.
BIN_BITS = 14
#: Bits of the driver's table of reachable totals at most, and steps of the table of pairs of totals (cells x groups).
MOST_BITS, MOST_PAIRS = 1 << 26, 1 << 32


def forward_intervals(chunks: DataFrame, sequences: DataFrame) -> DataFrame:
    """(chunk_id, species, chrom, fb, fe): forward half-open bases of each chunk; fb is null where they are unknown.

    Backward chunks count on the reverse-complemented chromosome, whose length comes from sequences. Unknown: a null
    species, chrom, begin or end, an empty interval, or a backward chunk whose chromosome has no length.
    """
    lengths = sequences.groupBy("species", "chrom").agg(F.max("length").alias("__len"))
    c = chunks.select("chunk_id", "species", "chrom", F.col("begin").alias("b"), F.col("end").alias("e"), "strand")
    c = skew_join(c, lengths, ["species", "chrom"], "left")
    back = F.coalesce(F.col("strand") == "backward", F.lit(False))
    fb, fe = F.when(back, F.col("__len") - F.col("e")).otherwise(F.col("b")), F.when(back, F.col("__len") - F.col("b")).otherwise(F.col("e"))
    known = F.col("species").isNotNull() & F.col("chrom").isNotNull() & (fb < fe)
    return c.select("chunk_id", "species", "chrom", F.when(known, fb).alias("fb"), F.when(known, fe).alias("fe"))


def overlap_edges(starts: DataFrame) -> DataFrame:
    """Edges (u, v) of starts (species, chrom, fb, fe, node): each start to the one before it that reaches furthest.

    Two starts are in one component of these edges exactly if a chain of overlaps joins them. The furthest reach
    before a row is a prefix maximum, taken in two levels: over coordinate bins, then inside each bin.
    """
    key = ["species", "chrom"]
    binned = starts.withColumn("bin", F.shiftright("fb", BIN_BITS)).withColumn("reach", F.struct("fe", "node"))
    before = W.partitionBy(*key).orderBy("bin").rowsBetween(W.unboundedPreceding, -1)
    carry = binned.groupBy(*key, "bin").agg(F.max("reach").alias("reach")).withColumn("reach", F.max("reach").over(before)).filter("reach is not null")
    rows = binned.select(*key, "bin", "fb", "node", "reach").unionByName(carry.select(*key, "bin", F.lit(None).cast("bigint").alias("fb"), F.lit(None).cast("bigint").alias("node"), "reach"))
    inside = W.partitionBy(*key, "bin").orderBy(F.col("fb").asc_nulls_first()).rowsBetween(W.unboundedPreceding, -1)
    held = rows.withColumn("held", F.max("reach").over(inside))
    return held.filter("node is not null and held.fe > fb").select(F.col("node").alias("u"), F.col("held.node").alias("v"))


def chunk_groups(chunks: DataFrame, sequences: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(placed, starts): each chunk's interval, and each distinct start with its group (the smallest chunk_id), the number of
    its chunks and the size of its group."""
    placed = materialize(forward_intervals(chunks, sequences), "placed")
    # all chunks with one start share that base: copies and equal starts are one node. Nodes are numbered by place, so each
    # start hooks onto one before it and the first round of hooking already joins whole groups
    starts = placed.filter("fb is not null").groupBy("species", "chrom", "fb").agg(F.max("fe").alias("fe"), F.min("chunk_id").alias("first"), F.count("*").alias("n"))
    starts = materialize(starts.orderBy("species", "chrom", "fb").withColumn("node", F.monotonically_increasing_id()), "starts")
    roots = components(overlap_edges(starts))
    labelled = materialize(starts.join(roots, "node", "left").select("species", "chrom", "fb", "n", "first", F.coalesce("root", "node").alias("tree")), "labelled")
    groups = labelled.groupBy("tree").agg(F.sum("n").alias("size"), F.min("first").alias("root"))
    return placed, skew_join(labelled, groups, ["tree"], "inner").select("species", "chrom", "fb", "n", "root", "size")


def related_groups(chunks: DataFrame, sequences: DataFrame) -> DataFrame:
    """(chunk_id, group_id): chunks of groups of two or more; group_id is the group's smallest chunk_id.

    Two chunks are related if they share a forward base of one species and chrom; groups are the chains. Repeated rows
    are chunks like any other; chunks without a place (see forward_intervals) are left out; empty tables give no rows.
    """
    placed, starts = chunk_groups(chunks, sequences)
    grouped = starts.filter("size >= 2").select("species", "chrom", "fb", F.col("root").alias("group_id"))
    return skew_join(placed.filter("fb is not null"), grouped, ["species", "chrom", "fb"], "inner").select("chunk_id", "group_id")


def choose(sizes: dict[int, int], target: int) -> dict[int, int]:
    """How many groups of each size to take so that their total comes as close to target as it can (ties: below it).

    A bitset of reachable totals over the size classes, each by binary parts of its multiplicity. Nothing beyond twice
    the target can be closer than nothing at all, so the bitset has 2 * target + 1 bits. If groups taken from the
    largest down meet the target that is optimal at once; if the bitset would pass MOST_BITS, groups are taken in that
    way until it fits, and the total is the closest that goes with those (off by less than the smallest size left).
    """
    take: dict[int, int] = {}
    rest = target
    for s in sorted(sizes, reverse=True):
        k = min(sizes[s], rest // s)
        take, rest = take | {s: k}, rest - s * k
    if rest <= 0:
        return {s: k for s, k in take.items() if k} if target > 0 else {}
    take, rest = {}, target
    for s in sorted(sizes, reverse=True):
        if 2 * rest + 1 <= MOST_BITS:
            break
        # as many as are needed until the rest fits, as far as there are
        k = min(sizes[s], rest // s, -(-(rest - (MOST_BITS - 1) // 2) // s))
        take, rest = take | {s: k}, rest - s * k
    limit = 2 * rest
    if limit + 1 > MOST_BITS:
        return {s: k for s, k in take.items() if k}
    parts = []
    for s in sorted(sizes, reverse=True):
        left, k = min(sizes[s] - take.get(s, 0), limit // s), 1
        while left > 0:
            k = min(k, left)
            parts.append((s, k))
            left -= k
            k *= 2
    bits, mask, by = 1, (1 << (limit + 1)) - 1, np.full(limit + 1, -1, np.int32)
    for i, (s, k) in enumerate(parts):
        new = (bits << (s * k)) & mask & ~bits
        if new:
            by[np.flatnonzero(np.unpackbits(np.frombuffer(new.to_bytes(limit // 8 + 1, "little"), np.uint8), bitorder="little")[: limit + 1])] = i
            bits |= new
        if by[rest] >= 0:
            break
    reach = np.concatenate([[0], np.flatnonzero(by >= 0)])
    best = int(reach[np.argmin(np.abs(reach - rest))])
    while best > 0:
        s, k = parts[by[best]]
        take[s] = take.get(s, 0) + k
        best -= s * k
    return {s: k for s, k in take.items() if k}


def choose_two(sizes: dict[int, int], first: int, second: int) -> tuple[dict[int, int], dict[int, int]] | None:
    """Disjoint groups for two targets with the least sum of both distances, by a table of reachable pairs of totals; None
    if that would take more than MOST_PAIRS steps."""
    rows, cols = 2 * first + 1, 2 * second + 1
    parts = [s for s in sorted(sizes, reverse=True) for _ in range(min(sizes[s], (rows - 1) // s + (cols - 1) // s))]
    if rows * cols * max(len(parts), 1) > MOST_PAIRS:
        return None
    by = np.full((rows, cols), -1, np.int32)
    by[0, 0] = 2 * len(parts)
    for i, s in enumerate(parts):
        old = by >= 0
        for side, (new, seen) in enumerate(((by[s:], old[: rows - s]), (by[:, s:], old[:, : cols - s]))):
            if new.size:
                new[seen & (new < 0)] = 2 * i + side
        if by[first, second] >= 0:
            break
    v, t = np.nonzero(by >= 0)
    k = np.argmin(np.abs(v - first) + np.abs(t - second))
    at, got = [int(v[k]), int(t[k])], ({}, {})
    while by[at[0], at[1]] < 2 * len(parts):
        i, side = divmod(int(by[at[0], at[1]]), 2)
        got[side][parts[i]] = got[side].get(parts[i], 0) + 1
        at[side] -= parts[i]
    return got


def choose_all(sizes: dict[int, int], targets: list[int]) -> list[dict[int, int]]:
    """Disjoint groups for each target, the sum of all distances as small as it gets.

    One target after the other, in each order, is optimal where every target is met. Elsewhere two targets are chosen
    together; where that table is too large, and for more targets, the best order stands.
    """
    best, off = [{} for _ in targets], None
    for order in permutations(range(len(targets))) if len(targets) < 4 else [range(len(targets))]:
        left, got = dict(sizes), [{} for _ in targets]
        for i in order:
            got[i] = choose({s: m for s, m in left.items() if m}, targets[i])
            for s, k in got[i].items():
                left[s] -= k
        away = sum(abs(sum(s * k for s, k in g.items()) - t) for g, t in zip(got, targets))
        if off is None or away < off:
            best, off = got, away
        if not off:
            return best
    both = choose_two(sizes, *targets) if len(targets) == 2 else None
    return list(both) if both else best


def assign_splits(groups: DataFrame, shares: dict[str, float], rest: str = "train", buckets: int = 1024) -> DataFrame:
    """(root, split) for groups (root BIGINT unique, size BIGINT): no group is divided, totals as near the shares as
    whole groups allow. Groups of one size are dealt in order of a hash, so equal inputs give equal splits.

    The driver sees the number of groups of each size only (at most sqrt(2 * rows) numbers), and its tables are bounded
    by MOST_BITS and MOST_PAIRS.
    """
    counts = {int(r[0]): int(r[1]) for r in groups.groupBy("size").agg(F.count("*")).collect()}
    total = sum(s * m for s, m in counts.items())
    plan = dict(zip(shares, choose_all(counts, [round(total * share) for share in shares.values()])))
    spark = groups.sparkSession
    limits = [(s, *[sum(plan[n].get(s, 0) for n in list(shares)[: i + 1]) for i in range(len(shares))]) for s in counts]
    quota = spark.createDataFrame(limits, "size bigint, " + ", ".join(f"__q{i} bigint" for i in range(len(shares))))
    g = groups.withColumn("__b", F.pmod(F.xxhash64("root"), F.lit(buckets)))
    offset = g.groupBy("size", "__b").agg(F.count("*").alias("__n")).withColumn(
        "__off", F.coalesce(F.sum("__n").over(W.partitionBy("size").orderBy("__b").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    ).drop("__n")
    ranked = g.withColumn("__r", F.row_number().over(W.partitionBy("size", "__b").orderBy("root"))).join(offset, ["size", "__b"]).join(quota, "size")
    rank = F.col("__r") + F.col("__off")
    split = F.lit(rest)
    for i in reversed(range(len(shares))):
        split = F.when(rank <= F.col(f"__q{i}"), list(shares)[i]).otherwise(split)
    return ranked.select("root", split.alias("split"))


def split_chunks(chunks: DataFrame, sequences: DataFrame, shares: dict[str, float] | None = None) -> DataFrame:
    """(chunk_id, split): every chunk, related ones together, at 80:10:10 of the rows unless shares says otherwise.

    Chunks without a place are groups of one.
    """
    placed, starts = chunk_groups(chunks, sequences)
    starts = materialize(starts, "sized")
    lone = placed.filter("fb is null").select(F.col("chunk_id").alias("root"), F.lit(1).cast("bigint").alias("size"))
    groups = starts.select("root", "size").distinct().unionByName(lone)
    splits = materialize(assign_splits(groups, shares or {"validation": 0.1, "test": 0.1}), "splits")
    by_start = skew_join(starts.select("species", "chrom", "fb", "root"), splits, ["root"], "inner").select("species", "chrom", "fb", "split")
    near = skew_join(placed.filter("fb is not null"), by_start, ["species", "chrom", "fb"], "inner").select("chunk_id", "split")
    return near.unionByName(lone.join(splits, "root").select(F.col("root").alias("chunk_id"), "split"))
