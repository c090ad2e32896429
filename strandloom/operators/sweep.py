"""Continuous periods and gaps of overlapping intervals by a distributed sweep line (problem 6).

Interval boundaries become plus and minus events, summed per (key, position). A prefix sum of the events tells how
many intervals are active. It is taken in two levels, so that no task sees a whole key: sums per coordinate bin are
prefixed over the bins, and inside each bin (at most 2**bin_bits positions) a window continues from the bin's carry.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def prefix_sum(df: DataFrame, keys: list[str], pos: str, sums: dict[str, str], bin_bits: int) -> DataFrame:
    """df (one row per key and position) with each sums[name] column's running sum as name, in order of pos, up to and
    with the row.

    Keys may be null (one group). Two levels: bins of 2**bin_bits positions, carried by a window over bins, which holds
    the sums of a 2**bin_bits-th of the key's coordinate range only.
    """
    binned = df.withColumn("__bin", F.shiftright(pos, bin_bits))
    over_bins = W.partitionBy(*keys).orderBy("__bin").rowsBetween(W.unboundedPreceding, -1)
    carry = binned.groupBy(*keys, "__bin").agg(*[F.sum(v).alias(f"__v_{n}") for n, v in sums.items()])
    carry = carry.select(*keys, "__bin", F.lit(0).alias("__real"), *[F.coalesce(F.sum(f"__v_{n}").over(over_bins), F.lit(0)).alias(f"__add_{n}") for n in sums])
    # the carry goes in front of its bin as one more row: no join, so null keys need no care
    rows = binned.select("*", F.lit(1).alias("__real"), *[F.col(v).cast("bigint").alias(f"__add_{n}") for n, v in sums.items()]).unionByName(carry, allowMissingColumns=True)
    inside = W.partitionBy(*keys, "__bin").orderBy("__real", pos).rowsBetween(W.unboundedPreceding, 0)
    return rows.select(*df.columns, "__real", *[F.sum(f"__add_{n}").over(inside).alias(n) for n in sums]).filter("__real = 1").drop("__real")


def prefix_max(df: DataFrame, keys: list[str], pos: str, value: str, name: str, bin_bits: int, before: bool = False, then: tuple[str, ...] = ()) -> DataFrame:
    """df with the greatest value (any orderable type, nulls ignored) of the rows up to each row as name, in order of pos and
    the columns in then; before: of the rows before it only. Two levels as in prefix_sum. As values that begin with pos
    only grow, this also finds the last row of some kind."""
    binned = df.withColumn("__bin", F.shiftright(pos, bin_bits))
    over_bins = W.partitionBy(*keys).orderBy("__bin").rowsBetween(W.unboundedPreceding, -1)
    carry = binned.groupBy(*keys, "__bin").agg(F.max(value).alias("__top"))
    carry = carry.select(*keys, "__bin", F.lit(0).alias("__real"), F.max("__top").over(over_bins).alias(value)).filter(F.col(value).isNotNull())
    rows = binned.withColumn("__real", F.lit(1)).unionByName(carry, allowMissingColumns=True)
    inside = W.partitionBy(*keys, "__bin").orderBy("__real", pos, *then).rowsBetween(W.unboundedPreceding, -1 if before else 0)
    return rows.withColumn(name, F.max(value).over(inside)).filter("__real = 1").drop("__bin", "__real")


def with_previous(df: DataFrame, keys: list[str], pos: str, value: str, name: str, bin_bits: int) -> DataFrame:
    """df (one row per key and position) with the value of the row before each one as name, null at a key's first row."""
    binned = df.withColumn("__bin", F.shiftright(pos, bin_bits))
    bins = binned.groupBy(*keys, "__bin").agg(F.max_by(value, pos).alias("__last"))
    carry = bins.select(*keys, "__bin", F.lit(0).alias("__real"), F.lag("__last").over(W.partitionBy(*keys).orderBy("__bin")).alias(value)).filter(F.col(value).isNotNull())
    rows = binned.withColumn("__real", F.lit(1)).unionByName(carry, allowMissingColumns=True)
    return rows.withColumn(name, F.lag(value).over(W.partitionBy(*keys, "__bin").orderBy("__real", pos))).filter("__real = 1").drop("__bin", "__real")


def coverage_segments(
    df: DataFrame, keys: list[str], start: str | Column, end: str | Column, max_gap: int | None = None, bin_bits: int = 14
) -> DataFrame:
    """(keys, kind, seg_start, seg_end): kind 'period' for the longest covered runs, 'gap' between neighbours.

    start and end are closed integer bounds; rows where either is null or start > end are left out. Touching intervals
    form one period. Gaps longer than max_gap are not listed. Repeated, nested and equal intervals add nothing; null
    keys form a group of their own; an empty table gives no rows. Key columns may not be named kind, seg_start, seg_end.
    """
    s, e = (F.col(c) if isinstance(c, str) else c for c in (start, end))
    rows = df.select(*keys, s.cast("bigint").alias("__s"), e.cast("bigint").alias("__e")).filter("__s <= __e")
    events = (
        rows.select(*keys, F.explode(F.array(F.struct(F.col("__s").alias("p"), F.lit(1).alias("d")), F.struct((F.col("__e") + 1).alias("p"), F.lit(-1).alias("d")))).alias("x"))
        .groupBy(*keys, F.col("x.p").alias("__p"))
        .agg(F.sum("x.d").alias("__d"))
        .filter("__d <> 0")
    )
    active = prefix_sum(events, keys, "__p", {"__n": "__d"}, bin_bits)
    # where the count leaves zero a period starts, where it comes back to zero one ends
    edges = active.select(*keys, "__p", F.when(F.col("__n") == F.col("__d"), 1).otherwise(0).cast("bigint").alias("__up"), (F.col("__n") == 0).alias("__down")).filter("__up = 1 or __down")
    numbered = prefix_sum(edges, keys, "__p", {"__k": "__up"}, bin_bits)
    opens = F.col("__up") == 1
    part = lambda kind, no, side, at: F.struct(F.lit(kind).alias("kind"), no.cast("bigint").alias("no"), F.when(F.lit(side == "s"), at).alias("s"), F.when(F.lit(side == "e"), at).alias("e"))
    p, k = F.col("__p"), F.col("__k")
    parts = F.when(opens, F.array(part("period", k, "s", p), part("gap", k - 1, "e", p - 1))).otherwise(F.array(part("period", k, "e", p - 1), part("gap", k, "s", p)))
    out = numbered.select(*keys, F.explode(parts).alias("x")).groupBy(*keys, F.col("x.kind").alias("kind"), F.col("x.no").alias("__no")).agg(
        F.min("x.s").alias("seg_start"), F.min("x.e").alias("seg_end")
    )
    keep = F.col("seg_start").isNotNull() & F.col("seg_end").isNotNull()
    if max_gap is not None:
        keep &= (F.col("kind") == "period") | (F.col("seg_end") - F.col("seg_start") < max_gap)
    return out.filter(keep).select(*keys, "kind", "seg_start", "seg_end")
