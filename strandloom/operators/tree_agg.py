"""Per-key aggregates over skewed keys by multi-level tree aggregation (problem 1).

Input rows are cut into fixed-size chunks; each map task combines its chunks locally (Spark's map-side partial
aggregate), and the states climb a tree of fan-in ``fan_in``: round r groups by (key, node // fan_in**r), so that no
reducer ever merges more than ``fan_in`` states of one key, however many rows the key has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number in the partition below

#: aggregate -> (state columns of a raw row, merge of each state column, final value of the state)
_STATES = {
    "count": ([lambda c: c.isNotNull().cast("long")], ["sum"], lambda s: s[0]),
    "count_all": ([lambda c: F.lit(1).cast("long")], ["sum"], lambda s: s[0]),
    "sum": ([lambda c: c], ["sum"], lambda s: s[0]),
    "min": ([lambda c: c], ["min"], lambda s: s[0]),
    "max": ([lambda c: c], ["max"], lambda s: s[0]),
    "avg": ([lambda c: c.cast("double"), lambda c: c.isNotNull().cast("long")], ["sum", "sum"], lambda s: F.try_divide(s[0], s[1])),
}


def chunk_nodes(df: DataFrame, chunk_rows: int) -> tuple[Column, int]:
    """The number of each row's fixed-size input chunk, and how many chunks there may be.

    One job over row numbers alone (no column is read) finds the number of partitions and the longest one.
    """
    rid = F.monotonically_increasing_id()
    mask = (1 << _ROW_BITS) - 1
    parts, rows = (
        df.select(rid.alias("__rid"))
        .agg(F.max(F.shiftright("__rid", _ROW_BITS)), F.max(F.col("__rid").bitwiseAND(F.lit(mask))))
        .first()
    )
    per_part = (rows or 0) // chunk_rows + 1
    node = F.shiftright(rid, _ROW_BITS) * per_part + F.floor(rid.bitwiseAND(F.lit(mask)) / chunk_rows)
    return node.cast("long"), ((parts or 0) + 1) * per_part


def tree_aggregate(
    df: DataFrame,
    keys: list[str],
    aggs: dict[str, tuple[str, str | Column | None]],
    chunk_rows: int = 1 << 16,
    fan_in: int = 16,
) -> DataFrame:
    """One row per key with the named aggregates; exact, nothing dropped.

    aggs: output name -> (count | count_all | sum | min | max | avg | count_distinct, column). Null keys form groups
    of their own as in GROUP BY; null values are ignored by every aggregate but count_all; an empty table gives no
    row. Output names may not clash with key names; extra input columns are pruned.
    """
    distinct = {n: c for n, (f, c) in aggs.items() if f == "count_distinct"}
    plain = {n: fc for n, fc in aggs.items() if fc[0] != "count_distinct"}
    as_col = lambda c: F.lit(1) if c is None else (F.col(c) if isinstance(c, str) else c)
    out = None
    if plain or not distinct:
        out = _climb(df, keys, {n: (f, as_col(c)) for n, (f, c) in plain.items()}, chunk_rows, fan_in)
    for n, c in distinct.items():
        # one row per (key, value) first: combined map-side, spread over reducers by the value
        pairs = df.select(*[F.col(k) for k in keys], as_col(c).alias("__v")).groupBy(*keys, "__v").agg(F.lit(1).alias("__one"))
        part = _climb(pairs, keys, {n: ("count", F.col("__v"))}, chunk_rows, fan_in)
        if out is None:
            out = part
        else:
            same = None
            right = part.select(*[F.col(k).alias(f"__r_{k}") for k in keys], n)
            for k in keys:
                eq = out[k].eqNullSafe(right[f"__r_{k}"])
                same = eq if same is None else same & eq
            out = out.join(right, same, "left").drop(*[f"__r_{k}" for k in keys])
    return out.select(*keys, *aggs)


def _climb(df, keys, aggs, chunk_rows, fan_in):
    node, nodes = chunk_nodes(df, chunk_rows)
    states, merges = [], []
    for i, (fn, col) in enumerate(aggs.values()):
        raw, merge, _ = _STATES[fn]
        for j, (make, how) in enumerate(zip(raw, merge)):
            states.append(make(col).alias(f"__s{i}_{j}"))
            merges.append((f"__s{i}_{j}", how))
    level = df.select(*[F.col(k) for k in keys], node.alias("__node"), *states)
    combine = [getattr(F, how)(c).alias(c) for c, how in merges]
    while nodes > 1:
        nodes = -(-nodes // fan_in)
        if nodes > 1:
            level = level.groupBy(*keys, F.floor(F.col("__node") / fan_in).alias("__node")).agg(*combine)
    level = level.groupBy(*keys).agg(*combine) if combine else level.select(*keys).distinct()
    final = []
    for i, (name, (fn, _)) in enumerate(aggs.items()):
        raw, _, done = _STATES[fn]
        final.append(done([F.col(f"__s{i}_{j}") for j in range(len(raw))]).alias(name))
    return level.select(*keys, *final)


def heavy_keys(df: DataFrame, keys: list[str], share_num: int = 1, share_den: int = 25) -> DataFrame:
    """The keys that hold at least share_num/share_den of all rows of df (rows with a null key count in the total only)."""
    total = df.count()
    counts = tree_aggregate(df, keys, {"__n": ("count_all", None)})
    known = None
    for k in keys:
        known = F.col(k).isNotNull() if known is None else known & F.col(k).isNotNull()
    return counts.filter(known & (F.col("__n") * share_den >= F.lit(total * share_num))).select(*keys)
