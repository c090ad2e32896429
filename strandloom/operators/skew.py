"""Equi-joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key of fewer rows than this holds up no task.
LEAST_HOT = 1 << 14


def hot_keys(many: DataFrame, on: list[str], share: int = 200, least: int = LEAST_HOT) -> tuple[int, list[tuple]]:
    """(rows of ``many`` with known keys, keys that hold more than 1/share of them and at least ``least`` rows): fewer than
    ``share`` keys, whatever the data. One job where there are none, two else."""
    known = None
    for k in on:
        known = F.col(k).isNotNull() if known is None else known & F.col(k).isNotNull()
    counts = many.select(*on).filter(known).groupBy(*on).agg(F.count("*").alias("__n"))
    total, most = counts.agg(F.sum("__n"), F.max("__n")).first()
    if not total or most < least or most * share <= total:
        return total or 0, []
    hot = counts.filter((F.col("__n") * share > F.lit(total)) & (F.col("__n") >= least))
    return total, [tuple(r)[: len(on)] for r in hot.collect()]


def skew_join(many: DataFrame, one: DataFrame, on: list[str], how: str = "left", salts: int = 32, share: int = 200, least: int = LEAST_HOT) -> DataFrame:
    """many JOIN one USING (on), with the hot keys of ``many`` spread over ``salts`` reducers.

    The list of hot keys that is broadcast is bounded (see hot_keys). Rows of ``one`` with a hot key are copied once per
    salt, all other rows join as they are. Null keys match nothing (left: kept with nulls). how: inner or left.
    """
    return salted_join(many, one, on, how, hot_keys(many, on, share, least)[1], salts)


def salted_join(many: DataFrame, one: DataFrame, on: list[str], how: str, hot: list[tuple], salts: int = 32) -> DataFrame:
    """skew_join where the hot keys of ``many`` are known."""
    if not hot:
        return many.join(one, on, how)
    spark = many.sparkSession
    hots = F.broadcast(spark.createDataFrame(hot, many.select(*on).schema).withColumn("__hot", F.lit(True)))
    left = many.join(hots, on, "left").withColumn(
        "__salt", F.when(F.col("__hot"), F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int")).otherwise(0)
    ).drop("__hot")
    right = one.join(hots, on, "left").withColumn(
        "__salt", F.explode(F.when(F.col("__hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0))))
    ).drop("__hot")
    return left.join(right, [*on, "__salt"], how).drop("__salt")
