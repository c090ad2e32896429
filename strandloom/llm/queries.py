"""Queries of the training-data problems (p4, p7, p8, p9)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.llm.leaks import leaked
from strandloom.llm.mojibake import repaired
from strandloom.llm.splits import related_groups, split_chunks
from strandloom.llm.tokens import encode_texts
from strandloom.llm.sql import SQL  # noqa: F401
from strandloom.session import materialize, table


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return related_groups(table(spark, d, "chunks"), table(spark, d, "sequences"))


def p4_splits(spark: SparkSession, d: str) -> DataFrame:
    return split_chunks(table(spark, d, "chunks"), table(spark, d, "sequences"))


def p4_balance(spark: SparkSession, d: str) -> DataFrame:
    """(split, n_rows, n_divided): rows of each split, and how many groups have a row in it but not all of their rows."""
    splits = materialize(split_chunks(table(spark, d, "chunks"), table(spark, d, "sequences")), "balance")
    groups = related_groups(table(spark, d, "chunks"), table(spark, d, "sequences"))
    places = splits.join(groups, "chunk_id").groupBy("group_id").agg(F.min("split").alias("a"), F.max("split").alias("b")).filter("a <> b")
    divided = places.select(F.explode(F.array("a", "b")).alias("split")).groupBy("split").agg(F.count("*").alias("n_divided"))
    return splits.groupBy("split").agg(F.count("*").alias("n_rows")).join(divided, "split", "left").select("split", "n_rows", F.coalesce("n_divided", F.lit(0).cast("bigint")).alias("n_divided"))


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return encode_texts(table(spark, d, "documents"), "doc_id", "text")


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return leaked(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return repaired(table(spark, d, "documents"), "doc_id").select("doc_id")


def p9_repaired(spark: SparkSession, d: str) -> DataFrame:
    return repaired(table(spark, d, "documents"), "doc_id")


QUERIES = {f.__name__: f for f in (p4_found, p4_splits, p4_balance, p7_ids, p8_found, p9_found, p9_repaired)}
