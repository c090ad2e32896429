"""Several values packed in one field: one row per value, with key and position (problem 2)."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandloom.functions.attributes import byte_rows, split_values


def explode_values(df: DataFrame, id_col: str, field: str, separators: str = ";,|", brackets: str = "") -> DataFrame:
    """(id_col, pos, attr_key, val): one row per value of the packed field.

    Separators outside quotes divide the field; a piece without a key of its own is a further value of the key before
    it. Null, empty and '.' fields, empty pieces and keys without value give nothing; a value before any key gives
    nothing. An unclosed quote runs to the end of the field; text after a closing quote leaves the value as written.
    Repeated rows give repeated values. Other columns of df are not read. Narrow: one pass, no shuffle.
    """
    id_type = df.schema[id_col].dataType
    schema = T.StructType([
        T.StructField(id_col, id_type), T.StructField("pos", T.IntegerType()),
        T.StructField("attr_key", T.StringType()), T.StructField("val", T.StringType()),
    ])

    def run(batches):
        for b in batches:
            rows, pos, key, val, _ = split_values(*byte_rows(b.column(1)), separators, brackets)
            yield pa.record_batch(
                [b.column(0).take(pa.array(rows, pa.int64())), pa.array(pos, pa.int32()), pa.array(key, pa.binary()).cast(pa.string()), pa.array(val, pa.binary()).cast(pa.string())],
                names=[id_col, "pos", "attr_key", "val"],
            )

    return df.select(id_col, F.col(field)).filter(F.col(field).isNotNull()).mapInArrow(run, schema)


def pick_values(df: DataFrame, field: str, keys: list[str], prefix: str = "") -> DataFrame:
    """df with one column per key: the first value of that key in the packed field, null where there is none.

    Output columns are prefix + key and must not clash with those of df; null fields give nulls.
    """
    names = [f"{prefix}{k}" for k in keys]
    schema = T.StructType(df.schema.fields + [T.StructField(n, T.StringType()) for n in names])
    wanted = {k.encode(): i for i, k in enumerate(keys)}
    at = df.columns.index(field)

    def run(batches):
        for b in batches:
            found = [[None] * b.num_rows for _ in keys]
            rows, _, key, val, _ = split_values(*byte_rows(b.column(at)), keys=set(wanted))
            for r, k, v in zip(rows, key, val):
                if found[wanted[k]][r] is None:
                    found[wanted[k]][r] = v
            cols = [pa.array(x, pa.binary()).cast(pa.string()) for x in found]
            yield pa.record_batch([*b.columns, *cols], names=[*b.schema.names, *names])

    return df.mapInArrow(run, schema)


def attribute_pairs(df: DataFrame, id_col: str, field: str) -> DataFrame:
    """(id_col, key, val): one row per key of the packed field with the value that is named last beside it; further values
    without a key of their own are no pairs. id_col must be unique; null fields give nothing."""
    schema = T.StructType([df.schema[id_col], T.StructField("key", T.StringType()), T.StructField("val", T.StringType())])

    def run(batches):
        for b in batches:
            rows, _, key, val, _, named = split_values(*byte_rows(b.column(1)), mark=True)
            last = {(r, k): v for r, k, v, own in zip(rows, key, val, named) if own}
            at = list(last)
            yield pa.record_batch(
                [b.column(0).take(pa.array([r for r, _ in at], pa.int64())), pa.array([k for _, k in at], pa.binary()).cast(pa.string()), pa.array(list(last.values()), pa.binary()).cast(pa.string())],
                names=[id_col, "key", "val"],
            )

    return df.select(id_col, F.col(field)).filter(F.col(field).isNotNull()).mapInArrow(run, schema)
