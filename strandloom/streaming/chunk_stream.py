"""Chunks of sequences as they arrive: a stateless stream over a folder of sequence tables.

An extension of the batch operators: chunking is per row, so the stream needs no state and no watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strandloom.operators.chunks import fixed_chunks

SEQUENCES = "species string, chrom string, description string, seq string, length bigint"


def stream_sequences(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    """Sequence rows of the Parquet files that come into folder."""
    return spark.readStream.schema(SEQUENCES).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def stream_chunks(sequences: DataFrame, size: int, overlap: int = 0, strand: str = "forward") -> DataFrame:
    """The rows of fixed_chunks, for a stream or a table."""
    return fixed_chunks(sequences, size, overlap, strand)


def start_chunks(chunks: DataFrame, path: str, checkpoint: str):
    """Append the chunks to a Parquet table, exactly once per input file, until the waiting files are done."""
    return chunks.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
