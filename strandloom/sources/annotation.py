"""Scans of FASTA, GTF and GFF3 files, and sinks for sequences, labels, chunks and GTF."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.functions.sequence import attribute, attribute_at, complement, reverse_complement

#: File endings of sequence files, columns of annotation files, and feature types of the 13 channels.
FASTA_ENDINGS = [".fasta", ".fna", ".fa", ".fasta.gz", ".fna.gz", ".fa.gz"]
ANNOTATION_SCHEMA = "chrom string, source string, feature string, start bigint, end bigint, score string, strand string, phase string, info string"
CHANNELS = ["enhancer", "promoter", "TF_binding_site", "exon", "gene", "mRNA", "five_prime_UTR", "CDS", "three_prime_UTR", "transcript", "Intron", "splicing_donor_site", "splicing_acceptor_site"]


def read_fasta(spark: SparkSession, path: str, keep: str = "all") -> DataFrame:
    """(file, chrom, description, seq, length): one row per record of plain or gzipped FASTA.

    keep: all; 'refseq' (name contains NC, NW, X or Y, or is all digits); 'ensembl' (first character a digit, or X, Y).
    A rejected record never leaks into the one before it. Empty records give an empty seq.
    """
    # one row per record: records are cut at the line break before '>'
    raw = spark.read.option("lineSep", "\n>").text(path).select(F.regexp_replace("value", "^>", "").alias("value"), F.col("_metadata.file_path").alias("file"))
    parts = raw.select("file", F.split("value", "\r?\n", 2).alias("p")).filter(F.trim(F.col("p")[0]) != "")
    head = F.col("p")[0]
    out = parts.select(
        "file", F.split(head, " ")[0].alias("chrom"), head.alias("description"), F.regexp_replace(F.coalesce(F.try_element_at("p", F.lit(2)), F.lit("")), r"[\r\n]", "").alias("seq")
    ).withColumn("length", F.length("seq").cast("bigint"))
    name = F.col("chrom")
    tests = {"all": F.lit(True), "refseq": is_refseq_name(name), "ensembl": is_ensembl_name(name)}
    return out.filter(tests[keep])


def is_refseq_name(name: Column) -> Column:
    return name.rlike("NC|NW|X|Y") | name.rlike("^[0-9]+$")


def is_ensembl_name(name: Column) -> Column:
    return name.rlike("^[0-9]") | name.isin("X", "Y")


def description_kind(description: Column) -> Column:
    """'chromosome' if the text before the first comma has 'chromosome' as its last but one word, 'scaffold' if its
    last word contains that, else null."""
    words = F.split(F.trim(F.split(description, ",")[0]), " +")
    return F.when(F.try_element_at(words, F.lit(-2)) == "chromosome", "chromosome").when(F.element_at(words, -1).contains("scaffold"), "scaffold")


def is_numbered(description: Column) -> Column:
    """Whether the last word before the first comma is all digits or all letters."""
    return F.element_at(F.split(F.trim(F.split(description, ",")[0]), " +"), -1).rlike(r"^(\p{Nd}+|\p{L}+)\z")


def assembled(sequences: DataFrame, group: str = "species") -> DataFrame:
    """Sequences that are whole chromosomes; of groups without any, their scaffolds."""
    kind = sequences.withColumn("__kind", description_kind(F.col("description")))
    has = kind.filter("__kind = 'chromosome'").select(group).distinct().withColumn("__has", F.lit(True))
    return kind.join(has, group, "left").filter((F.col("__kind") == "chromosome") | (F.col("__has").isNull() & (F.col("__kind") == "scaffold"))).drop("__kind", "__has")


def ensembl_length(description: Column) -> Column:
    """Chromosome length from an Ensembl header: its last but one field between colons."""
    return F.try_element_at(F.split(description, ":"), F.lit(-2)).try_cast("bigint")


def read_annotation(spark: SparkSession, path: str, feature_types: list[str] | None = None) -> DataFrame:
    """GTF or GFF3 rows with file order in ``ord``; comment and track lines left out; fields that are no numbers null."""
    rows = spark.read.csv(path, sep="\t", comment="#", schema=ANNOTATION_SCHEMA, quote="", mode="PERMISSIVE")
    rows = rows.select("*", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("ord")).filter(~F.col("chrom").startswith("track"))
    return rows.filter(F.col("feature").isin(feature_types)) if feature_types else rows


def source_kind(path: Column) -> Column:
    """'regulatory' or 'gene' by file name."""
    return F.when(F.element_at(F.split(path, "/"), -1).contains("regulatory"), "regulatory").otherwise("gene")


def path_segment(path: Column, from_end: int) -> Column:
    return F.try_element_at(F.split(path, "/"), F.lit(-from_end))


def annotations(frames: list[DataFrame]) -> DataFrame:
    """Several annotations under each other, told apart by anno_id anno1 ... annoN."""
    out = None
    for i, f in enumerate(frames):
        one = f.withColumn("anno_id", F.lit(f"anno{i + 1}"))
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out


def transcript_rows(rows: DataFrame) -> DataFrame:
    """GTF rows with tx_id and gene_id: transcript rows name theirs second, other rows by key; without gene the
    transcript's id with _g. Rows without a transcript id are left out."""
    tx = F.when(F.col("feature") == "transcript", F.coalesce(attribute(F.col("info"), "transcript_id"), attribute_at(F.col("info"), 2))).otherwise(attribute(F.col("info"), "transcript_id"))
    return rows.withColumn("tx_id", tx).filter("tx_id is not null").withColumn("gene_id", F.coalesce(attribute(F.col("info"), "gene_id"), F.concat("tx_id", F.lit("_g"))))


def gtf_lines(features: DataFrame) -> DataFrame:
    """(chrom, start, end, line): GTF lines of features (chrom, source, feature, start, end, score, strand, phase,
    tx_id, gene_id), nulls as '.'."""
    dot = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("."))
    info = F.concat(F.lit('transcript_id "'), F.col("tx_id"), F.lit('"; gene_id "'), F.col("gene_id"), F.lit('";'))
    return features.select("chrom", "start", "end", F.concat_ws("\t", dot("chrom"), dot("source"), dot("feature"), dot("start"), dot("end"), dot("score"), dot("strand"), dot("phase"), F.coalesce(info, F.lit("."))).alias("line"))


def gtf_records(cds: DataFrame) -> DataFrame:
    """(species, chrom, start, end, line): GTF lines of coding rows (species, chrom, source, start, end, strand, phase,
    tx_id, gene_id, cds_type, count), and of each transcript and gene at a place the span of its coding rows."""
    dot = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("."))
    pair = lambda k, c: F.concat(F.lit(f'{k} "'), F.col(c).cast("string"), F.lit('";'))
    gene, both = pair("gene_id", "gene_id"), F.concat_ws(" ", pair("transcript_id", "tx_id"), pair("gene_id", "gene_id"))
    rows = None
    for feature, keys, info in (("gene", ["gene_id"], gene), ("transcript", ["tx_id", "gene_id"], both)):
        g = cds.groupBy("species", "chrom", "strand", *keys).agg(F.min("source").alias("source"), F.min("start").alias("start"), F.max("end").alias("end"))
        g = g.select("species", "chrom", "source", F.lit(feature).alias("feature"), "start", "end", "strand", F.lit(None).cast("string").alias("phase"), info.alias("info"))
        rows = g if rows is None else rows.unionByName(g)
    info = F.concat_ws(" ", both, pair("cds_type", "cds_type"), pair("count", "count"))
    rows = rows.unionByName(cds.select("species", "chrom", "source", F.lit("CDS").alias("feature"), "start", "end", "strand", "phase", info.alias("info")))
    line = F.concat_ws("\t", "chrom", dot("source"), "feature", dot("start"), dot("end"), F.lit("."), "strand", dot("phase"), "info")
    return rows.select("species", "chrom", "start", "end", line.alias("line"))


def write_gtf(features: DataFrame, path: str) -> None:
    """GTF text files, ordered by (chrom, start, end) over all files."""
    gtf_lines(features).orderBy("chrom", "start", "end", "line").select("line").write.mode("overwrite").text(path)


def write_chromosomes(sequences: DataFrame, path: str, backward: str = "reverse_complement") -> None:
    """Both strands of each sequence as text under species/chrom/strand folders.

    backward: reverse_complement, complement, or none.
    """
    out = sequences.select("species", "chrom", F.lit("forward").alias("strand"), F.col("seq").alias("value"))
    if backward != "none":
        turn = reverse_complement if backward == "reverse_complement" else complement
        out = out.unionByName(sequences.select("species", "chrom", F.lit("backward").alias("strand"), turn(F.col("seq")).alias("value")))
    out.write.mode("overwrite").partitionBy("species", "chrom", "strand").text(path)


def read_chromosomes(spark: SparkSession, path: str) -> DataFrame:
    """(species, chrom, strand, seq): the text files that write_chromosomes writes, one row per sequence and strand."""
    rows = spark.read.schema("value string, species string, chrom string, strand string").text(path)
    return rows.select("species", "chrom", "strand", F.col("value").alias("seq"))


def write_fasta_info(sequences: DataFrame, path: str) -> None:
    """Lines 'chrom: description', one per sequence; nulls are empty."""
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    sequences.select(F.concat(blank("chrom"), F.lit(": "), blank("description")).alias("value")).write.mode("overwrite").text(path)


def write_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Labels and chunks as Parquet; partitions that are written again replace their old files only."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def write_chunk_tsv(chunks: DataFrame, path: str) -> None:
    chunks.select("chrom", "start", "end", "seq").write.mode("overwrite").csv(path, sep="\t")
