"""Transcript operators over features(species, chrom, source, feature, start, end, strand, phase, tx_id, ord).

Coordinates are 1-based closed. ord is the order of the rows where order matters; a transcript is (species, tx_id).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandloom.functions.sequence import inner_stop
from strandloom.operators.multivalue import pick_values

TX = ["species", "tx_id"]


def features_of(rows: DataFrame, attributes: str = "attributes") -> DataFrame:
    """Canonical features of gff rows: known place and strand, equal rows once (under their smallest feat_id).

    Rows with a null chr, start or end, with start after end, or a strand other than + and - are left out; rows without
    attributes keep null ids. Ids come from the quote-aware tokenizer: the first value of each key.
    """
    known = F.col("chr").isNotNull() & (F.col("start") <= F.col("end")) & F.col("strand").isin("+", "-")
    named = rows.filter(known).select("species", F.col("chr").alias("chrom"), "source", F.col("type").alias("feature"), "start", "end", "strand", "phase", "feat_id", F.col(attributes).alias("attributes"))
    named = pick_values(named, "attributes", ["ID", "Parent", "gene_id", "transcript_id"], "a_").drop("attributes")
    is_tx, is_gene = F.col("feature").isin("mRNA", "transcript"), F.col("feature") == "gene"
    tx = F.when(is_tx, F.coalesce("a_ID", "a_transcript_id")).when(~is_gene, F.coalesce("a_Parent", "a_transcript_id"))
    gene = F.when(is_gene, F.coalesce("a_ID", "a_gene_id")).when(is_tx, F.coalesce("a_Parent", "a_gene_id"))
    named = named.withColumn("tx_id", tx).withColumn("gene_id", gene).drop("a_ID", "a_Parent", "a_gene_id", "a_transcript_id")
    return named.groupBy(*[c for c in named.columns if c != "feat_id"]).agg(F.min("feat_id").alias("ord"))


def cds_length(features: DataFrame) -> DataFrame:
    """(species, tx_id, tx_len): bases of the CDS rows, of the exon rows where a transcript has no CDS."""
    width = F.col("end") - F.col("start") + 1
    part = lambda f: F.sum(F.when(F.col("feature") == f, width))
    return features.filter("tx_id is not null and feature in ('CDS', 'exon')").groupBy(*TX).agg(F.coalesce(part("CDS"), part("exon")).alias("tx_len"))


def spans(features: DataFrame) -> DataFrame:
    """(species, tx_id, chrom, strand, tx_start, tx_end, n_cds, n_exon) over the CDS and exon rows of a transcript."""
    is_ = lambda f: F.count_if(F.col("feature") == f)
    return features.filter("tx_id is not null and feature in ('CDS', 'exon')").groupBy(*TX, "chrom", "strand").agg(
        F.min("start").alias("tx_start"), F.max("end").alias("tx_end"), is_("CDS").alias("n_cds"), is_("exon").alias("n_exon")
    )


def coding_transcripts(features: DataFrame, min_bases: int = 90) -> DataFrame:
    """(species, tx_id, cds_len): transcripts with CDS rows whose bases come in whole codons and are at least min_bases."""
    width = F.col("end") - F.col("start") + 1
    return features.filter("tx_id is not null and feature = 'CDS'").groupBy(*TX).agg(F.sum(width).alias("cds_len")).filter((F.col("cds_len") % 3 == 0) & (F.col("cds_len") >= min_bases))


def sound(spliced: DataFrame, min_bases: int = 90) -> DataFrame:
    """spliced transcripts (cds_seq) of whole codons, at least min_bases, and no stop before the last codon; a transcript
    without known bases is not sound."""
    n = F.length("cds_seq")
    return spliced.filter((n % 3 == 0) & (n >= min_bases) & ~inner_stop(F.col("cds_seq")))


def genes(features: DataFrame) -> DataFrame:
    """(species, gene_id, chrom, strand, gene_start, gene_end, n_tx): spans of the transcripts of each gene. A gene id
    on several chromosomes or strands becomes gene.chrom.strand there."""
    tx = features.filter("gene_id is not null and feature in ('mRNA', 'transcript')")
    per = tx.groupBy("species", "gene_id", "chrom", "strand").agg(F.min("start").alias("gene_start"), F.max("end").alias("gene_end"), F.count("*").alias("n_tx"))
    places = F.count("*").over(W.partitionBy("species", "gene_id"))
    return per.withColumn("gene_id", F.when(places > 1, F.concat_ws(".", "gene_id", "chrom", "strand")).otherwise(F.col("gene_id")))


def _tx_rows(features: DataFrame, feature: str) -> DataFrame:
    return features.filter((F.col("feature") == feature) & F.col("tx_id").isNotNull())


def introns(features: DataFrame, feature: str = "CDS", shrink: int = 1, min_gap: int = 3) -> DataFrame:
    """(species, tx_id, chrom, strand, intron_start, intron_end): breaks between consecutive rows of a transcript.

    An intron runs from previous end + shrink to start - shrink and is kept if start - previous end >= min_gap (3:
    at least two bases; with shrink 0 and min_gap 4 the variant that names the flanking bases).
    """
    w = W.partitionBy(*TX, "chrom", "strand").orderBy("start", "end", "ord")
    return _tx_rows(features, feature).withColumn("__prev", F.lag("end").over(w)).filter(F.col("start") - F.col("__prev") >= min_gap).select(
        *TX, "chrom", "strand", (F.col("__prev") + shrink).alias("intron_start"), (F.col("start") - shrink).alias("intron_end")
    )


def merged_exons(features: DataFrame, gap: int = 5) -> DataFrame:
    """(species, tx_id, chrom, strand, start, end): exons of a transcript joined where start - previous end <= gap; the
    end is that of the last exon of a run."""
    w = W.partitionBy(*TX, "chrom", "strand").orderBy("start", "end", "ord")
    rows = _tx_rows(features, "exon").filter("start < end").withColumn("__new", F.when(F.col("start") - F.lag("end").over(w) <= gap, 0).otherwise(1))
    run = rows.withColumn("__run", F.sum("__new").over(w.rowsBetween(W.unboundedPreceding, 0)))
    return run.groupBy(*TX, "chrom", "strand", "__run").agg(F.min("start").alias("start"), F.max_by("end", F.struct("start", "end", "ord")).alias("end")).drop("__run")


def junctions(features: DataFrame, gap: int = 5) -> DataFrame:
    """(species, chrom, strand, left, right): distinct splice junctions between merged exons."""
    w = W.partitionBy(*TX, "chrom", "strand").orderBy("start", "end")
    m = merged_exons(features, gap).withColumn("__prev", F.lag("end").over(w)).filter("__prev is not null")
    return m.select("species", "chrom", "strand", (F.col("__prev") + 1).alias("left"), (F.col("start") - 1).alias("right")).distinct()


def position_classes(features: DataFrame, feature: str = "CDS") -> DataFrame:
    """(species, tx_id, ord, no, of, position_class): number in genomic order and initial/internal/terminal by strand."""
    by = W.partitionBy(*TX, "chrom", "strand")
    rows = _tx_rows(features, feature).withColumn("no", F.row_number().over(by.orderBy("start", "end", "ord"))).withColumn("of", F.count("*").over(by))
    first, last = F.col("no") == 1, F.col("no") == F.col("of")
    plus = F.col("strand") == "+"
    cls = F.when(F.col("of") == 1, "initial").when((plus & first) | (~plus & last), "initial").when(first | last, "terminal").otherwise("internal")
    return rows.select(*TX, "ord", "no", F.col("of").cast("int").alias("of"), cls.alias("position_class"))


def ordinal_column(no, of, strand, base: int):
    """Column number of a donor or acceptor: first, middle, last in transcript direction; a lone one is first on +, last
    on -."""
    plus = strand == "+"
    return F.when(plus & (no == 1), base).when(~plus & (no == of), base + 2).when(plus & (no == of), base + 2).when(~plus & (no == 1), base).otherwise(base + 1)


def merge_stops(features: DataFrame) -> DataFrame:
    """CDS rows with the transcript's stop_codon rows joined to the edge CDS: on + the last end becomes the stop's end,
    on - the first start the stop's start. Stops that begin beyond the last CDS are skipped; the last stop wins."""
    stops = features.filter("feature = 'stop_codon'").groupBy(*TX).agg(F.sort_array(F.collect_list(F.struct("ord", "start", "end"))).alias("__stops"))
    by = W.partitionBy(*TX).orderBy("start", "end", "ord")
    cds = _tx_rows(features, "CDS").withColumn("__no", F.row_number().over(by)).withColumn("__of", F.count("*").over(W.partitionBy(*TX)))
    cds = cds.withColumn("__end", F.max_by("end", F.struct("start", "end", "ord")).over(W.partitionBy(*TX))).join(stops, TX, "left")
    usable = F.filter("__stops", lambda s: s["start"] <= F.col("__end") + 1)
    last = F.try_element_at(usable, F.lit(-1))
    plus = F.col("strand") == "+"
    return cds.withColumn("end", F.when(plus & (F.col("__no") == F.col("__of")) & last.isNotNull(), last["end"]).otherwise(F.col("end"))).withColumn(
        "start", F.when(~plus & (F.col("__no") == 1) & last.isNotNull(), last["start"]).otherwise(F.col("start"))
    ).drop("__no", "__of", "__end", "__stops")


def utr_pieces(features: DataFrame) -> DataFrame:
    """(species, tx_id, chrom, strand, utr, start, end): exon bases before and after the coding span of a transcript."""
    cds = _tx_rows(features, "CDS").groupBy(*TX).agg(F.min("start").alias("__cs"), F.max("end").alias("__ce"))
    ex = _tx_rows(features, "exon").join(cds, TX)
    left = F.struct(F.lit("l").alias("side"), F.col("start").alias("s"), F.least("end", F.col("__cs") - 1).alias("e"))
    right = F.struct(F.lit("r").alias("side"), F.greatest("start", F.col("__ce") + 1).alias("s"), F.col("end").alias("e"))
    five = (F.col("x.side") == "l") == (F.col("strand") == "+")
    return ex.withColumn("x", F.explode(F.array(left, right))).filter("x.s <= x.e").select(
        *TX, "chrom", "strand", F.when(five, "five_prime_UTR").otherwise("three_prime_UTR").alias("utr"), F.col("x.s").alias("start"), F.col("x.e").alias("end")
    ).distinct()


def cds_chains(features: DataFrame) -> DataFrame:
    """(species, chrom, strand, tx_id, source, chain, tx_start, tx_end, cds_len, ord): the coding rows of each transcript
    as one string start-end-phase,..."""
    piece = F.concat_ws("-", "start", "end", F.coalesce("phase", F.lit(".")))
    return _tx_rows(features, "CDS").groupBy("species", "chrom", "strand", "tx_id").agg(
        F.min("source").alias("source"),
        F.array_join(F.transform(F.array_sort(F.collect_set(F.struct("start", "end", piece.alias("p")))), lambda x: x["p"]), ",").alias("chain"),
        F.min("start").alias("tx_start"),
        F.max("end").alias("tx_end"),
        F.sum(F.col("end") - F.col("start") + 1).alias("cds_len"),
        F.min("ord").alias("ord"),
    )


def distinct_transcripts(chains: DataFrame) -> DataFrame:
    """One transcript per (species, chrom, strand, chain): the first by (ord, tx_id), and how many there were."""
    return chains.groupBy("species", "chrom", "strand", "chain").agg(
        F.min(F.struct("ord", "tx_id")).alias("__f"), F.count("*").alias("n_equal"), F.min("tx_start").alias("tx_start"), F.max("tx_end").alias("tx_end"), F.max("cds_len").alias("cds_len")
    ).select("species", "chrom", "strand", "chain", F.col("__f.tx_id").alias("tx_id"), F.col("__f.ord").alias("ord"), "n_equal", "tx_start", "tx_end", "cds_len")


def reference_labels(chains: DataFrame, reference: DataFrame) -> DataFrame:
    """(species, tx_id, label): 1.0 if a reference transcript has the same place and coding chain, else 0.0."""
    ref = reference.select("species", "chrom", "strand", "chain").distinct().withColumn("__hit", F.lit(1.0))
    return chains.join(ref, ["species", "chrom", "strand", "chain"], "left").select(*TX, F.coalesce("__hit", F.lit(0.0)).alias("label"))
