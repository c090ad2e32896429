"""Queries of the general table problems (p1, p2, p3, p5, p6) with their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.operators.bad_rows import rejected_lines, valid_lines
from strandloom.operators.hierarchy import hierarchy
from strandloom.operators.multivalue import explode_values, pick_values
from strandloom.operators.skew import skew_join
from strandloom.operators.sweep import coverage_segments
from strandloom.operators.tree_agg import heavy_keys, tree_aggregate
from strandloom.plans.problems_sql import SQL  # noqa: F401
from strandloom.session import materialize, table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return heavy_keys(table(spark, d, "chunks"), ["species", "chrom"], 1, 25)


def p1_key_stats(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "chunks")
    return tree_aggregate(
        c,
        ["species", "chrom"],
        {
            "n_rows": ("count_all", None),
            "n_seq": ("count", "seq"),
            "n_bases": ("sum", F.length("seq").cast("bigint")),
            "first_begin": ("min", "begin"),
            "last_end": ("max", "end"),
            "n_begins": ("count_distinct", "begin"),
        },
    )


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    genes = table(spark, d, "gff_features").filter(F.col("type") == "gene")
    return explode_values(genes, "feat_id", "attributes")


def feature_links(features: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, edges): rows of features with the smallest feat_id of their equals as node; edges(node, parent)."""
    same = [c for c in features.columns if c not in ("feat_id", "loaded_at")]
    one = features.groupBy(*same).agg(F.min("feat_id").alias("node"))
    named = pick_values(one.select("node", "species", "type", "attributes"), "attributes", ["ID", "Parent", "gene_id", "transcript_id"], "a_").drop("attributes")
    gff, gtf = F.col("a_ID").isNotNull() | F.col("a_Parent").isNotNull(), F.col("a_gene_id").isNotNull()
    gene, tx = F.col("type") == "gene", F.col("type").isin("mRNA", "transcript")
    named = materialize(
        named.select(
            "node",
            "species",
            F.when(gff, F.col("a_ID")).when(gtf & gene, F.col("a_gene_id")).when(gtf & tx, F.col("a_transcript_id")).alias("own_id"),
            F.when(gff, F.col("a_Parent")).when(gtf & gene, None).when(gtf & tx, F.col("a_gene_id")).when(gtf, F.col("a_transcript_id")).alias("parent_id"),
        ),
        "links",
    )
    owners = named.filter("own_id is not null").groupBy("species", F.col("own_id").alias("parent_id")).agg(F.min("node").alias("parent"))
    with_parent = named.filter("parent_id is not null").select("node", "species", "parent_id")
    linked = skew_join(with_parent, owners, ["species", "parent_id"], "left").select("node", "parent")
    return one, linked.unionByName(named.filter("parent_id is null").select("node", F.lit(None).cast("bigint").alias("parent")))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    _, edges = feature_links(table(spark, d, "gff_features"))
    return hierarchy(edges).select(F.col("node").alias("feat_id"), F.col("root").alias("root_feat_id"), "depth", "n_desc")


def p3_paths(spark: SparkSession, d: str) -> DataFrame:
    """Path from the root to each feature, and whether it is on a circle itself."""
    _, edges = feature_links(table(spark, d, "gff_features"))
    return hierarchy(edges).select(F.col("node").alias("feat_id"), "path", "on_circle")


def p3_descendants(spark: SparkSession, d: str) -> DataFrame:
    """(feat_id, desc_feat_id, distance): all descendants of each feature below a root; features on or below circles have
    no such pairs."""
    _, edges = feature_links(table(spark, d, "gff_features"))
    pairs = hierarchy(edges).filter("depth > 0").select(F.col("node").alias("desc_feat_id"), "depth", F.posexplode("path").alias("i", "feat_id"))
    return pairs.filter("i < depth").select("feat_id", "desc_feat_id", (F.col("depth") - F.col("i")).alias("distance"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return rejected_lines(table(spark, d, "gff_lines")).select("line_id", "reason")


def p5_edits(spark: SparkSession, d: str) -> DataFrame:
    return rejected_lines(table(spark, d, "gff_lines"))


def p5_valid(spark: SparkSession, d: str) -> DataFrame:
    return valid_lines(table(spark, d, "gff_lines"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    exons = table(spark, d, "gff_features").filter("type = 'exon' and strand in ('+', '-') and chr is not null")
    return coverage_segments(exons, ["species", "chr", "strand"], "start", "end", 10_000)


QUERIES = {f.__name__: f for f in (p1_found, p1_key_stats, p2_found, p3_found, p3_paths, p3_descendants, p5_found, p5_edits, p5_valid, p6_found)}
