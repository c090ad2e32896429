"""Queries of names, feature frames, windows by class of coding rows and GTF records, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandloom.functions.sequence import without_type
from strandloom.operators import chunks as ch
from strandloom.operators import labels as lb
from strandloom.operators import transcripts as tx
from strandloom.operators.multivalue import pick_values
from strandloom.operators.sweep import coverage_segments
from strandloom.plans.attributes_sql import first_value, with_pairs
from strandloom.plans.genome import _CLASS_SQL, _COV, _ISLANDS, FEATURES_SQL, _big, _windows, features
from strandloom.session import materialize, table
from strandloom.sources.annotation import description_kind, gtf_records, is_numbered

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return add


@query("""SELECT species, chrom, description FROM (SELECT *, string_split_regex(trim(split_part(description, ',', 1)), ' +') AS w FROM sequences)
       WHERE w[-2] = 'chromosome' AND regexp_matches(w[-1], '^(\\p{Nd}+|\\p{L}+)$')""")
def numbered_sequences(spark, d):
    s = table(spark, d, "sequences").filter((description_kind(F.col("description")) == "chromosome") & is_numbered(F.col("description")))
    return s.select("species", "chrom", "description")


@query(f"""WITH {with_pairs("gff_features", "pz")}, v AS (SELECT feat_id, {first_value('Parent')} AS p FROM pz)
       SELECT feat_id, CASE WHEN contains(p, ':') THEN split_part(p, ':', 2) ELSE p END AS parent FROM v WHERE p IS NOT NULL""")
def parent_ids(spark, d):
    """Parents without the type that some writers put before the id (type:id)."""
    g = pick_values(table(spark, d, "gff_features").select("feat_id", "attributes"), "attributes", ["Parent"], "a_")
    return g.filter("a_Parent is not null").select("feat_id", without_type(F.col("a_Parent")).alias("parent"))


@query("""WITH c AS (SELECT chunk_id, translate(reverse(upper(seq)), 'ACGT', 'TGCA') AS seq FROM chunks)
       SELECT chunk_id, i // 40 AS "no", i + 1 AS start, least(i + 50, length(seq)) AS "end", substring(seq, CAST(i + 1 AS INT), 50) AS seq
       FROM (SELECT *, unnest(generate_series(0, length(seq) - 1, 40)) AS i FROM c WHERE length(seq) >= 50)
       UNION ALL SELECT chunk_id, 0, 0, length(seq) - 1, seq FROM c WHERE length(seq) BETWEEN 1 AND 49""")
def chunk_tail_backward(spark, d):
    c = table(spark, d, "chunks").select(F.lit("").alias("species"), F.col("chunk_id").alias("chrom"), "seq")
    return _big(ch.reverse_tail_chunks(c, 50, 10).select(F.col("chrom").alias("chunk_id"), "no", "start", "end", "seq"), "no", "start", "end")


@query(f"""WITH {FEATURES_SQL}, p AS (SELECT *, lag(e) OVER (PARTITION BY species, tx, chrom, strand ORDER BY s, e, ord) AS pe FROM cds), i AS (SELECT * FROM p WHERE s - pe >= 3),
       n AS (SELECT *, row_number() OVER (PARTITION BY species, tx, chrom, strand ORDER BY pe, s) AS k, count(*) OVER (PARTITION BY species, tx, chrom, strand) AS m FROM i)
       SELECT species, tx AS tx_id, pe + 1 AS intron_start, s - 1 AS intron_end, CASE WHEN strand = '+' THEN CASE WHEN k = 1 THEN 11 WHEN k = m THEN 13 ELSE 12 END ELSE CASE WHEN k = m THEN 13 WHEN k = 1 THEN 11 ELSE 12 END END AS acceptor_column FROM n""")
def acceptor_columns(spark, d):
    by = W.partitionBy(*tx.TX, "chrom", "strand")
    i = tx.introns(features(spark, d)).withColumn("no", F.row_number().over(by.orderBy("intron_start", "intron_end"))).withColumn("of", F.count("*").over(by))
    return i.select(*tx.TX, "intron_start", "intron_end", tx.ordinal_column(F.col("no"), F.col("of"), F.col("strand"), 11).alias("acceptor_column"))


@query(f"""WITH {FEATURES_SQL}, pi AS (SELECT *, lag(e) OVER (PARTITION BY species, tx, chrom, strand ORDER BY s, e, ord) AS pe FROM f WHERE feature = 'exon' AND tx IS NOT NULL),
       g AS (SELECT * FROM f WHERE feature = 'gene'), {_ISLANDS.format(src="g")}, n AS (SELECT *, lead(s) OVER (PARTITION BY species, chrom, strand ORDER BY s) AS ns FROM p)
       SELECT species, chrom, strand, feature, s AS start, e AS "end", tx AS tx_id FROM f
       UNION ALL SELECT species, chrom, strand, 'intron', pe + 1, s - 1, tx FROM pi WHERE s - pe >= 3
       UNION ALL SELECT species, chrom, strand, 'intergenic', e + 1, ns - 1, NULL FROM n WHERE ns IS NOT NULL""")
def feature_frame(spark, d):
    """Features, the introns between exons and the stretches between genes under each other."""
    f = materialize(features(spark, d), "features")
    i = tx.introns(f, "exon").select(*lb.PLACE, F.lit("intron").alias("feature"), F.col("intron_start").alias("start"), F.col("intron_end").alias("end"), "tx_id")
    g = coverage_segments(f.filter("feature = 'gene'"), lb.PLACE, "start", "end").filter("kind = 'gap'")
    g = g.select(*lb.PLACE, F.lit("intergenic").alias("feature"), F.col("seg_start").alias("start"), F.col("seg_end").alias("end"), F.lit(None).cast("string").alias("tx_id"))
    return f.select(*lb.PLACE, "feature", "start", "end", "tx_id").unionByName(i).unionByName(g)


# ---- windows by class of coding rows

_CLASSES = ["initial", "internal", "terminal"]
_CLASSED = f"""{_COV}, cn AS (SELECT *, row_number() OVER (PARTITION BY species, tx, chrom, strand ORDER BY s, e, ord) AS k, count(*) OVER (PARTITION BY species, tx, chrom, strand) AS m FROM cds),
       cb AS (SELECT DISTINCT species, chrom, {_CLASS_SQL} AS cls, unnest(generate_series(s + 1, e)) AS pos FROM cn WHERE s < e),
       wb AS (SELECT wi.species, wi.chrom, start, least(start + 1998, length) AS z, cls, pos FROM wi LEFT JOIN cb ON cb.species = wi.species AND cb.chrom = wi.chrom AND pos >= start AND pos < least(start + 1998, length)),
       wr AS (SELECT species, chrom, start, min(pos) - start AS a, max(pos) - start AS b FROM (SELECT *, pos - row_number() OVER (PARTITION BY species, chrom, start ORDER BY pos) AS g FROM (SELECT DISTINCT species, chrom, start, pos FROM wb WHERE pos IS NOT NULL)) GROUP BY species, chrom, start, g),
       wo AS (SELECT species, chrom, start, string_agg(a || '-' || b, ',' ORDER BY a) AS offsets FROM wr GROUP BY ALL),
       wc AS (SELECT species, chrom, start, z AS "end", count(DISTINCT pos) AS n_covered, {", ".join(f"count(pos) FILTER (cls = '{c}') AS n_{c}" for c in _CLASSES)} FROM wb GROUP BY ALL)"""


def _annotated(spark, d):
    f, w = _windows(spark, d)
    c = f.filter("feature = 'CDS' and tx_id is not null")
    classes = tx.position_classes(c).select("ord", F.col("position_class").alias("label"))
    return ch.annotated_windows(w, c.join(classes, "ord"), _CLASSES)


@query(f"WITH {_CLASSED} SELECT wc.*, coalesce(offsets, '') AS offsets FROM wc LEFT JOIN wo USING (species, chrom, start)")
def window_cds_types(spark, d):
    return _annotated(spark, d)


@query(f"WITH {_CLASSED} SELECT species, count(*) FILTER (n_covered > 0) AS n_with, count(*) FILTER (n_covered = 0) AS n_without FROM wc GROUP BY species")
def window_totals(spark, d):
    return _annotated(spark, d).groupBy("species").agg(F.count_if(F.col("n_covered") > 0).alias("n_with"), F.count_if(F.col("n_covered") == 0).alias("n_without"))


# ---- GTF with gene and transcript rows


@query(f"""WITH {FEATURES_SQL}, tg AS (SELECT species, tx, min(gene) AS gene FROM f WHERE feature IN ('mRNA', 'transcript') AND tx IS NOT NULL GROUP BY ALL),
       cn AS (SELECT cds.*, row_number() OVER (PARTITION BY species, tx, chrom, strand ORDER BY s, e, ord) AS k, count(*) OVER (PARTITION BY species, tx, chrom, strand) AS m FROM cds),
       cg AS (SELECT cn.*, coalesce(tg.gene, cn.tx || '_g') AS gid FROM cn LEFT JOIN tg USING (species, tx)),
       ln AS (SELECT species, chrom, min(source) AS source, 'gene' AS feature, min(s) AS s, max(e) AS e, strand, '.' AS phase, 'gene_id "' || gid || '";' AS info FROM cg GROUP BY species, chrom, strand, gid
              UNION ALL SELECT species, chrom, min(source), 'transcript', min(s), max(e), strand, '.', 'transcript_id "' || tx || '"; gene_id "' || gid || '";' FROM cg GROUP BY species, chrom, strand, tx, gid
              UNION ALL SELECT species, chrom, source, 'CDS', s, e, strand, coalesce(phase, '.'), 'transcript_id "' || tx || '"; gene_id "' || gid || '"; cds_type "' || {_CLASS_SQL} || '"; count "' || k || '";' FROM cg)
       SELECT species, chrom, s AS start, e AS "end", concat_ws(chr(9), chrom, coalesce(source, '.'), feature, s, e, '.', strand, phase, info) AS line FROM ln""")
def gtf_records_out(spark, d):
    """GTF lines of coding transcripts: gene and transcript rows over their coding rows, those with their class and number."""
    f = materialize(features(spark, d), "features")
    genes = f.filter("feature in ('mRNA', 'transcript') and tx_id is not null").groupBy(*tx.TX).agg(F.min("gene_id").alias("gene"))
    c = f.filter("feature = 'CDS' and tx_id is not null").drop("gene_id")
    classes = tx.position_classes(c).select("ord", F.col("no").alias("count"), F.col("position_class").alias("cds_type"))
    c = c.join(classes, "ord").join(genes, tx.TX, "left").withColumn("gene_id", F.coalesce("gene", F.concat("tx_id", F.lit("_g"))))
    return gtf_records(c)
