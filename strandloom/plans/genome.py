"""Queries of the annotation operators over the given tables, each beside the SQL it must agree with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.functions import sequence as fs
from strandloom.operators import chunks as ch
from strandloom.operators import isoforms as iso
from strandloom.operators import labels as lb
from strandloom.operators import segments as sg
from strandloom.operators import transcripts as tx
from strandloom.operators.multivalue import attribute_pairs
from strandloom.operators.sweep import coverage_segments
from strandloom.operators.tree_agg import tree_aggregate
from strandloom.plans.attributes_sql import first_value, with_pairs
from strandloom.session import materialize, table
from strandloom.sources.annotation import assembled, ensembl_length, gtf_lines, is_ensembl_name, is_refseq_name, source_kind

QUERIES: dict = {}
SQL: dict[str, str] = {}

#: Base of the SQL side: canonical features as features_of() makes them.
FEATURES_SQL = f"""
    {with_pairs("gff_features", "pz")},
    r AS (SELECT species, chr AS chrom, source, type AS feature, start AS s, "end" AS e, strand, phase,
                 CASE WHEN type IN ('mRNA', 'transcript') THEN coalesce({first_value('ID')}, {first_value('transcript_id')})
                      WHEN type <> 'gene' THEN coalesce({first_value('Parent')}, {first_value('transcript_id')}) END AS tx,
                 CASE WHEN type = 'gene' THEN coalesce({first_value('ID')}, {first_value('gene_id')})
                      WHEN type IN ('mRNA', 'transcript') THEN coalesce({first_value('Parent')}, {first_value('gene_id')}) END AS gene,
                 feat_id
          FROM pz WHERE chr IS NOT NULL AND start <= "end" AND strand IN ('+', '-')),
    f AS (SELECT species, chrom, source, feature, s, e, strand, phase, tx, gene, min(feat_id) AS ord FROM r GROUP BY ALL),
    cds AS (SELECT * FROM f WHERE feature = 'CDS' AND tx IS NOT NULL)"""


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _big(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("bigint") for c in columns})


def features(spark: SparkSession, d: str) -> DataFrame:
    return tx.features_of(table(spark, d, "gff_features"))


# ---- sequences

_COUNT = lambda c: f"length(seq) - length(replace(seq, '{c}', ''))"


@query(f"""SELECT species, chrom, {", ".join(f"{_COUNT(c)} AS n_{'upper' if c.isupper() else 'lower'}_{c.lower()}" for c in fs.BASES)} FROM sequences""")
def seq_composition(spark, d):
    out = table(spark, d, "sequences").select("species", "chrom", *ch.composition(F.col("seq")))
    return _big(out, *out.columns[2:])


@query(f"""SELECT species, CAST(sum(length(seq)) AS BIGINT) AS n_bases, 100.0 * CAST(sum({_COUNT('N')}) AS DOUBLE) / sum(length(seq)) AS pct_n,
       100.0 * CAST(sum(length(seq) - length(regexp_replace(seq, '[acgt]', '', 'g'))) AS DOUBLE) / sum(length(seq)) AS pct_masked,
       CAST(sum(length(regexp_replace(seq, '[ACGTNacgt]', '', 'g'))) AS BIGINT) AS n_other FROM chunks WHERE species IS NOT NULL GROUP BY species""")
def genome_composition(spark, d):
    s = F.col("seq")
    rows = table(spark, d, "chunks").filter("species is not null").select(
        "species", F.length(s).alias("len"), fs.count_char(s, "N").alias("n"), (F.length(s) - F.length(F.regexp_replace(s, "[acgt]", ""))).alias("low"), F.length(F.regexp_replace(s, "[ACGTNacgt]", "")).alias("rest")
    )
    t = tree_aggregate(rows, ["species"], {k: ("sum", F.col(k).cast("bigint")) for k in ("len", "n", "low", "rest")})
    pct = lambda c: F.lit(100.0) * F.col(c).cast("double") / F.col("len")
    return t.select("species", F.col("len").alias("n_bases"), pct("n").alias("pct_n"), pct("low").alias("pct_masked"), F.col("rest").alias("n_other"))


@query(f"""SELECT chunk_id, translate(reverse(seq), 'ACGTacgt', 'TGCAtgca') AS rc, translate(reverse(seq), '{fs.IUPAC}', '{fs.IUPAC_COMPLEMENT}') AS rc_iupac,
       translate(seq, 'ACGTacgt', 'TGCAtgca') AS comp FROM chunks WHERE seq IS NOT NULL""")
def seq_strands(spark, d):
    s = F.col("seq")
    return table(spark, d, "chunks").filter("seq is not null").select("chunk_id", fs.reverse_complement(s).alias("rc"), fs.reverse_complement_iupac(s).alias("rc_iupac"), fs.complement(s).alias("comp"))


@query("SELECT chunk_id FROM chunks WHERE seq NOT LIKE '%N%'")
def n_free_chunks(spark, d):
    return table(spark, d, "chunks").filter(~F.col("seq").contains("N")).select("chunk_id")


@query("""SELECT chunk_id, len_ok AND NOT stop AS coding, stop AS inner_stop FROM (SELECT chunk_id, length(seq) % 3 = 0 AS len_ok,
       length(seq) >= 6 AND len(list_filter(generate_series(1, length(seq) - 5, 3), lambda i: upper(substring(seq, i, 3)) IN ('TAA', 'TAG', 'TGA', 'TAR', 'TRA'))) > 0 AS stop
       FROM chunks WHERE seq IS NOT NULL)""")
def inframe_stop(spark, d):
    c = table(spark, d, "chunks").filter("seq is not null").withColumn("inner_stop", fs.inner_stop(F.col("seq")))
    return c.select("chunk_id", ((F.length("seq") % 3 == 0) & ~F.col("inner_stop")).alias("coding"), "inner_stop")


@query("""SELECT species, chrom, description FROM (SELECT *, string_split_regex(trim(split_part(description, ',', 1)), ' +') AS w FROM sequences)
       QUALIFY coalesce(w[-2] = 'chromosome', false) OR (NOT max(coalesce(w[-2] = 'chromosome', false)) OVER (PARTITION BY species) AND contains(w[-1], 'scaffold'))""")
def assembled_sequences(spark, d):
    return assembled(table(spark, d, "sequences")).select("species", "chrom", "description")


@query("""SELECT species, chrom, regexp_matches(chrom, 'NC|NW|X|Y') OR regexp_matches(chrom, '^[0-9]+$') AS refseq, regexp_matches(chrom, '^[0-9]') OR chrom IN ('X', 'Y') AS ensembl,
       CASE WHEN len(string_split(description, ':')) > 1 THEN TRY_CAST(string_split(description, ':')[-2] AS BIGINT) END AS header_length FROM sequences""")
def name_filters(spark, d):
    s = table(spark, d, "sequences")
    return s.select("species", "chrom", is_refseq_name(F.col("chrom")).alias("refseq"), is_ensembl_name(F.col("chrom")).alias("ensembl"), ensembl_length(F.col("description")).alias("header_length"))


@query("SELECT DISTINCT line_id, CASE WHEN file_name LIKE '%regulatory%' THEN 'regulatory' ELSE 'gene' END AS kind FROM gff_lines WHERE file_name IS NOT NULL")
def line_sources(spark, d):
    return table(spark, d, "gff_lines").filter("file_name is not null").select("line_id", source_kind(F.col("file_name")).alias("kind"))


@query("""SELECT DISTINCT g.species, g.chr AS chrom FROM gff_features g JOIN (SELECT DISTINCT species, chrom FROM sequences) s ON g.species = s.species AND g.chr = s.chrom""")
def known_chroms(spark, d):
    g = table(spark, d, "gff_features").select("species", F.col("chr").alias("chrom")).distinct()
    return g.join(table(spark, d, "sequences"), ["species", "chrom"], "left_semi")


@query("SELECT feat_id FROM gff_features WHERE species IN (SELECT species FROM species_list WHERE clade = 'bird') AND type IN ('gene', 'mRNA', 'transcript', 'CDS')")
def semi_species(spark, d):
    birds = table(spark, d, "species_list").filter("clade = 'bird'")
    g = table(spark, d, "gff_features").filter(F.col("type").isin("gene", "mRNA", "transcript", "CDS"))
    return g.join(birds, "species", "left_semi").select("feat_id")


# ---- chunks over sequences


@query("""SELECT species, chrom, substring(seq, CAST(i * 90 + 1 AS INT), 99) AS seq, i * 90 AS "begin", i * 90 + 99 AS "end", 'forward' AS strand
       FROM (SELECT *, unnest(generate_series(0, (length(seq) - 9) // 90 - 1)) AS i FROM sequences WHERE length(seq) >= 99)
       UNION ALL SELECT species, chrom, substring(translate(reverse(seq), 'ACGTacgt', 'TGCAtgca'), CAST(i * 90 + 1 AS INT), 99), i * 90, i * 90 + 99, 'backward'
       FROM (SELECT *, unnest(generate_series(0, (length(seq) - 9) // 90 - 1)) AS i FROM sequences WHERE length(seq) >= 99)""")
def chunk_fixed(spark, d):
    s = table(spark, d, "sequences")
    return ch.fixed_chunks(s, 99, 9).unionByName(ch.fixed_chunks(s, 99, 9, "backward"))


@query("""SELECT chunk_id, i // 40 AS "no", i + 1 AS start, least(i + 50, length(seq)) AS "end", substring(seq, CAST(i + 1 AS INT), 50) AS seq
       FROM (SELECT *, unnest(generate_series(0, length(seq) - 1, 40)) AS i FROM chunks WHERE length(seq) >= 50)
       UNION ALL SELECT chunk_id, 0, 0, length(seq) - 1, seq FROM chunks WHERE length(seq) BETWEEN 1 AND 49""")
def chunk_tail(spark, d):
    c = table(spark, d, "chunks").select(F.lit("").alias("species"), F.col("chunk_id").alias("chrom"), "seq")
    return _big(ch.tail_chunks(c, 50, 10).select(F.col("chrom").alias("chunk_id"), "no", "start", "end", "seq"), "no", "start", "end")


@query("""WITH c AS (SELECT species, chrom, i, i * 99 + 1 AS start, i * 99 + 99 AS "end", substring(seq, CAST(i * 99 + 1 AS INT), 99) AS seq, length(seq) // 99 - 1 AS n
       FROM (SELECT *, unnest(generate_series(0, length(seq) // 99 - 1)) AS i FROM sequences WHERE length(seq) >= 99))
       SELECT species, chrom, '+' AS strand, i AS "no", start, "end", seq FROM c UNION ALL SELECT species, chrom, '-', n - i, start, "end", translate(reverse(seq), 'ACGTacgt', 'TGCAtgca') FROM c""")
def chunk_stranded(spark, d):
    return _big(ch.stranded_chunks(table(spark, d, "sequences"), 99), "no")


@query("""SELECT species, chrom, start, least(start + 9999999, length) AS "end" FROM (SELECT *, unnest(list_slice(generate_series(3000, length - 1, length // n), 1, n)) AS start
       FROM (SELECT *, CAST(floor((length // 9999999) * 1.2::DOUBLE) AS BIGINT) AS n FROM sequences) WHERE n >= 1 AND length > 3000)""")
def sample_starts(spark, d):
    return ch.sampled_starts(table(spark, d, "sequences"), 9_999_999).select("species", "chrom", "start", "end")


# ---- transcripts


@query(f"WITH {FEATURES_SQL} SELECT species, tx AS tx_id, CAST(coalesce(sum(e - s + 1) FILTER (feature = 'CDS'), sum(e - s + 1) FILTER (feature = 'exon')) AS BIGINT) AS tx_len FROM f WHERE tx IS NOT NULL AND feature IN ('CDS', 'exon') GROUP BY ALL")
def tx_cds_len(spark, d):
    return tx.cds_length(features(spark, d))


@query(f"""WITH {FEATURES_SQL} SELECT species, tx AS tx_id, chrom, strand, min(s) AS tx_start, max(e) AS tx_end, count(*) FILTER (feature = 'CDS') AS n_cds, count(*) FILTER (feature = 'exon') AS n_exon
       FROM f WHERE tx IS NOT NULL AND feature IN ('CDS', 'exon') GROUP BY ALL""")
def tx_span(spark, d):
    return tx.spans(features(spark, d))


@query(f"WITH {FEATURES_SQL} SELECT species, tx AS tx_id, CAST(sum(e - s + 1) AS BIGINT) AS cds_len FROM cds GROUP BY ALL HAVING sum(e - s + 1) % 3 = 0 AND sum(e - s + 1) >= 90")
def filter_short(spark, d):
    return tx.coding_transcripts(features(spark, d))


@query(f"""WITH {FEATURES_SQL}, g AS (SELECT species, gene, chrom, strand, min(s) AS gene_start, max(e) AS gene_end, count(*) AS n_tx FROM f WHERE gene IS NOT NULL AND feature IN ('mRNA', 'transcript') GROUP BY ALL)
       SELECT species, CASE WHEN count(*) OVER (PARTITION BY species, gene) > 1 THEN concat_ws('.', gene, chrom, strand) ELSE gene END AS gene_id, chrom, strand, gene_start, gene_end, n_tx FROM g""")
def gene_span(spark, d):
    return tx.genes(features(spark, d))


def _introns_sql(feature, least, shrink):
    return f"""WITH {FEATURES_SQL}, p AS (SELECT *, lag(e) OVER (PARTITION BY species, tx, chrom, strand ORDER BY s, e, ord) AS pe FROM f WHERE feature = '{feature}' AND tx IS NOT NULL)
       SELECT species, tx AS tx_id, chrom, strand, pe + {shrink} AS intron_start, s - {shrink} AS intron_end FROM p WHERE s - pe >= {least}"""


@query(_introns_sql("CDS", 3, 1))
def introns_cds(spark, d):
    return tx.introns(features(spark, d))


@query(_introns_sql("exon", 4, 0))
def introns_gff(spark, d):
    return tx.introns(features(spark, d), "exon", 0, 4)


_MERGED = f"""{FEATURES_SQL}, x AS (SELECT *, CASE WHEN s - lag(e) OVER w <= 5 THEN 0 ELSE 1 END AS n FROM f WHERE feature = 'exon' AND tx IS NOT NULL AND s < e WINDOW w AS (PARTITION BY species, tx, chrom, strand ORDER BY s, e, ord)),
       y AS (SELECT *, sum(n) OVER (PARTITION BY species, tx, chrom, strand ORDER BY s, e, ord ROWS UNBOUNDED PRECEDING) AS k FROM x),
       m AS (SELECT species, tx, chrom, strand, k, min(s) AS s, arg_max(e, (s, e, ord)) AS e FROM y GROUP BY ALL)"""


@query(f'WITH {_MERGED} SELECT species, tx AS tx_id, chrom, strand, s AS start, e AS "end" FROM m')
def exon_merge(spark, d):
    return tx.merged_exons(features(spark, d))


@query(f"""WITH {_MERGED}, j AS (SELECT *, lag(e) OVER (PARTITION BY species, tx, chrom, strand ORDER BY s, e) AS pe FROM m) SELECT DISTINCT species, chrom, strand, pe + 1 AS "left", s - 1 AS "right" FROM j WHERE pe IS NOT NULL""")
def junctions(spark, d):
    return tx.junctions(features(spark, d))


_ISLANDS = """i AS (SELECT *, max(e) OVER (PARTITION BY species, chrom, strand ORDER BY s, e, ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe FROM {src}),
       k AS (SELECT *, sum(CASE WHEN pe IS NULL OR s > pe + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY species, chrom, strand ORDER BY s, e, ord ROWS UNBOUNDED PRECEDING) AS no FROM i),
       p AS (SELECT species, chrom, strand, no, min(s) AS s, max(e) AS e FROM k GROUP BY ALL)"""


@query(f"""WITH {FEATURES_SQL}, g AS (SELECT * FROM f WHERE feature = 'gene'), {_ISLANDS.format(src="g")},
       n AS (SELECT *, lead(s) OVER (PARTITION BY species, chrom, strand ORDER BY s) AS ns FROM p)
       SELECT species, chrom, strand, e + 1 AS gap_start, ns - 1 AS gap_end FROM n WHERE ns IS NOT NULL""")
def intergenic_gaps(spark, d):
    g = features(spark, d).filter("feature = 'gene'")
    return coverage_segments(g, lb.PLACE, "start", "end").filter("kind = 'gap'").select(*lb.PLACE, F.col("seg_start").alias("gap_start"), F.col("seg_end").alias("gap_end"))


@query(f"""WITH {FEATURES_SQL}, n AS (SELECT *, row_number() OVER (PARTITION BY species, tx, chrom, strand ORDER BY s, e, ord) AS k, count(*) OVER (PARTITION BY species, tx, chrom, strand) AS m FROM cds)
       SELECT species, tx AS tx_id, ord, k AS "no", m AS "of", CASE WHEN m = 1 OR (strand = '+' AND k = 1) OR (strand = '-' AND k = m) THEN 'initial' WHEN k IN (1, m) THEN 'terminal' ELSE 'internal' END AS position_class FROM n""")
def position_class(spark, d):
    return _big(tx.position_classes(features(spark, d)), "no", "of")


@query(f"""WITH {FEATURES_SQL}, p AS (SELECT *, lag(e) OVER (PARTITION BY species, tx, chrom, strand ORDER BY s, e, ord) AS pe FROM cds), i AS (SELECT * FROM p WHERE s - pe >= 3),
       n AS (SELECT *, row_number() OVER (PARTITION BY species, tx, chrom, strand ORDER BY pe, s) AS k, count(*) OVER (PARTITION BY species, tx, chrom, strand) AS m FROM i)
       SELECT species, tx AS tx_id, pe + 1 AS intron_start, s - 1 AS intron_end, CASE WHEN strand = '+' THEN CASE WHEN k = 1 THEN 8 WHEN k = m THEN 10 ELSE 9 END ELSE CASE WHEN k = m THEN 10 WHEN k = 1 THEN 8 ELSE 9 END END AS donor_column FROM n""")
def donor_columns(spark, d):
    from pyspark.sql import Window as W

    by = W.partitionBy(*tx.TX, "chrom", "strand")
    i = tx.introns(features(spark, d)).withColumn("no", F.row_number().over(by.orderBy("intron_start", "intron_end"))).withColumn("of", F.count("*").over(by))
    return i.select(*tx.TX, "intron_start", "intron_end", tx.ordinal_column(F.col("no"), F.col("of"), F.col("strand"), 8).alias("donor_column"))


@query(f"""WITH {FEATURES_SQL}, c AS (SELECT species, tx, min(s) AS cs, max(e) AS ce FROM cds GROUP BY ALL), x AS (SELECT f.*, cs, ce FROM f JOIN c USING (species, tx) WHERE feature = 'exon'),
       u AS (SELECT *, 'l' AS side, s AS us, least(e, cs - 1) AS ue FROM x UNION ALL SELECT *, 'r', greatest(s, ce + 1), e FROM x)
       SELECT DISTINCT species, tx AS tx_id, chrom, strand, CASE WHEN (side = 'l') = (strand = '+') THEN 'five_prime_UTR' ELSE 'three_prime_UTR' END AS utr, us AS start, ue AS "end" FROM u WHERE us <= ue""")
def utr_pieces(spark, d):
    return tx.utr_pieces(features(spark, d))


_CHAINS = f"""{FEATURES_SQL}, d AS (SELECT DISTINCT species, chrom, strand, tx, s, e, coalesce(phase, '.') AS ph FROM cds),
       ch AS (SELECT species, chrom, strand, tx, string_agg(s || '-' || e || '-' || ph, ',' ORDER BY s, e, ph) AS chain FROM d GROUP BY ALL),
       t AS (SELECT species, chrom, strand, tx, min(source) AS source, min(s) AS s, max(e) AS e, CAST(sum(e - s + 1) AS BIGINT) AS cds_len, min(ord) AS ord FROM cds GROUP BY ALL),
       c AS (SELECT * FROM ch JOIN t USING (species, chrom, strand, tx)),
       u AS (SELECT species, chrom, strand, chain, arg_min(tx, (ord, tx)) AS tx, min(ord) AS ord, count(*) AS n_equal, min(s) AS s, max(e) AS e, max(cds_len) AS cds_len FROM c GROUP BY ALL)"""


@query(f"WITH {_CHAINS} SELECT species, chrom, strand, tx AS tx_id, n_equal, s AS tx_start, e AS tx_end, cds_len FROM u")
def dedupe_tx(spark, d):
    return tx.distinct_transcripts(tx.cds_chains(features(spark, d))).drop("chain", "ord")


@query(f"WITH {_CHAINS}, k AS (SELECT DISTINCT species, chrom, strand, chain FROM c WHERE source IN ('ensv', 'refx')) SELECT c.species, c.tx AS tx_id, CASE WHEN k.chain IS NULL THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS label FROM c LEFT JOIN k USING (species, chrom, strand, chain)")
def ref_label(spark, d):
    c = materialize(tx.cds_chains(features(spark, d)), "chains")
    return tx.reference_labels(c, c.filter("source in ('ensv', 'refx')"))


# ---- overlap graph


def _nodes(spark, d):
    f = materialize(features(spark, d), "features")
    n = tx.distinct_transcripts(tx.cds_chains(f)).withColumnRenamed("ord", "node")
    # a coding row may belong to several transcripts' first rows: nodes are numbered by their own smallest row
    return f, materialize(n, "nodes")


_PAIRS = "pr AS (SELECT a.species, a.chrom, a.strand, a.tx AS a, b.tx AS b FROM u a JOIN u b ON a.species = b.species AND a.chrom = b.chrom AND a.strand = b.strand AND a.tx < b.tx AND a.s <= b.e AND b.s <= a.e)"


@query(f"WITH {_CHAINS}, {_PAIRS} SELECT * FROM pr")
def overlap_pairs(spark, d):
    _, n = _nodes(spark, d)
    return iso.overlap_pairs(n, "tx_start", "tx_end", "tx_id")


_EDGES = f"""{_CHAINS}, {_PAIRS},
       l AS (SELECT species, chrom, strand, tx, max(e) AS te FROM cds GROUP BY ALL),
       sd AS (SELECT pr.*, pr.a AS t, CASE WHEN x.te <= y.te THEN 0 ELSE 1 END AS side FROM pr JOIN l x ON (pr.species, pr.chrom, pr.strand, pr.a) = (x.species, x.chrom, x.strand, x.tx) JOIN l y ON (pr.species, pr.chrom, pr.strand, pr.b) = (y.species, y.chrom, y.strand, y.tx)
              UNION ALL SELECT pr.*, pr.b, CASE WHEN x.te <= y.te THEN 1 ELSE 0 END FROM pr JOIN l x ON (pr.species, pr.chrom, pr.strand, pr.a) = (x.species, x.chrom, x.strand, x.tx) JOIN l y ON (pr.species, pr.chrom, pr.strand, pr.b) = (y.species, y.chrom, y.strand, y.tx)),
       li AS (SELECT sd.*, cds.s, cds.e, coalesce(TRY_CAST(phase AS INT), 0) AS p FROM sd JOIN cds ON (sd.species, sd.chrom, sd.strand, sd.t) = (cds.species, cds.chrom, cds.strand, cds.tx)),
       lg AS (SELECT *, lag(s) OVER w AS ps, lag(e) OVER w AS pe, lag(p) OVER w AS pp FROM li WINDOW w AS (PARTITION BY species, chrom, strand, a, b ORDER BY s, side, p, e)),
       ed AS (SELECT species, chrom, strand, a, b FROM lg GROUP BY ALL HAVING bool_or(pe - s > 0 AND ((strand = '+' AND abs(ps - pp - s + p) % 3 = 0) OR abs(pe + pp - e - p) % 3 = 0)))"""


def _edges(f, n):
    pairs = iso.overlap_pairs(n, "tx_start", "tx_end", "tx_id")
    cds = f.filter("feature = 'CDS' and tx_id is not null").join(n.select(*lb.PLACE, "tx_id"), [*lb.PLACE, "tx_id"], "left_semi")
    return iso.frame_edges(pairs, cds)


@query(f"WITH {_EDGES} SELECT * FROM ed")
def frame_edges(spark, d):
    return _edges(*_nodes(spark, d))


def _numbered(e, n):
    """Edges (a, b) between transcripts as edges between the numbers of their nodes."""
    ids = n.select(*lb.PLACE, "tx_id", "node")
    for side in ("a", "b"):
        e = e.join(ids.withColumnsRenamed({"tx_id": side, "node": f"n{side}"}), [*lb.PLACE, side])
    return materialize(e.select(F.col("na").alias("a"), F.col("nb").alias("b")), "graph")


def _graph(spark, d):
    f, n = _nodes(spark, d)
    return f, n, _numbered(_edges(f, n), n)


_COMPONENTS = f"""RECURSIVE {_EDGES}, w AS (SELECT x.ord AS a, y.ord AS b FROM ed JOIN u x ON (ed.species, ed.chrom, ed.strand, ed.a) = (x.species, x.chrom, x.strand, x.tx) JOIN u y ON (ed.species, ed.chrom, ed.strand, ed.b) = (y.species, y.chrom, y.strand, y.tx)),
       z AS (SELECT a, b FROM w UNION SELECT b, a FROM w), rc(node, r) AS (SELECT ord, ord FROM u UNION SELECT z.b, rc.r FROM rc JOIN z ON z.a = rc.node),
       co AS (SELECT node, min(r) AS component FROM rc GROUP BY node)"""


@query(f"WITH {_COMPONENTS} SELECT * FROM co")
def components(spark, d):
    _, n, e = _graph(spark, d)
    return iso.component_of(n.select("node"), e)


@query(f"""WITH {_COMPONENTS} SELECT component, arg_max(node, (cds_len, -node)) AS node, max(cds_len) AS cds_len, count(*) AS n_tx FROM co JOIN u ON u.ord = co.node GROUP BY component""")
def longest_isoform(spark, d):
    _, n, e = _graph(spark, d)
    return iso.longest_isoforms(iso.component_of(n.select("node", "cds_len"), e))


@query(f"""WITH {_CHAINS}, g AS (SELECT species, chrom, strand, tx, s, row_number() OVER (PARTITION BY species ORDER BY chrom, s, strand, tx) AS k FROM u) SELECT species, tx AS tx_id, 'g' || k AS new_id FROM g""")
def renamed_transcripts(spark, d):
    from pyspark.sql import Window as W

    _, n = _nodes(spark, d)
    # two levels: counts per (species, chrom, coordinate bin), then numbers inside the bin
    b = n.withColumn("bin", F.shiftright("tx_start", 14))
    off = b.groupBy("species", "chrom", "bin").agg(F.count("*").alias("c"))
    off = off.withColumn("off", F.coalesce(F.sum("c").over(W.partitionBy("species").orderBy("chrom", "bin").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("c")
    no = F.row_number().over(W.partitionBy("species", "chrom", "bin").orderBy("tx_start", "strand", "tx_id"))
    return b.withColumn("no", no).join(off, ["species", "chrom", "bin"]).select("species", "tx_id", F.concat(F.lit("g"), (F.col("no") + F.col("off")).cast("string")).alias("new_id"))


# hints: exons of the sources 'refx' and 'gnomonix' at their places, one source letter each
_HINTS = """h AS (SELECT species, chrom, strand, s, e, sum(CASE source WHEN 'refx' THEN 20.0::DOUBLE ELSE 1.0::DOUBLE END) AS w FROM f WHERE feature = 'exon' AND source IN ('refx', 'gnomonix') GROUP BY ALL),
       pt AS (SELECT DISTINCT species, chrom, strand, tx, s, e FROM f WHERE feature = 'exon' AND tx IS NOT NULL)"""


def _evidence(f):
    parts = f.filter("feature = 'exon' and tx_id is not null").select("species", "chrom", "strand", "tx_id", F.col("feature").alias("kind"), "start", "end")
    hints = f.filter("feature = 'exon' and source in ('refx', 'gnomonix')").select("species", "chrom", "strand", F.col("feature").alias("kind"), "start", "end", F.when(F.col("source") == "refx", "E").otherwise("P").alias("src"), F.lit(1).alias("mult"))
    return iso.evidence_features(parts, hints)


@query(f"WITH {FEATURES_SQL}, {_HINTS} SELECT species, tx AS tx_id, count(*) AS n_parts, count(w)::DOUBLE / count(*) AS relative, round(ln(coalesce(sum(w), 0) + 1e-5), 9) AS absolute, round(ln(coalesce(sum(w), 0) / count(*) + 1e-5), 9) AS mean FROM pt LEFT JOIN h USING (species, chrom, strand, s, e) GROUP BY ALL")
def evidence_features(spark, d):
    return _evidence(features(spark, d)).withColumns({c: F.round(c, 9) for c in ("absolute", "mean")})


_DECIDED = f"""{_EDGES}, {_HINTS}, ev AS (SELECT species, tx, count(w)::DOUBLE / count(*) AS rel FROM pt LEFT JOIN h USING (species, chrom, strand, s, e) GROUP BY ALL),
       no AS (SELECT u.species, u.chrom, u.strand, u.tx, rel, cds_len::DOUBLE AS len FROM u LEFT JOIN ev USING (species, tx)),
       dd AS (SELECT ed.*, x.rel - y.rel AS d1, x.len - y.len AS d2 FROM ed JOIN no x ON (ed.species, ed.chrom, ed.strand, ed.a) = (x.species, x.chrom, x.strand, x.tx) JOIN no y ON (ed.species, ed.chrom, ed.strand, ed.b) = (y.species, y.chrom, y.strand, y.tx)),
       lo AS (SELECT species, chrom, strand, CASE WHEN d1 > 0 THEN b WHEN -d1 > 0 THEN a WHEN d2 > 10 THEN b WHEN -d2 > 10 THEN a END AS tx FROM dd),
       kp AS (SELECT * FROM no WHERE NOT EXISTS (SELECT 1 FROM lo WHERE (lo.species, lo.chrom, lo.strand, lo.tx) = (no.species, no.chrom, no.strand, no.tx)))"""


@query(f"WITH {_DECIDED} SELECT species, tx AS tx_id FROM kp")
def decided_graph(spark, d):
    f, n, e = _graph(spark, d)
    nodes = n.select("node", "species", "tx_id", F.col("cds_len").cast("double").alias("len")).join(_evidence(f).select("species", "tx_id", "relative"), ["species", "tx_id"], "left")
    return iso.decided(nodes, e, ["relative", "len"], (0.0, 10.0)).select("species", "tx_id")


@query(f"""WITH {_CHAINS}, m AS (SELECT species, avg(cds_len) AS a, stddev_pop(cds_len) AS sd FROM u GROUP BY species) SELECT u.species, tx AS tx_id, round(CASE WHEN sd <> 0 THEN (cds_len - a) / sd END, 6) AS z FROM u JOIN m USING (species)""")
def length_zscore(spark, d):
    _, n = _nodes(spark, d)
    m = n.groupBy("species").agg(F.avg("cds_len").alias("a"), F.stddev_pop("cds_len").alias("sd"))
    return n.join(m, "species").select("species", "tx_id", F.round(F.try_divide(F.col("cds_len") - F.col("a"), F.col("sd")), 6).alias("z"))


# ---- bases under features


def _seqs(spark, d):
    return table(spark, d, "sequences").groupBy("species", "chrom").agg(F.min("seq").alias("seq"))


def _pieces(df, spark, d, start="start", end="end"):
    return ch.base_pieces(df, _seqs(spark, d), start, end)


_SEQ = "sq AS (SELECT species, chrom, min(seq) AS seq FROM sequences GROUP BY ALL HAVING length(min(seq)) > 0)"
_BASES = lambda s, e: f"substring(repeat(seq, CAST(ceil(({e} - {s} + 1) / length(seq)) AS INT) + 1), CAST(({s} - 1) % length(seq) + 1 AS INT), CAST({e} - {s} + 1 AS INT))"


@query(f"""WITH {FEATURES_SQL}, {_SEQ}, b AS (SELECT cds.*, {_BASES('s', 'e')} AS x FROM cds JOIN sq USING (species, chrom))
       SELECT species, tx AS tx_id, chrom, strand, CASE WHEN strand = '-' THEN translate(reverse(string_agg(x, '' ORDER BY s, e, ord)), '{fs.IUPAC}', '{fs.IUPAC_COMPLEMENT}') ELSE string_agg(x, '' ORDER BY s, e, ord) END AS cds_seq FROM b GROUP BY species, tx, chrom, strand""")
def cds_assembly(spark, d):
    return spliced(features(spark, d), spark, d)


def spliced(f, spark, d):
    """(species, tx_id, chrom, strand, cds_seq): the coding bases of each transcript on its strand."""
    c = _pieces(f.filter("feature = 'CDS' and tx_id is not null"), spark, d)
    pieces = F.array_sort(F.collect_list(F.struct("start", "end", "ord", "piece", "bases")))
    g = c.groupBy(*tx.TX, "chrom", "strand").agg(F.array_join(F.transform(pieces, lambda p: p["bases"]), "").alias("s"))
    return g.select(*tx.TX, "chrom", "strand", F.when(F.col("strand") == "-", fs.reverse_complement_iupac(F.col("s"))).otherwise(F.col("s")).alias("cds_seq"))


@query(f"""WITH {FEATURES_SQL}, {_SEQ}, p AS (SELECT *, lag(e) OVER (PARTITION BY species, tx, chrom, strand ORDER BY s, e, ord) AS pe FROM cds),
       b AS (SELECT species, tx, chrom, strand, pe + 1 AS a, s - 1 AS z, {_BASES('(pe + 1)', '(s - 1)')} AS x FROM p JOIN sq USING (species, chrom) WHERE s - pe >= 5),
       o AS (SELECT *, CASE WHEN strand = '-' THEN translate(reverse(x), 'ACGTacgt', 'TGCAtgca') ELSE x END AS y FROM b)
       SELECT species, tx AS tx_id, a AS intron_start, z AS intron_end, upper(left(y, 2) || right(y, 2)) AS pair, upper(left(y, 2) || right(y, 2)) IN ('GTAG', 'GCAG', 'ATAC') AS canonical FROM o""")
def splice_sites(spark, d):
    i = tx.introns(features(spark, d), min_gap=5)
    ends = F.explode(F.array(F.struct(F.col("intron_start").alias("s"), (F.col("intron_start") + 1).alias("e")), F.struct((F.col("intron_end") - 1).alias("s"), F.col("intron_end").alias("e"))))
    x = _pieces(i.withColumn("x", ends).select(*i.columns, "x.s", "x.e"), spark, d, "s", "e")
    four = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("s", "piece", "bases"))), lambda p: p["bases"]), "")
    pair = F.upper(F.when(F.col("strand") == "-", fs.reverse_complement(F.col("four"))).otherwise(F.col("four")))
    return x.groupBy(*i.columns).agg(four.alias("four")).select(*tx.TX, "intron_start", "intron_end", pair.alias("pair"), pair.isin(*fs.CANONICAL_PAIRS).alias("canonical"))


@query(f"""WITH {FEATURES_SQL}, {_SEQ}, b AS (SELECT species, {_BASES('s', 'e')} AS x FROM cds JOIN sq USING (species, chrom))
       SELECT species, CAST(sum(length(x)) AS BIGINT) AS n_bases, CAST(sum(length(x) - length(replace(x, 'N', ''))) AS BIGINT) AS n_n, CAST(sum(length(x) - length(regexp_replace(x, '[acgt]', '', 'g'))) AS BIGINT) AS n_masked FROM b GROUP BY species""")
def cds_composition(spark, d):
    x = F.col("bases")
    c = _pieces(features(spark, d).filter("feature = 'CDS' and tx_id is not null"), spark, d).select("species", "bases")
    return c.groupBy("species").agg(F.sum(F.length(x)).alias("n_bases"), F.sum(fs.count_char(x, "N")).cast("bigint").alias("n_n"), F.sum(F.length(x) - F.length(F.regexp_replace(x, "[acgt]", ""))).cast("bigint").alias("n_masked"))


# ---- labels

_FOUR = {"intron": 2, "CDS": 4, "UTR": 8, "gene": 0}


def _labelled(f):
    i = tx.introns(f, "exon").select(*lb.PLACE, F.col("intron_start").alias("start"), F.col("intron_end").alias("end"), F.lit("intron").alias("label"))
    u = tx.utr_pieces(f).select(*lb.PLACE, "start", "end", F.lit("UTR").alias("label"))
    return f.filter("feature = 'CDS'").select(*lb.PLACE, "start", "end", F.lit("CDS").alias("label")).unionByName(i).unionByName(u)


def _segments4(f):
    return lb.cover_segments(_labelled(materialize(f, "features")), lb.PLACE, {"intron": 2, "CDS": 4, "UTR": 8})


_LAB = f"""{FEATURES_SQL}, pi AS (SELECT *, lag(e) OVER (PARTITION BY species, tx, chrom, strand ORDER BY s, e, ord) AS pe FROM f WHERE feature = 'exon' AND tx IS NOT NULL),
       tc AS (SELECT species, tx, min(s) AS cs, max(e) AS ce FROM cds GROUP BY ALL), xe AS (SELECT f.*, cs, ce FROM f JOIN tc USING (species, tx) WHERE feature = 'exon'),
       lab AS (SELECT species, chrom, strand, s, e, 4 AS bit FROM f WHERE feature = 'CDS' UNION ALL SELECT species, chrom, strand, pe + 1, s - 1, 2 FROM pi WHERE s - pe >= 3
               UNION ALL SELECT species, chrom, strand, s, least(e, cs - 1), 8 FROM xe UNION ALL SELECT species, chrom, strand, greatest(s, ce + 1), e, 8 FROM xe),
       ba AS (SELECT species, chrom, strand, pos, bit_or(bit) AS mask FROM (SELECT DISTINCT species, chrom, strand, bit, unnest(generate_series(s, e)) AS pos FROM lab WHERE s <= e) GROUP BY ALL)"""


@query(f"WITH {_LAB} SELECT species, chrom, strand, mask, count(*) AS n_bases FROM ba GROUP BY ALL")
def label4(spark, d):
    return _segments4(features(spark, d)).groupBy(*lb.PLACE, "mask").agg(F.sum(F.col("e") - F.col("s") + 1).alias("n_bases"))


_CODING = f"""{FEATURES_SQL}, cb AS (SELECT species, chrom, strand, s, e, ord, coalesce(TRY_CAST(phase AS INT), 0) AS ph, unnest(generate_series(s, e)) AS pos FROM cds),
       wn AS (SELECT species, chrom, strand, pos, arg_max({{'s': s, 'e': e, 'ph': ph}}, (e, ord)) AS t FROM cb GROUP BY ALL),
       fr AS (SELECT species, chrom, strand, pos, ((CASE WHEN strand = '-' THEN t.e - pos ELSE pos - t.s END) + (3 - t.ph) % 3) % 3 AS fr FROM wn)"""


@query(f"WITH {_CODING} SELECT species, chrom, strand, 'E' || fr AS state, count(*) AS n FROM fr GROUP BY ALL")
def label7_coding(spark, d):
    c = features(spark, d).filter("feature = 'CDS' and tx_id is not null")
    return lb.state_counts(lb.coding_segments(c, lb.PLACE), lb.PLACE).filter("n > 0")


_STATES = f"""{_CODING}, pi AS (SELECT *, lag(e) OVER (PARTITION BY species, tx, chrom, strand ORDER BY s, e, ord) AS pe FROM cds),
       ir AS (SELECT DISTINCT species, chrom, strand, pe + 1 AS a, s - 1 AS z, CASE WHEN strand = '+' THEN pe ELSE s END AS pos FROM pi WHERE s - pe >= 3),
       st AS (SELECT ir.species, ir.chrom, ir.strand, a, z, 'I' || fr AS state FROM ir LEFT JOIN fr USING (species, chrom, strand, pos))"""


@query(f"WITH {_STATES} SELECT species, chrom, strand, a AS intron_start, z AS intron_end, state FROM st")
def label7_introns(spark, d):
    f = materialize(features(spark, d), "features")
    return lb.intron_states(tx.introns(f), lb.coding_segments(f.filter("feature = 'CDS' and tx_id is not null"), lb.PLACE))


_EDGE_STATES = f"""en AS (SELECT species, chrom, strand, s, e, max(ord) AS ord FROM cds GROUP BY ALL),
       sd AS (SELECT species, chrom, strand, e, ord, s AS pos, -1 AS o, strand = '+' AS five FROM en UNION ALL SELECT species, chrom, strand, e, ord, e, 1, strand = '-' FROM en),
       tp AS (SELECT species, chrom, strand, pos, arg_max({{'o': o, 'five': five}}, (e, ord, CASE WHEN five THEN 0 ELSE 1 END)) AS t FROM sd GROUP BY ALL),
       nr AS (SELECT species, chrom, strand, p, min(state) AS near FROM (SELECT *, a AS p FROM st UNION ALL SELECT *, z FROM st) WHERE state IS NOT NULL GROUP BY ALL),
       es AS (SELECT tp.species, tp.chrom, tp.strand, pos AS position, CASE WHEN near IS NULL THEN CASE WHEN t.five THEN 'START' ELSE 'STOP' END WHEN t.five THEN 'IE' || near[2] ELSE 'EI' || near[2] END AS state
       FROM tp LEFT JOIN nr ON tp.species = nr.species AND tp.chrom = nr.chrom AND tp.strand = nr.strand AND tp.pos + t.o = nr.p)"""


@query(f"WITH {_STATES}, {_EDGE_STATES} SELECT * FROM es")
def label15_edges(spark, d):
    f = materialize(features(spark, d), "features")
    c = f.filter("feature = 'CDS' and tx_id is not null")
    return lb.edge_states(c, lb.intron_states(tx.introns(f), lb.coding_segments(c, lb.PLACE)))


@query(f"""WITH {_LAB}, q AS (SELECT *, pos - row_number() OVER (PARTITION BY species, chrom, strand ORDER BY pos) AS g FROM ba WHERE mask = 2),
       rn AS (SELECT species, chrom, strand, g, min(pos) AS run_start, max(pos) AS run_end FROM q GROUP BY ALL) SELECT species, chrom, strand, run_start, run_end FROM rn WHERE run_end - run_start >= 200""")
def intron_runs(spark, d):
    s = _segments4(features(spark, d)).filter("mask = 2")
    return coverage_segments(s, lb.PLACE, "s", "e", 0).filter("kind = 'period' and seg_end - seg_start >= 200").select(*lb.PLACE, F.col("seg_start").alias("run_start"), F.col("seg_end").alias("run_end"))


# ---- chunk annotation

SIZE = 1998


@query(f"""WITH {FEATURES_SQL} SELECT species, chrom, c AS chunk_no, feature, count(*) AS n FROM (SELECT *, unnest(generate_series((s - 1) // 9999, (e - 1) // 9999)) AS c FROM f) GROUP BY ALL""")
def chunk_features(spark, d):
    return ch.chunk_features(features(spark, d), 9999)


#: Places: both strands of every sequence, and those that features name only; whole chunks of each.
_PLACES = f"""le AS (SELECT species, chrom, strand, greatest(coalesce(l, 0), coalesce(m, 0)) AS length FROM (SELECT species, chrom, strand, max(length) AS l FROM sequences, (VALUES ('+'), ('-')) v(strand) GROUP BY ALL) q
       FULL JOIN (SELECT species, chrom, strand, max(e) AS m FROM f GROUP BY ALL) k USING (species, chrom, strand)), np AS (SELECT species, chrom, strand, length // {SIZE} AS n FROM le)"""
_GRID = f"""{_LAB}, gr AS (SELECT species, chrom, strand, (pos - 1) // {SIZE} AS chunk_no, count(*) FILTER (mask & 2 <> 0) AS intron, count(*) FILTER (mask & 4 <> 0) AS coding, count(*) AS genic FROM ba GROUP BY ALL)"""
#: All chunks: cl those with a genic base, cg the runs of all others.
_RUNS = f"""{_PLACES}, cl AS (SELECT gr.* FROM gr JOIN np USING (species, chrom, strand) WHERE chunk_no < n),
       ce AS (SELECT species, chrom, strand, chunk_no FROM cl UNION ALL SELECT species, chrom, strand, -1 FROM np UNION ALL SELECT species, chrom, strand, n FROM np),
       cp AS (SELECT *, lag(chunk_no) OVER (PARTITION BY species, chrom, strand ORDER BY chunk_no) AS p FROM ce),
       cg AS (SELECT species, chrom, strand, p + 1 AS chunk_no, chunk_no - p - 1 AS n_chunks FROM cp WHERE chunk_no - p > 1)"""


def places(spark, d, f) -> DataFrame:
    """(place, length): both strands of every sequence with its length, and places that features alone name."""
    seq = table(spark, d, "sequences").groupBy("species", "chrom").agg(F.max("length").alias("l")).withColumn("strand", F.explode(F.array(F.lit("+"), F.lit("-"))))
    named = f.groupBy(*lb.PLACE).agg(F.max("end").alias("m"))
    zero = F.lit(0).cast("bigint")
    return seq.join(named, lb.PLACE, "full_outer").select(*lb.PLACE, F.greatest(F.coalesce("l", zero), F.coalesce("m", zero)).alias("length"))


def _all_chunks(listed, spark, d, f):
    """Chunks with genic bases, and runs of those without (counts 0)."""
    return ch.complete_chunks(listed, places(spark, d, f).withColumn("n", F.floor(F.col("length") / SIZE)), lb.PLACE).na.fill(0, ["intron", "coding", "genic"])


def _grid(spark, d):
    f = materialize(features(spark, d), "features")
    return _all_chunks(ch.masked_bases(lb.cover_segments(_labelled(f), lb.PLACE, {"intron": 2, "CDS": 4, "UTR": 8}), lb.PLACE, SIZE, {"intron": 2, "coding": 4, "genic": 14}), spark, d, f)


@query(f"""WITH {_GRID}, {_RUNS} SELECT species, chrom, strand, chunk_no, 1 AS n_chunks, CASE WHEN intron = {SIZE} AND coding = 0 THEN 'intron' WHEN coding >= 100 THEN 'cds' ELSE 'non' END AS label FROM cl
       UNION ALL SELECT *, 'intergenic' FROM cg""")
def chunk_class(spark, d):
    return _grid(spark, d).select(*lb.PLACE, "chunk_no", "n_chunks", ch.chunk_class(F.col("intron"), F.col("coding"), F.col("genic"), SIZE).alias("label"))


@query(f"""WITH {_GRID}, {_RUNS}, x AS (SELECT *, genic * 100 // {SIZE} AS lo, (genic * 100) % {SIZE} AS re FROM cl) SELECT species, chrom, strand, chunk_no, 1 AS n_chunks, (lo + CASE WHEN 2 * re > {SIZE} OR (2 * re = {SIZE} AND lo % 2 = 1) THEN 1 ELSE 0 END) / 100 AS fraction FROM x
       UNION ALL SELECT *, 0.0::DOUBLE FROM cg""")
def chunk_fraction(spark, d):
    return _grid(spark, d).select(*lb.PLACE, "chunk_no", "n_chunks", ch.genic_fraction(F.col("genic"), SIZE).alias("fraction"))


_CHANNELS = ["exon", "gene", "mRNA", "CDS", "transcript", "enhancer"]


@query(f"""WITH {FEATURES_SQL}, cb AS (SELECT species, chrom, feature, ord, CASE strand WHEN '+' THEN 1 ELSE 2 END AS v, unnest(generate_series(s, e)) AS pos FROM f WHERE feature IN ({", ".join(f"'{c}'" for c in _CHANNELS)})),
       w AS (SELECT species, chrom, feature, pos, arg_max(v, (ord, v)) AS v FROM cb GROUP BY ALL)
       SELECT species, chrom, (pos - 1) // 8192 AS chunk_no, feature AS channel, count(*) FILTER (v = 1) AS v1, count(*) FILTER (v = 2) AS v2, count(*) FILTER (v = 3) AS v3 FROM w GROUP BY ALL""")
def chunk_channels(spark, d):
    return ch.channel_values(features(spark, d), 8192, _CHANNELS)


@query(f"""WITH {FEATURES_SQL}, m AS (SELECT species, chrom, max((e - 1) // 9999) AS last FROM f GROUP BY ALL), g AS (SELECT species, chrom, unnest(generate_series(0, last)) AS chunk_no FROM m),
       h AS (SELECT DISTINCT species, chrom, unnest(generate_series((s - 1) // 9999, (e - 1) // 9999)) AS chunk_no FROM f) SELECT species, chrom, chunk_no FROM g ANTI JOIN h USING (species, chrom, chunk_no)""")
def empty_chunks(spark, d):
    f = features(spark, d)
    grid = f.groupBy("species", "chrom").agg(F.floor((F.max("end") - 1) / 9999).alias("last")).withColumn("chunk_no", F.explode(F.sequence(F.lit(0).cast("bigint"), "last"))).drop("last")
    return grid.join(ch.on_grid(f, 9999), ["species", "chrom", "chunk_no"], "left_anti")


@query(f"""WITH RECURSIVE {FEATURES_SQL}, pc(species, chrom, strand, a, z) AS (SELECT DISTINCT species, chrom, strand, s - 1, e - 1 FROM f WHERE feature = 'exon'
       UNION SELECT species, chrom, strand, CASE h WHEN 0 THEN a ELSE a + (z - a) // 2 + 1 END, CASE h WHEN 0 THEN a + (z - a) // 2 ELSE z END FROM pc, (VALUES (0), (1)) v(h) WHERE z - a > 148)
       SELECT DISTINCT species, chrom, strand, greatest(a - (150 - (z - a + 1)) // 2, 0) AS window_start FROM pc WHERE z - a <= 148""")
def exon_windows(spark, d):
    return ch.exon_windows(features(spark, d).filter("feature = 'exon'"), 150)


_COV = f"""{FEATURES_SQL}, le AS (SELECT species, chrom, max(e) AS length FROM f GROUP BY ALL), nn AS (SELECT *, CAST(floor((length // 1998) * 1.2::DOUBLE) AS BIGINT) AS n FROM le WHERE length > 3000),
       wi AS (SELECT species, chrom, length, unnest(list_slice(generate_series(3000, length - 1, length // n), 1, n)) AS start FROM nn WHERE n >= 1),
       pb AS (SELECT DISTINCT species, chrom, unnest(generate_series(s + 1, e)) AS pos FROM cds WHERE s < e)"""


def _windows(spark, d):
    f = materialize(features(spark, d), "features")
    w = ch.sampled_starts(f.groupBy("species", "chrom").agg(F.max("end").alias("length")), 1998)
    return f, w


@query(f"""WITH {_COV} SELECT wi.species, wi.chrom, start, least(start + 1998, length) AS "end", count(pos) AS n_covered FROM wi LEFT JOIN pb ON pb.species = wi.species AND pb.chrom = wi.chrom AND pos >= start AND pos < least(start + 1998, length) GROUP BY ALL""")
def window_cds_cov(spark, d):
    f, w = _windows(spark, d)
    return ch.covered_offsets(w, f.filter("feature = 'CDS' and tx_id is not null")).drop("n_runs")


@query(f"""WITH {FEATURES_SQL}, o AS (SELECT species, chrom, strand, (s - 1) // 9999 AS c, list(DISTINCT s ORDER BY s) AS i FROM cds GROUP BY ALL), fw AS (SELECT * FROM o WHERE strand = '+'), bw AS (SELECT * FROM o WHERE strand = '-')
       SELECT coalesce(fw.species, bw.species) AS species, coalesce(fw.chrom, bw.chrom) AS chrom, coalesce(fw.c, bw.c) AS chunk_no,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(fw.i, []), coalesce(bw.i, [])))), ',') AS starts FROM fw FULL JOIN bw ON fw.species = bw.species AND fw.chrom = bw.chrom AND fw.c = bw.c""")
def strand_merge(spark, d):
    c = features(spark, d).filter("feature = 'CDS' and tx_id is not null").withColumn("chunk_no", F.floor((F.col("start") - 1) / 9999))
    side = lambda s: c.filter(F.col("strand") == s).groupBy("species", "chrom", "chunk_no").agg(F.array_sort(F.collect_set("start")).alias("starts"))
    return ch.merged_strands(side("+"), side("-"), ["species", "chrom", "chunk_no"], "starts").withColumn("starts", F.array_join("starts", ","))


@query(f"""WITH {FEATURES_SQL} SELECT chrom, s AS start, e AS "end", concat_ws(chr(9), chrom, coalesce(source, '.'), feature, s, e, '.', strand, coalesce(phase, '.'), 'transcript_id "' || tx || '"; gene_id "' || tx || '_g";') AS line FROM f WHERE tx IS NOT NULL""")
def gtf_out(spark, d):
    f = features(spark, d).filter("tx_id is not null").withColumn("gene_id", F.concat("tx_id", F.lit("_g"))).withColumn("score", F.lit(None).cast("string"))
    return gtf_lines(f)


_CLASS_BITS = {"intron_initial": 2, "intron_internal": 4, "intron_terminal": 8, "exon_initial": 16, "exon_internal": 32, "exon_terminal": 64}
_CLASS_SQL = "CASE WHEN m = 1 OR (strand = '+' AND k = 1) OR (strand = '-' AND k = m) THEN 'initial' WHEN k IN (1, m) THEN 'terminal' ELSE 'internal' END"


@query(f"""WITH {FEATURES_SQL}, xr AS (SELECT species, tx, chrom, strand, s, e, ord, lag(e) OVER (PARTITION BY species, tx, chrom, strand ORDER BY s, e, ord) AS pe FROM f WHERE feature = 'exon' AND tx IS NOT NULL),
       xn AS (SELECT *, row_number() OVER w AS k, count(*) OVER (PARTITION BY species, tx, chrom, strand) AS m FROM xr WINDOW w AS (PARTITION BY species, tx, chrom, strand ORDER BY s, e, ord)),
       im AS (SELECT species, tx, chrom, strand, pe + 1 AS s, s - 1 AS e FROM xr WHERE s - pe >= 3), inn AS (SELECT *, row_number() OVER w AS k, count(*) OVER (PARTITION BY species, tx, chrom, strand) AS m FROM im WINDOW w AS (PARTITION BY species, tx, chrom, strand ORDER BY s, e)),
       lb AS (SELECT species, chrom, strand, s, e, 'exon_' || {_CLASS_SQL} AS label FROM xn UNION ALL SELECT species, chrom, strand, s, e, 'intron_' || {_CLASS_SQL} FROM inn),
       bs AS (SELECT DISTINCT species, chrom, strand, label, unnest(generate_series(s, e)) AS pos FROM lb WHERE s <= e),
       mk AS (SELECT species, chrom, strand, pos, sum(CASE label {" ".join(f"WHEN '{k}' THEN {v}" for k, v in _CLASS_BITS.items())} END) AS mask FROM bs GROUP BY ALL)
       SELECT species, chrom, strand, CAST(mask AS INT) AS mask, count(*) AS n_bases FROM mk GROUP BY ALL""")
def label17(spark, d):
    from pyspark.sql import Window as W

    f = materialize(features(spark, d), "features")
    exons = tx.position_classes(f, "exon").select("ord", F.concat(F.lit("exon_"), "position_class").alias("label")).join(f.filter("feature = 'exon'"), "ord").select(*lb.PLACE, "start", "end", "label")
    i = tx.introns(f, "exon").select(*tx.TX, "chrom", "strand", F.col("intron_start").alias("start"), F.col("intron_end").alias("end"), F.lit("exon").alias("feature"))
    i = i.withColumn("ord", F.row_number().over(W.partitionBy(*tx.TX, "chrom", "strand").orderBy("start", "end")))
    classes = tx.position_classes(i, "exon").withColumnRenamed("position_class", "label").select(*tx.TX, "ord", F.concat(F.lit("intron_"), "label").alias("label"))
    both = i.join(classes, [*tx.TX, "ord"]).select(*lb.PLACE, "start", "end", "label").unionByName(exons)
    return lb.cover_segments(both, lb.PLACE, _CLASS_BITS).groupBy(*lb.PLACE, "mask").agg(F.sum(F.col("e") - F.col("s") + 1).alias("n_bases"))


@query(f"""WITH {FEATURES_SQL}, g AS (SELECT * FROM f WHERE feature = 'gene'), {_ISLANDS.format(src="g")},
       n AS (SELECT *, e + 1 AS b, lead(s) OVER (PARTITION BY species, chrom, strand ORDER BY s) AS ns FROM p)
       SELECT species, b AS start, b + 1999 AS "end" FROM n WHERE ns - b >= 2000 QUALIFY row_number() OVER (PARTITION BY species ORDER BY md5(concat_ws('|', species, b, 42)), b) <= 50""")
def intergenic_samples(spark, d):
    """Up to 50 windows of 2000 bases a species from the gaps between genes, drawn by a seeded hash."""
    g = coverage_segments(features(spark, d).filter("feature = 'gene'"), lb.PLACE, "start", "end").filter("kind = 'gap'")
    return ch.sampled_windows(g.select(*lb.PLACE, F.col("seg_start").alias("s"), F.col("seg_end").alias("e")), 2000, 50, ["species"])


@query(f"""WITH {with_pairs("gff_features", "pz")}, u AS (SELECT feat_id, unnest(ps) AS x, generate_subscripts(ps, 1) AS i FROM pz)
       SELECT feat_id, x.k AS key, arg_max(x.v, i) AS val FROM u WHERE x.k <> '' AND x.v <> '' GROUP BY ALL""")
def attribute_maps(spark, d):
    """All pairs of each attribute field; of equal keys the last named one wins. Further values of a key are no pairs."""
    return attribute_pairs(table(spark, d, "gff_features"), "feat_id", "attributes")


@query(f"""WITH {FEATURES_SQL}, n AS (SELECT species, source, tx, min(ord) AS ord FROM cds GROUP BY ALL), d AS (SELECT *, row_number() OVER (PARTITION BY species, tx ORDER BY ord) AS k FROM n)
       SELECT species, source, tx AS tx_id, CASE WHEN k = 1 THEN tx ELSE 'duplicate.' || tx || '.' || (k - 1) END AS new_id FROM d""")
def duplicate_ids(spark, d):
    from pyspark.sql import Window as W

    n = features(spark, d).filter("feature = 'CDS' and tx_id is not null").groupBy("species", "source", "tx_id").agg(F.min("ord").alias("ord"))
    k = F.row_number().over(W.partitionBy("species", "tx_id").orderBy("ord"))
    return n.withColumn("k", k).select("species", "source", "tx_id", F.when(F.col("k") == 1, F.col("tx_id")).otherwise(F.concat_ws(".", F.lit("duplicate"), "tx_id", (F.col("k") - 1).cast("string"))).alias("new_id"))


@query(f"""WITH RECURSIVE {_DECIDED}, kn AS (SELECT u.species, u.chrom, u.strand, u.tx, u.ord FROM u JOIN kp ON (u.species, u.chrom, u.strand, u.tx) = (kp.species, kp.chrom, kp.strand, kp.tx)),
       kw AS (SELECT x.ord AS a, y.ord AS b FROM ed JOIN kn x ON (ed.species, ed.chrom, ed.strand, ed.a) = (x.species, x.chrom, x.strand, x.tx) JOIN kn y ON (ed.species, ed.chrom, ed.strand, ed.b) = (y.species, y.chrom, y.strand, y.tx)),
       kz AS (SELECT a, b FROM kw UNION SELECT b, a FROM kw), kr(node, r) AS (SELECT ord, ord FROM kn UNION SELECT kz.b, kr.r FROM kr JOIN kz ON kz.a = kr.node)
       SELECT node, min(r) AS component FROM kr GROUP BY node""")
def decided_components(spark, d):
    """Components of the overlap graph once the weaker ends of its edges are removed."""
    f, n, e = _graph(spark, d)
    nodes = n.select("node", "species", "tx_id", F.col("cds_len").cast("double").alias("len")).join(_evidence(f).select("species", "tx_id", "relative"), ["species", "tx_id"], "left")
    kept = materialize(iso.decided(nodes, e, ["relative", "len"], (0.0, 10.0)).select("node"), "kept")
    left = e.join(kept.withColumnRenamed("node", "a"), "a", "left_semi").join(kept.withColumnRenamed("node", "b"), "b", "left_semi")
    return iso.component_of(kept, left)


_SEGMENTS = f"""{_STATES}, {_PLACES.split(", np AS")[0]}, {_EDGE_STATES},
       ib AS (SELECT species, chrom, strand, pos, bit_or(CASE state WHEN 'I0' THEN 1 WHEN 'I1' THEN 2 ELSE 4 END) AS im FROM (SELECT DISTINCT species, chrom, strand, state, unnest(generate_series(a, z)) AS pos FROM st WHERE state IS NOT NULL) GROUP BY ALL),
       eb AS (SELECT species, chrom, strand, pos, ((fr - CASE strand WHEN '-' THEN -pos ELSE pos END) % 3 + 3) % 3 AS still FROM fr),
       ed AS (SELECT species, chrom, strand, position AS pos, state AS edge FROM es),
       al AS (SELECT species, chrom, strand, pos, coalesce(im, 0) AS im, still, edge FROM eb FULL JOIN ib USING (species, chrom, strand, pos) FULL JOIN ed USING (species, chrom, strand, pos)),
       nu AS (SELECT *, pos - row_number() OVER (PARTITION BY species, chrom, strand, im, still, edge ORDER BY pos) AS g FROM al),
       ru AS (SELECT species, chrom, strand, im, still, edge, g, min(pos) AS s, max(pos) AS e FROM nu GROUP BY ALL)"""
_STATE_AT = lambda p: f"""coalesce(edge, CASE WHEN still IS NULL THEN substring(CASE WHEN im & 1 > 0 THEN '+I0' ELSE '' END || CASE WHEN im & 2 > 0 THEN '+I1' ELSE '' END || CASE WHEN im & 4 > 0 THEN '+I2' ELSE '' END, 2)
       ELSE 'E' || ((still + CASE strand WHEN '-' THEN -{p} ELSE {p} END) % 3 + 3) % 3 || CASE WHEN im & 1 > 0 THEN '+I0' ELSE '' END || CASE WHEN im & 2 > 0 THEN '+I1' ELSE '' END || CASE WHEN im & 4 > 0 THEN '+I2' ELSE '' END END)"""  # noqa: E731


@query(f"""WITH {_SEGMENTS}, lp AS (SELECT species, chrom, strand, s, e, lag(e) OVER (PARTITION BY species, chrom, strand ORDER BY s) AS pe FROM ru)
       SELECT species, chrom, strand, s, e, {_STATE_AT('s')} AS state FROM ru
       UNION ALL SELECT species, chrom, strand, coalesce(pe, 0) + 1, s - 1, 'IR' FROM lp WHERE s - coalesce(pe, 0) > 1
       UNION ALL SELECT species, chrom, strand, coalesce(m, 0) + 1, length, 'IR' FROM le LEFT JOIN (SELECT species, chrom, strand, max(e) AS m FROM ru GROUP BY ALL) USING (species, chrom, strand) WHERE length > coalesce(m, 0)""")
def label_segments(spark, d):
    """The 15 states of every base of every place, as longest runs; of a coding run the state at its first base."""
    f = materialize(features(spark, d), "features")
    s = sg.state_segments(f, places(spark, d, f))
    return s.select(*lb.PLACE, "s", "e", sg.state_at(F.col("mask"), F.col("s"), F.col("strand")).alias("state"))


_PLACED = """ck AS (SELECT chunk_id, c.species, c.chrom, c."begin", c."end", c.strand AS side, c.seq, CASE WHEN c.strand = 'backward' THEN '-' ELSE '+' END AS strand,
              CASE WHEN c.strand = 'backward' THEN length - c."end" ELSE c."begin" END AS fb, CASE WHEN c.strand = 'backward' THEN length - c."begin" ELSE c."end" END AS fe
              FROM chunks c LEFT JOIN (SELECT species, chrom, max(length) AS length FROM sequences GROUP BY ALL) q ON q.species = c.species AND q.chrom = c.chrom)"""


@query(f"""WITH {_SEGMENTS}, {_PLACED}, jo AS (SELECT chunk_id, ck.strand, fb, fe, greatest(s, fb + 1) AS ps, least(e, fe) AS pe, im, still, edge FROM ck JOIN ru ON ck.species = ru.species AND ck.chrom = ru.chrom AND ck.strand = ru.strand AND s <= fe AND e > fb WHERE fb < fe),
       pc AS (SELECT chunk_id, CASE strand WHEN '-' THEN fe - pe ELSE ps - fb - 1 END AS b, pe - ps + 1 AS w, {_STATE_AT("CASE strand WHEN '-' THEN pe ELSE ps END")} AS state FROM jo),
       ag AS (SELECT chunk_id, string_agg(b || '-' || (b + w) || ':' || state, ',' ORDER BY b) AS labels FROM pc GROUP BY chunk_id)
       SELECT chunk_id, species, chrom, "begin", "end", side AS strand, seq, CASE WHEN species IS NOT NULL AND chrom IS NOT NULL AND fb < fe THEN coalesce(labels, '') END AS labels FROM ck LEFT JOIN ag USING (chunk_id)""")
def chunk_records(spark, d):
    """Each chunk's bases with the states of those very bases (the record that training reads): 'begin-end:state' in the
    chunk's own direction, '' where all is intergenic, null where its place is unknown."""
    f = materialize(features(spark, d), "features")
    c, seq = table(spark, d, "chunks"), table(spark, d, "sequences")
    strand = F.when(F.col("strand") == "backward", "-").otherwise("+")
    placed = materialize(ch.forward_intervals(c, seq).join(c.select("chunk_id", strand.alias("strand")), "chunk_id"), "placed")
    seg = sg.state_segments(f, places(spark, d, f))
    parts = sg.chunk_states(placed, seg).groupBy("chunk_id").agg(F.array_sort(F.collect_list(F.struct("begin", "end", "state"))).alias("ps"))
    label = F.array_join(F.transform("ps", lambda p: F.concat(p["begin"].cast("string"), F.lit("-"), p["end"].cast("string"), F.lit(":"), p["state"])), ",")
    labels = placed.join(parts, "chunk_id", "left").select("chunk_id", F.when(F.col("fb").isNotNull(), F.coalesce(label, F.lit(""))).alias("labels"))
    return c.select("chunk_id", "species", "chrom", "begin", "end", "strand", "seq").join(labels, "chunk_id")


# ---- whole flow: annotation -> longest isoforms -> labels -> chunk classes

_CDS = "cds AS (SELECT * FROM f WHERE feature = 'CDS' AND tx IS NOT NULL)"
#: Coding rows of sound transcripts only: whole codons, at least 90 bases, no stop before the last codon.
_SOUND = f"""ca AS (SELECT * FROM f WHERE feature = 'CDS' AND tx IS NOT NULL), {_SEQ},
       sp AS (SELECT ca.species, tx, chrom, strand, string_agg({_BASES('s', 'e')}, '' ORDER BY s, e, ord) AS x, CAST(sum(e - s + 1) AS BIGINT) AS n FROM ca JOIN sq USING (species, chrom) GROUP BY ca.species, tx, chrom, strand),
       sd0 AS (SELECT species, tx, chrom, strand, n, CASE WHEN strand = '-' THEN translate(reverse(x), '{fs.IUPAC}', '{fs.IUPAC_COMPLEMENT}') ELSE x END AS x FROM sp WHERE n % 3 = 0 AND n >= 90),
       so AS (SELECT species, tx, chrom, strand FROM sd0 WHERE len(list_filter(generate_series(1, length(x) - 5, 3), lambda i: upper(substring(x, i, 3)) IN ('TAA', 'TAG', 'TGA', 'TAR', 'TRA'))) = 0),
       cds AS (SELECT ca.* FROM ca JOIN so ON (ca.species, ca.tx, ca.chrom, ca.strand) = (so.species, so.tx, so.chrom, so.strand))"""
_LONGEST = f"""{_COMPONENTS.replace(_CDS, _SOUND)}, lo AS (SELECT component, arg_max(node, (cds_len, -node)) AS node FROM co JOIN u ON u.ord = co.node GROUP BY component),
       kept AS (SELECT u.species, u.chrom, u.strand, u.tx FROM lo JOIN u ON u.ord = lo.node),
       kc AS (SELECT cds.* FROM cds JOIN kept ON (cds.species, cds.chrom, cds.strand, cds.tx) = (kept.species, kept.chrom, kept.strand, kept.tx))"""


@query(f"WITH {FEATURES_SQL.replace(_CDS, _SOUND)} SELECT species, tx AS tx_id, chrom, strand FROM so")
def sound_transcripts(spark, d):
    f = features(spark, d)
    return tx.sound(spliced(f, spark, d)).select(*tx.TX, "chrom", "strand")


def longest_features(spark, d) -> DataFrame:
    """Coding rows of the longest isoform of each component; transcripts that are not sound never enter the graph."""
    f = materialize(features(spark, d), "features")
    sound = materialize(tx.sound(spliced(f, spark, d)).select(*lb.PLACE, "tx_id"), "sound")
    coding = materialize(f.filter("feature = 'CDS' and tx_id is not null").join(sound, [*lb.PLACE, "tx_id"], "left_semi"), "coding")
    n = materialize(tx.distinct_transcripts(tx.cds_chains(coding)).withColumnRenamed("ord", "node"), "nodes")
    e = _numbered(_edges(coding, n), n)
    best = iso.longest_isoforms(iso.component_of(n.select("node", "cds_len"), e))
    kept = n.join(best.select("node"), "node", "left_semi").select(*lb.PLACE, "tx_id")
    return materialize(coding.join(kept, [*lb.PLACE, "tx_id"], "left_semi"), "isoforms")


@query(f"WITH {_LONGEST} SELECT species, chrom, strand, tx AS tx_id, ord FROM kc")
def longest_coding_rows(spark, d):
    return longest_features(spark, d).select(*lb.PLACE, "tx_id", "ord")


@query(f"""WITH {_LONGEST}, pi AS (SELECT *, lag(e) OVER (PARTITION BY species, tx, chrom, strand ORDER BY s, e, ord) AS pe FROM kc),
       lab AS (SELECT species, chrom, strand, s, e, 4 AS bit FROM kc UNION ALL SELECT species, chrom, strand, pe + 1, s - 1, 2 FROM pi WHERE s - pe >= 3),
       ba AS (SELECT species, chrom, strand, pos, bit_or(bit) AS mask FROM (SELECT DISTINCT species, chrom, strand, bit, unnest(generate_series(s, e)) AS pos FROM lab) GROUP BY ALL),
       gr AS (SELECT species, chrom, strand, (pos - 1) // {SIZE} AS chunk_no, count(*) FILTER (mask & 2 <> 0) AS intron, count(*) FILTER (mask & 4 <> 0) AS coding, count(*) AS genic FROM ba GROUP BY ALL),
       {_RUNS}
       SELECT species, chrom, strand, chunk_no, 1 AS n_chunks, intron, coding, CASE WHEN intron = {SIZE} AND coding = 0 THEN 'intron' WHEN coding >= 100 THEN 'cds' ELSE 'non' END AS label FROM cl
       UNION ALL SELECT species, chrom, strand, chunk_no, n_chunks, 0, 0, 'intergenic' FROM cg""")
def isoform_chunks(spark, d):
    f = longest_features(spark, d)
    i = tx.introns(f).select(*lb.PLACE, F.col("intron_start").alias("start"), F.col("intron_end").alias("end"), F.lit("intron").alias("label"))
    seg = lb.cover_segments(f.select(*lb.PLACE, "start", "end", F.lit("CDS").alias("label")).unionByName(i), lb.PLACE, {"intron": 2, "CDS": 4})
    g = _all_chunks(ch.masked_bases(seg, lb.PLACE, SIZE, {"intron": 2, "coding": 4, "genic": 6}), spark, d, features(spark, d))
    return g.select(*lb.PLACE, "chunk_no", "n_chunks", "intron", "coding", ch.chunk_class(F.col("intron"), F.col("coding"), F.col("genic"), SIZE).alias("label"))


@query(f"""WITH {FEATURES_SQL}, c AS (SELECT species, chrom, CASE feature WHEN 'CDS' THEN 'CDS' WHEN 'exon' THEN 'exon' ELSE 'gene' END AS channel, strand, s, e FROM f WHERE feature IN ('CDS', 'exon', 'gene')),
       b AS (SELECT DISTINCT species, chrom, channel, strand, unnest(generate_series(s, e)) AS pos FROM c)
       SELECT species, chrom, strand, (pos - 1) // 8192 AS chunk_no, count(*) FILTER (channel = 'CDS') AS "CDS", count(*) FILTER (channel = 'exon') AS exon, count(*) FILTER (channel = 'gene') AS gene FROM b GROUP BY ALL""")
def strand_channels(spark, d):
    """Covered bases of each chunk by channel and strand (the channels that only tell covered from not)."""
    bits = {"CDS": 1, "exon": 2, "gene": 4}
    seg = lb.cover_segments(features(spark, d).withColumnRenamed("feature", "label"), lb.PLACE, bits)
    return ch.masked_bases(seg, lb.PLACE, 8192, bits)


@query(f"""WITH {FEATURES_SQL}, {_SEQ}, p AS (SELECT *, lag(e) OVER (PARTITION BY species, tx, chrom, strand ORDER BY s, e, ord) AS pe FROM cds),
       st AS (SELECT DISTINCT species, chrom, strand, pe + 1 AS a, s - 1 AS z FROM p WHERE s - pe >= 5)
       SELECT species, chrom, strand, CASE WHEN strand = '-' THEN z - 1 ELSE a END AS site_start, CASE WHEN strand = '-' THEN z ELSE a + 1 END AS site_end,
              upper(CASE WHEN strand = '-' THEN translate(reverse({_BASES('(z - 1)', 'z')}), 'ACGTacgt', 'TGCAtgca') ELSE {_BASES('a', '(a + 1)')} END) AS site_seq, 'donor' AS kind FROM st JOIN sq USING (species, chrom)
       UNION ALL SELECT species, chrom, strand, CASE WHEN strand = '-' THEN a ELSE z - 1 END, CASE WHEN strand = '-' THEN a + 1 ELSE z END,
              upper(CASE WHEN strand = '-' THEN translate(reverse({_BASES('a', '(a + 1)')}), 'ACGTacgt', 'TGCAtgca') ELSE {_BASES('(z - 1)', 'z')} END), 'acceptor' FROM st JOIN sq USING (species, chrom)""")
def site_rows(spark, d):
    """Donor and acceptor rows with their two bases, read on the strand of the intron."""
    i = tx.introns(features(spark, d), min_gap=5).select(*lb.PLACE, "intron_start", "intron_end").distinct()
    left = (F.col("intron_start"), F.col("intron_start") + 1)
    right = (F.col("intron_end") - 1, F.col("intron_end"))
    minus = F.col("strand") == "-"
    both = F.explode(F.array(*[F.struct(F.when(minus, a[0]).otherwise(b[0]).alias("s"), F.when(minus, a[1]).otherwise(b[1]).alias("e"), F.lit(k).alias("kind")) for k, a, b in (("donor", right, left), ("acceptor", left, right))]))
    x = _pieces(i.withColumn("x", both).select(*lb.PLACE, "intron_start", "intron_end", "x.s", "x.e", "x.kind"), spark, d, "s", "e")
    two = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("piece", "bases"))), lambda p: p["bases"]), "").alias("two")
    x = x.groupBy(*lb.PLACE, "intron_start", "intron_end", "s", "e", "kind").agg(two)
    return x.select(*lb.PLACE, F.col("s").alias("site_start"), F.col("e").alias("site_end"), F.upper(F.when(minus, fs.reverse_complement(F.col("two"))).otherwise(F.col("two"))).alias("site_seq"), "kind")
