"""Annotation operators on hand-worked fixtures."""

from __future__ import annotations

import gzip

from pyspark.sql import functions as F

from strandloom.functions import sequence as fs
from strandloom.operators import chunks as ch
from strandloom.operators import isoforms as iso
from strandloom.operators import labels as lb
from strandloom.operators import transcripts as tx
from strandloom.sources import annotation as an
from strandloom.streaming.chunk_stream import SEQUENCES, start_chunks, stream_chunks, stream_sequences


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


FEATURES = "species string, chrom string, source string, feature string, start bigint, end bigint, strand string, phase string, tx_id string, gene_id string, ord bigint"


def feats(spark, *parts, strand="+", feature="CDS", t="t", phase="0"):
    return spark.createDataFrame([("s", "c", "x", feature, a, b, strand, phase, t, None, i) for i, (a, b) in enumerate(parts)], FEATURES)


def one(spark, **cols):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in cols.items()])


def seqs(spark, *s):
    return spark.createDataFrame([("s", f"c{i}", "", x, len(x) if x is not None else None) for i, x in enumerate(s)], SEQUENCES)


def test_sequence_functions(spark):
    df = one(spark, s="ACGTNacgt")
    got = df.select(fs.reverse_complement(F.col("s")), fs.complement(F.col("s")), fs.count_char(F.col("s"), "a"), fs.interval_bases(F.col("s"), F.lit(-1), F.lit(3)), fs.periodic_bases(F.col("s"), F.lit(8), F.lit(12))).first()
    assert tuple(got) == ("acgtNACGT", "TGCANtgca", 1, "ACG", "gtACG")
    stops = spark.createDataFrame([("ATGTAAGCC",), ("ATGGCCTAA",), ("TAG",), ("",), (None,), ("AtgaTAA",)], "s string")
    assert [r[0] for r in stops.select(fs.inner_stop(F.col("s"))).collect()] == [True, False, False, False, None, False]
    r = spark.createDataFrame([(768, 6144), (1, 8), (3, 8), (295, 1000)], "a bigint, b bigint")
    assert [x[0] for x in r.select(fs.round_half_even(F.col("a"), F.col("b"))).collect()] == [0.12, 0.12, 0.38, 0.3]
    assert [x[0] for x in spark.createDataFrame([(0,), (1,), (12,)], "m int").select(fs.lowest_bit(F.col("m"))).collect()] == [0, 0, 2]
    a = one(spark, f='ID = "x;y"; Parent=transcript:T1;k=1;k=2')
    got = a.select(fs.attribute(F.col("f"), "Parent"), fs.attribute(F.col("f"), "Alias"), fs.attribute_at(F.col("f"), -1), fs.attribute_map(F.col("f"))["k"]).first()
    assert tuple(got) == ("transcript:T1", None, "k=2", "2")


def test_chunks(spark):
    s = seqs(spark, "ABCDEFGHIJ", "ABC", None, "")
    got = [(r.begin, r.end, r.seq) for r in ch.fixed_chunks(s, 4, 1).collect()]
    assert got == [(0, 4, "ABCD"), (3, 7, "DEFG"), (6, 10, "GHIJ")]
    assert ch.fixed_chunks(seqs(spark, "ABC"), 4).collect() == []
    tail = [(r.chrom, r.start, r.end, r.seq) for r in ch.tail_chunks(s, 4, 1).collect()]
    assert tail == [("c0", 1, 4, "ABCD"), ("c0", 4, 7, "DEFG"), ("c0", 7, 10, "GHIJ"), ("c0", 10, 10, "J"), ("c1", 0, 2, "ABC")]
    both = {(r.strand, r.no): (r.start, r.seq) for r in ch.stranded_chunks(seqs(spark, "AACCGG"), 2).collect()}
    assert both["+", 0] == (1, "AA") and both["-", 0] == (5, "CC") and both["-", 2] == (1, "TT")
    w = [r.start for r in ch.sampled_starts(spark.createDataFrame([("s", "c", 20000), ("s", "d", 100)], "species string, chrom string, length bigint"), 2000).collect()]
    assert w == [3000 + 1666 * k for k in range(11)]
    assert [len(r.bases) for r in ch.blocks(seqs(spark, "A" * 25), 10).orderBy("block_no").collect()] == [10, 10, 5]
    assert sorted(r.window_start for r in ch.exon_windows(feats(spark, (1, 4000), feature="exon"), 2000).collect()) == [0, 500, 1500, 2500]


def test_introns_and_junctions(spark):
    f = feats(spark, (1, 10), (13, 20), feature="exon")
    assert tx.introns(f, "exon", 0, 4).collect() == []
    assert rows(tx.introns(feats(spark, (1, 10), (14, 20), feature="exon"), "exon", 0, 4).select("intron_start", "intron_end")) == [(10, 14)]
    assert tx.introns(feats(spark, (1, 10), (12, 20))).collect() == []
    assert rows(tx.introns(feats(spark, (1, 10), (13, 20))).select("intron_start", "intron_end")) == [(11, 12)]
    close = feats(spark, (1, 10), (15, 20), feature="exon")
    assert rows(tx.merged_exons(close).select("start", "end")) == [(1, 20)] and tx.junctions(close).collect() == []
    assert rows(tx.junctions(feats(spark, (1, 10), (16, 20), feature="exon")).select("left", "right")) == [(11, 15)]


def test_position_class_and_stops(spark):
    got = [r.position_class for r in tx.position_classes(feats(spark, (1, 9), (20, 29), (40, 49), strand="-")).orderBy("no").collect()]
    assert got == ["terminal", "internal", "initial"]
    f = feats(spark, (50, 70), (90, 100)).unionByName(feats(spark, (101, 103), feature="stop_codon"))
    assert rows(tx.merge_stops(f).select("start", "end")) == [(50, 70), (90, 103)]
    far = feats(spark, (90, 100)).unionByName(feats(spark, (110, 112), feature="stop_codon"))
    assert rows(tx.merge_stops(far).select("start", "end")) == [(90, 100)]


def test_frame_edges(spark):
    def edge(a, b):
        f = feats(spark, a, t="a").unionByName(feats(spark, b, t="b"))
        n = tx.distinct_transcripts(tx.cds_chains(f))
        return iso.frame_edges(iso.overlap_pairs(n, "tx_start", "tx_end", "tx_id"), f).count()

    assert edge((100, 199), (101, 190)) == 1  # ends differ by 9
    assert edge((100, 199), (101, 191)) == 0
    assert edge((100, 110), (110, 120)) == 0


def test_labels(spark):
    f = feats(spark, (11, 16), (21, 26))
    seg = lb.coding_segments(f, lb.PLACE)
    frames = seg.withColumn("p", F.explode(F.sequence("s", "e"))).select("p", lb.frame_at(F.col("p"), F.col("cs"), F.col("ce"), F.col("phase"), F.col("strand")).alias("f"))
    assert [r.f for r in frames.orderBy("p").collect()] == [0, 1, 2] * 4
    minus = lb.coding_segments(feats(spark, (11, 16), strand="-"), lb.PLACE)
    got = minus.withColumn("p", F.explode(F.sequence("s", "e"))).select("p", lb.frame_at(F.col("p"), F.col("cs"), F.col("ce"), F.col("phase"), F.col("strand")).alias("f"))
    assert [r.f for r in got.orderBy("p").collect()] == [2, 1, 0, 2, 1, 0]
    assert {r.state: r.n for r in lb.state_counts(seg, lb.PLACE).collect()} == {"E0": 4, "E1": 4, "E2": 4}
    states = lb.intron_states(tx.introns(f), lb.coding_segments(f, lb.PLACE))
    assert rows(states.select("intron_start", "intron_end", "state")) == [(17, 20, "I2")]
    assert rows(lb.edge_states(f, states).select("position", "state")) == [(11, "START"), (16, "EI2"), (21, "IE2"), (26, "STOP")]
    assert lb.cover_segments(feats(spark, (1, 2)).withColumn("label", F.lit("CDS")).limit(0), lb.PLACE, {"CDS": 4}).collect() == []


def test_chunk_class_and_cover(spark):
    df = spark.createDataFrame([(0, 0, 0), (10, 0, 10), (0, 100, 100), (0, 99, 99)], "i int, c int, g int")
    assert [r[0] for r in df.select(ch.chunk_class(F.col("i"), F.col("c"), F.col("g"), 10)).collect()] == ["intergenic", "intron", "cds", "non"]
    w = spark.createDataFrame([("s", "c", 9, 14)], "species string, chrom string, start bigint, end bigint")
    assert rows(ch.covered_offsets(w, feats(spark, (10, 12))).select("n_covered")) == [(2,)]


def test_decisions(spark):
    n = spark.createDataFrame([(1, 1.0, 5.0), (2, 0.0, 90.0), (3, 1.0, 50.0), (4, None, 1.0)], "node bigint, r double, l double")
    e = spark.createDataFrame([(1, 2), (1, 3), (3, 4)], "a bigint, b bigint")
    assert [r.node for r in iso.decided(n, e, ["r", "l"], (0.0, 10.0)).orderBy("node").collect()] == [3]


def test_support_and_evidence(spark):
    n = spark.createDataFrame([(1, 0.5, 0.0, False), (2, 0.1, 0.0, False), (3, None, None, True), (4, 0.9, 0.0, True)], "node bigint, i double, o double, single boolean")
    assert [r.node for r in iso.supported(n, "i", "o", 0.4, 0.2).orderBy("node").collect()] == [1, 4]
    assert [r.node for r in iso.supported(n, "i", "o", 0.4, 0.2, "single").collect()] == [1]
    parts = spark.createDataFrame([("s", "c", "+", "t", "intron", 1, 5), ("s", "c", "+", "t", "intron", 8, 9)], "species string, chrom string, strand string, tx_id string, kind string, start bigint, end bigint")
    hints = spark.createDataFrame([("s", "c", "+", "intron", 1, 5, "E", 3), ("s", "c", "+", "intron", 1, 5, "P", 1)], "species string, chrom string, strand string, kind string, start bigint, end bigint, src string, mult int")
    got = iso.evidence_features(parts, hints).first()
    assert got.relative == 0.5 and abs(got.absolute - 4.110874) < 1e-5 and abs(got["mean"] - 3.417727) < 1e-5


def test_sources_and_sinks(spark, tmp_path):
    plain, packed = tmp_path / "a.fa", tmp_path / "b.fa.gz"
    plain.write_text(">NC_1 Homo x chromosome 1, p\nACGT\nAC\n>NT_1 y\nGG\n>X z\n\n")
    packed.write_bytes(gzip.compress(b">7 dna:chromosome chromosome:G:7:1:248:1 REF\nTT\r\nTT\n"))
    got = an.read_fasta(spark, str(tmp_path / "*.fa*"))
    assert {r.chrom: r.seq for r in got.collect()} == {"NC_1": "ACGTAC", "NT_1": "GG", "X": "", "7": "TTTT"}
    assert {r.chrom for r in an.read_fasta(spark, str(plain), "refseq").collect()} == {"NC_1", "X"}
    assert [r[0] for r in got.filter("chrom = '7'").select(an.ensembl_length(F.col("description"))).collect()] == [248]
    gtf = tmp_path / "x.gtf"
    gtf.write_text('#c\ntrack t\n1\te\ttranscript\t5\t9\t.\t+\t.\tgene_id "g"; transcript_id "t"\n1\te\tCDS\t5\t8\t.\t+\t0\ttranscript_id "t"; gene_id "g";\n1\te\tCDS\tx\t8\t.\t+\t0\tno\n')
    a = an.read_annotation(spark, str(gtf))
    assert a.count() == 3 and an.transcript_rows(a).select("tx_id", "gene_id").distinct().collect() == [("t", "g")]
    out = an.transcript_rows(a)
    an.write_gtf(out, str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out")).count() == 2
    s = seqs(spark, "ACC")
    an.write_chromosomes(s, str(tmp_path / "chrom"))
    assert {(r.strand, r.value) for r in spark.read.text(str(tmp_path / "chrom")).collect()} == {("forward", "ACC"), ("backward", "GGT")}
    an.write_table(s, str(tmp_path / "t"), ("species",))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1


def test_stream_equals_batch(spark, tmp_path):
    s = seqs(spark, "ACGTACGT", "AAA")
    s.write.parquet(str(tmp_path / "in"))
    q = start_chunks(stream_chunks(stream_sequences(spark, str(tmp_path / "in")), 3), str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination(120)
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == rows(ch.fixed_chunks(s, 3))


def test_canonical_features_of_dirty_rows(spark):
    g = spark.createDataFrame(
        [(5, "s", "1", "e", "CDS", 1, 9, "+", "0", 'gene_id "g"; transcript_id "t"'), (3, "s", "1", "e", "CDS", 1, 9, "+", "0", 'gene_id "g"; transcript_id "t"'), (6, "s", None, "e", "CDS", 1, 9, "+", "0", None), (7, "s", "1", "e", "CDS", 9, 1, "+", "0", None), (8, "s", "1", None, "gene", 1, 9, "?", None, ""), (9, "s", "1", None, "exon", 2, 4, "-", None, None)],
        "feat_id bigint, species string, chr string, source string, type string, start bigint, end bigint, strand string, phase string, attributes string",
    )
    assert rows(tx.features_of(g).select("ord", "feature", "tx_id")) == [(3, "CDS", "t"), (9, "exon", None)]
    assert tx.features_of(g.limit(0)).collect() == []


def test_annotated_windows(spark):
    w = spark.createDataFrame([("s", "c", 0, 10), ("s", "c", 10, 20), ("s", "d", 0, 5)], "species string, chrom string, start bigint, end bigint")
    c = spark.createDataFrame([("s", "c", 1, 4, "initial"), ("s", "c", 1, 4, "initial"), ("s", "c", 3, 12, "terminal"), (None, "c", 1, 9, "initial")], "species string, chrom string, start bigint, end bigint, label string")
    got = rows(ch.annotated_windows(w, c, ["initial", "terminal"]))
    assert got == [("s", "c", 0, 10, 8, 3, 6, "2-9"), ("s", "c", 10, 20, 3, 0, 3, "0-2"), ("s", "d", 0, 5, 0, 0, 0, "")]
    assert rows(ch.annotated_windows(w.limit(0), c, ["initial"])) == []


def test_names_and_records(spark, tmp_path):
    got = one(spark, a="gene:g1:x", b="g2", c=None).select(fs.without_type(F.col("a")), fs.without_type(F.col("b")), fs.without_type(F.col("c").cast("string"))).first()
    assert tuple(got) == ("g1", "g2", None)
    got = one(spark, a="X chromosome 12, whole", b="X chromosome ZW", c="X chromosome 1A").select(*[an.is_numbered(F.col(x)) for x in "abc"]).first()
    assert tuple(got) == (True, True, False)
    c = feats(spark, (5, 9), (20, 30)).withColumns({"gene_id": F.lit("g"), "cds_type": F.lit("initial"), "count": F.col("ord") + 1})
    lines = [r.line.split("\t") for r in an.gtf_records(c).orderBy("line").collect()]
    assert [(x[2], x[3], x[4]) for x in lines] == [("CDS", "20", "30"), ("CDS", "5", "9"), ("gene", "5", "30"), ("transcript", "5", "30")]
    assert lines[1][8] == 'transcript_id "t"; gene_id "g"; cds_type "initial"; count "1";'
    an.write_chromosomes(seqs(spark, "ACGT"), str(tmp_path / "chr"))
    assert rows(an.read_chromosomes(spark, str(tmp_path / "chr"))) == [("s", "c0", "backward", "ACGT"), ("s", "c0", "forward", "ACGT")]
    an.write_fasta_info(seqs(spark, "A"), str(tmp_path / "info"))
    assert rows(spark.read.text(str(tmp_path / "info"))) == [("c0: ",)]
