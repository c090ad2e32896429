"""Fixed-length chunks and windows over sequences and coordinate axes, and their annotation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandloom.functions.sequence import reverse_complement, round_half_even
from strandloom.operators.skew import skew_join
from strandloom.operators.sweep import with_previous


def slices(seq: Column, starts: Column, width) -> Column:
    """Array of (begin, bases) for an array of 0-based begins: slices of single-byte letters by byte position, in one pass
    over the sequence (by characters each slice would count from its start)."""
    raw = seq.cast("binary")
    return F.transform(starts, lambda b: F.struct(b.alias("begin"), F.substring(raw, (b + 1).cast("int"), F.lit(width)).cast("string").alias("bases")))


def _starts(n: Column, step: int) -> Column:
    """0, step, ... (n of them); none for n < 1."""
    return F.when(n >= 1, F.transform(F.sequence(F.lit(0).cast("bigint"), F.greatest(n, F.lit(1).cast("bigint")) - 1), lambda i: i * step)).otherwise(F.array().cast("array<bigint>"))


def fixed_chunks(sequences: DataFrame, size: int, overlap: int = 0, strand: str = "forward") -> DataFrame:
    """(species, chrom, seq, begin, end, strand): chunks of exactly size bases, 0-based half-open, the tail dropped.

    (L - overlap) // (size - overlap) chunks; none if the sequence is shorter than size. On 'backward' begin and end
    count on the reverse-complemented sequence. Null sequences give no chunks.
    """
    length = F.length("seq").cast("bigint")
    starts = _starts(F.floor((length - overlap) / (size - overlap)), size - overlap)
    if strand == "forward":
        begin, bases = F.col("x.begin"), F.col("x.bases")
    else:  # the same chunks from the other end
        starts = F.transform(starts, lambda b: length - b - size)
        begin, bases = F.col("__len") - F.col("x.begin") - size, reverse_complement(F.col("x.bases"))
    rows = sequences.select("species", "chrom", length.alias("__len"), F.explode(slices(F.col("seq"), starts, size)).alias("x"))
    return rows.select("species", "chrom", bases.alias("seq"), begin.alias("begin"), (begin + size).alias("end"), F.lit(strand).alias("strand"))


def tail_chunks(sequences: DataFrame, size: int, overlap: int) -> DataFrame:
    """(species, chrom, no, start, end, seq): starts every size - overlap bases, 1-based closed, the tail kept; a
    sequence shorter than size is one chunk from 0 to length - 1 (its old convention)."""
    step, length = size - overlap, F.length("seq").cast("bigint")
    starts = _starts(F.when(length < size, F.least(length, F.lit(1))).otherwise(F.ceil(length / step)), step)
    rows = sequences.select("species", "chrom", length.alias("__len"), F.explode(slices(F.col("seq"), starts, size)).alias("x"))
    short, begin = F.col("__len") < size, F.col("x.begin")
    return rows.select(
        "species", "chrom", F.when(short, 0).otherwise((begin / step).cast("int")).alias("no"),
        F.when(short, 0).otherwise(begin + 1).alias("start"), F.when(short, F.col("__len") - 1).otherwise(F.least(begin + size, F.col("__len"))).alias("end"), F.col("x.bases").alias("seq"),
    )


def reverse_tail_chunks(sequences: DataFrame, size: int, overlap: int) -> DataFrame:
    """tail_chunks of the upper-case reverse complement of each sequence."""
    return tail_chunks(sequences.select("species", "chrom", reverse_complement(F.upper("seq")).alias("seq")), size, overlap)


def stranded_chunks(sequences: DataFrame, size: int, overlap: int = 0) -> DataFrame:
    """(species, chrom, strand, no, start, end, seq): fixed chunks of both strands with forward 1-based coordinates;
    backward chunks are numbered from the sequence's end, and each has the reverse complement of its own coordinates."""
    step, length = size - overlap, F.length("seq").cast("bigint")
    n = F.floor((length - overlap) / step)
    rows = sequences.select("species", "chrom", n.alias("__n"), F.explode(slices(F.col("seq"), _starts(n, step), size)).alias("x"))
    no, bases = (F.col("x.begin") / step).cast("int"), F.col("x.bases")
    sides = F.explode(F.array(
        F.struct(F.lit("+").alias("strand"), no.alias("no"), bases.alias("seq")), F.struct(F.lit("-").alias("strand"), (F.col("__n").cast("int") - 1 - no).alias("no"), reverse_complement(bases).alias("seq")),
    ))
    return rows.select("species", "chrom", F.col("x.begin").alias("b"), sides.alias("y")).select(
        "species", "chrom", "y.strand", "y.no", (F.col("b") + 1).alias("start"), (F.col("b") + size).alias("end"), "y.seq"
    )


#: Bases of a sequence block.
BLOCK = 1 << 16


def blocks(sequences: DataFrame, block: int = BLOCK) -> DataFrame:
    """(species, chrom, block_no, bases): sequences cut into blocks, so that bases are joined without their chromosome."""
    starts = _starts(F.ceil(F.length("seq").cast("bigint") / block), block)
    rows = sequences.select("species", "chrom", F.explode(slices(F.col("seq"), starts, block)).alias("x"))
    return rows.select("species", "chrom", F.expr(f"x.begin div {block}").alias("block_no"), F.col("x.bases").alias("bases"))


def base_pieces(df: DataFrame, sequences: DataFrame, start: str, end: str, block: int = BLOCK) -> DataFrame:
    """df with piece and bases: the bases of each row's 1-based closed interval, one row per sequence block it touches, in
    order of piece. Only blocks are joined, hot ones salted. A sequence of at most one block stands for its endless
    repetition; beyond the end of a longer one there are no bases. Rows without a sequence are left out."""
    seq = sequences.filter(F.length("seq") > 0)
    known = seq.select("species", "chrom", F.length("seq").cast("bigint").alias("__len"))
    rows = skew_join(df, known, ["species", "chrom"], "inner").withColumn("__width", F.least("__len", F.lit(block)))
    no = F.explode(F.sequence(F.floor((F.col(start) - 1) / F.col("__width")), F.floor((F.col(end) - 1) / F.col("__width"))))
    rows = rows.filter(F.col(start) <= F.col(end)).withColumn("piece", no).withColumn("block_no", F.when(F.col("__len") <= block, F.lit(0).cast("bigint")).otherwise(F.col("piece")))
    rows = skew_join(rows, blocks(seq, block), ["species", "chrom", "block_no"], "inner")
    first = F.greatest(F.col(start) - 1 - F.col("piece") * F.col("__width"), F.lit(0))
    last = F.least(F.col(end) - F.col("piece") * F.col("__width"), F.col("__width"))
    return rows.withColumn("bases", F.substring("bases", (first + 1).cast("int"), (last - first).cast("int"))).drop("__len", "__width", "block_no")


def forward_intervals(chunks: DataFrame, sequences: DataFrame) -> DataFrame:
    """(chunk_id, species, chrom, fb, fe): forward half-open bases of each chunk; fb is null where they are unknown.

    Backward chunks count on the reverse-complemented chromosome, whose length comes from sequences. Unknown: a null
    species, chrom, begin or end, an empty interval, or a backward chunk whose chromosome has no length.
    """
    lengths = sequences.groupBy("species", "chrom").agg(F.max("length").alias("__len"))
    c = chunks.select("chunk_id", "species", "chrom", F.col("begin").alias("b"), F.col("end").alias("e"), "strand")
    c = skew_join(c, lengths, ["species", "chrom"], "left")
    back = F.coalesce(F.col("strand") == "backward", F.lit(False))
    fb, fe = F.when(back, F.col("__len") - F.col("e")).otherwise(F.col("b")), F.when(back, F.col("__len") - F.col("b")).otherwise(F.col("e"))
    known = F.col("species").isNotNull() & F.col("chrom").isNotNull() & (fb < fe)
    return c.select("chunk_id", "species", "chrom", F.when(known, fb).alias("fb"), F.when(known, fe).alias("fe"))


def sampled_starts(lengths: DataFrame, size: int, first: int = 3000) -> DataFrame:
    """(species, chrom, length, start, end): evenly spaced 0-based windows: n = int(length // size * 1.2) starts from
    first in steps of length // n; windows at the end may be short. Sequences shorter than size give none."""
    n = F.floor(F.floor(F.col("length") / size) * 1.2)
    rows = lengths.select("species", "chrom", "length", n.alias("__n")).filter(f"__n >= 1 and length > {first}")
    step = F.floor(F.col("length") / F.col("__n"))
    rows = rows.withColumn("start", F.explode(F.slice(F.sequence(F.lit(first).cast("bigint"), F.col("length") - 1, step), 1, F.col("__n").cast("int"))))
    return rows.select("species", "chrom", "length", "start", F.least(F.col("start") + size, F.col("length")).alias("end"))


def on_grid(segments: DataFrame, size: int, start: str = "start", end: str = "end") -> DataFrame:
    """segments (1-based closed) cut at the borders of consecutive chunks of size bases: chunk_no, part_start, part_end
    are added. An equi-join key by arithmetic in place of a range join."""
    no = F.explode(F.sequence(F.floor((F.col(start) - 1) / size), F.floor((F.col(end) - 1) / size)))
    rows = segments.filter(F.col(start) <= F.col(end)).withColumn("chunk_no", no)
    return rows.withColumn("part_start", F.greatest(F.col(start), F.col("chunk_no") * size + 1)).withColumn("part_end", F.least(F.col(end), (F.col("chunk_no") + 1) * size))


def chunk_features(features: DataFrame, size: int) -> DataFrame:
    """(species, chrom, chunk_no, feature, n): features of each type that touch each chunk of the grid."""
    return on_grid(features, size).groupBy("species", "chrom", "chunk_no", "feature").agg(F.count("*").alias("n"))


def masked_bases(segments: DataFrame, keys: list[str], size: int, classes: dict[str, int]) -> DataFrame:
    """(keys, chunk_no, <class>...): bases of each chunk whose mask has a bit of the class; chunks without a segment
    are not listed. segments: keys, s, e, mask, not overlapping."""
    width = F.col("part_end") - F.col("part_start") + 1
    sums = [F.sum(F.when(F.col("mask").bitwiseAND(F.lit(bits)) != 0, width).otherwise(0)).alias(name) for name, bits in classes.items()]
    return on_grid(segments, size, "s", "e").groupBy(*keys, "chunk_no").agg(*sums)


def complete_chunks(listed: DataFrame, places: DataFrame, keys: list[str], bin_bits: int = 10) -> DataFrame:
    """listed (keys, chunk_no, values) with n_chunks = 1, and a row for each run of chunks that are not listed: its first
    chunk_no, how many they are as n_chunks, and null values. places: keys and n, the number of whole chunks there; listed
    chunks beyond them are left out, places without any listed chunk are one run."""
    inner = listed.join(places.select(*keys, "n"), keys, "left").filter("n is null or chunk_no < n").drop("n")
    ends = places.select(*keys, F.explode(F.array(F.lit(-1).cast("bigint"), F.col("n"))).alias("chunk_no"))
    at = with_previous(inner.select(*keys, "chunk_no").unionByName(ends), keys, "chunk_no", "chunk_no", "__was", bin_bits)
    gaps = at.filter("chunk_no - __was > 1").select(*keys, (F.col("__was") + 1).alias("chunk_no"), (F.col("chunk_no") - F.col("__was") - 1).alias("n_chunks"))
    return inner.withColumn("n_chunks", F.lit(1).cast("bigint")).unionByName(gaps, allowMissingColumns=True)


def chunk_class(intron: Column, coding: Column, genic: Column, size: int, least: int = 100) -> Column:
    """intergenic if no base is genic, intron if every base is, cds with at least ``least`` coding bases, else non."""
    return F.when(genic == 0, "intergenic").when((intron == size) & (coding == 0), "intron").when(coding >= least, "cds").otherwise("non")


def genic_fraction(genic: Column, size: int) -> Column:
    """Share of genic bases, rounded half to even on the exact fraction."""
    return round_half_even(genic.cast("bigint"), F.lit(size).cast("bigint"))


def channel_values(features: DataFrame, size: int, channels: list[str]) -> DataFrame:
    """(species, chrom, chunk_no, channel, v1, v2, v3): bases of each chunk and channel whose last written value is 1 (+),
    2 (-) or 3 (other strand). The feature with the largest ord wins where features of one channel overlap.

    features: species, chrom, feature, start, end, strand, ord.
    """
    code = F.when(F.col("strand") == "+", 1).when(F.col("strand") == "-", 2).otherwise(3)
    keys = ["species", "chrom", "chunk_no", "channel"]
    f = on_grid(features.filter(F.col("feature").isin(channels)), size).select("species", "chrom", "chunk_no", F.col("feature").alias("channel"), F.col("part_start").alias("s"), F.col("part_end").alias("e"), F.struct("ord", code.alias("v")).alias("w"))
    f = f.groupBy(*keys, "s", "e").agg(F.max("w").alias("w"))
    from pyspark.sql import Window as W

    cut = f.select(*keys, F.explode(F.array("s", F.col("e") + 1)).alias("s")).distinct()
    runs = cut.withColumn("e", F.lead("s").over(W.partitionBy(*keys).orderBy("s")) - 1).filter("e is not null")
    won = runs.join(f.select(*keys, F.col("s").alias("fs"), F.col("e").alias("fe"), "w"), keys).filter("fs <= s and e <= fe").groupBy(*keys, "s", "e").agg(F.max("w").alias("w"))
    width = F.col("e") - F.col("s") + 1
    return won.groupBy(*keys).agg(*[F.sum(F.when(F.col("w.v") == k, width).otherwise(0)).alias(f"v{k}") for k in (1, 2, 3)])


def exon_windows(exons: DataFrame, length: int) -> DataFrame:
    """(species, chrom, strand, window_start): 0-based starts of windows of fixed length centred on exons.

    An exon of length bases or more is halved (the first half is the longer one) until its pieces fit; a window's spare
    bases lie evenly around its piece. exons: species, chrom, strand, start, end, 1-based closed. Starts left of the
    sequence are clamped to 0; equal windows come once.
    """
    # pieces are 0-based closed from here on
    pieces = exons.filter("start <= end").select("species", "chrom", "strand", (F.col("start") - 1).alias("s"), (F.col("end") - 1).alias("e")).distinct()
    done, fits = None, F.col("e") - F.col("s") <= length - 2
    while True:  # at most log2(longest exon / length) rounds
        ready = pieces.filter(fits)
        done = ready if done is None else done.unionByName(ready)
        rest = pieces.filter(~fits)
        if rest.isEmpty():
            break
        middle = F.col("s") + F.expr("(e - s) div 2")
        halves = F.explode(F.array(F.struct(F.col("s").alias("a"), middle.alias("z")), F.struct((middle + 1).alias("a"), F.col("e").alias("z"))))
        pieces = rest.withColumn("x", halves).select("species", "chrom", "strand", F.col("x.a").alias("s"), F.col("x.z").alias("e"))
    spare = F.expr(f"({length} - (e - s + 1)) div 2")
    return done.select("species", "chrom", "strand", F.greatest(F.col("s") - spare, F.lit(0).cast("bigint")).alias("window_start")).distinct()


def covered_offsets(windows: DataFrame, cds: DataFrame, bin_bits: int = 13) -> DataFrame:
    """(species, chrom, start, end, n_covered, n_parts): bases of 0-based windows that lie in (cds start, cds end].

    Coverage counts every base once; n_parts is the number of CDS rows that touch the window.
    """
    from strandloom.operators.sweep import coverage_segments

    # start < base <= end on 0-based bases is the closed interval start + 1 .. end
    runs = coverage_segments(cds.select("species", "chrom", (F.col("start") + 1).alias("s"), F.col("end").alias("e")), ["species", "chrom"], "s", "e", 0).filter("kind = 'period'")
    spread = lambda df, s, e: df.withColumn("bin", F.explode(F.sequence(F.shiftright(s, bin_bits), F.shiftright(e, bin_bits))))
    w = spread(windows.select("species", "chrom", "start", "end").filter("start < end").withColumn("last", F.col("end") - 1), "start", "last")
    r = spread(runs.select("species", "chrom", "seg_start", "seg_end"), "seg_start", "seg_end")
    both = w.join(r, ["species", "chrom", "bin"]).filter("seg_start <= last and start <= seg_end").filter(F.shiftright(F.greatest("start", "seg_start"), bin_bits) == F.col("bin"))
    n = both.groupBy("species", "chrom", "start", "end").agg(F.sum(F.least("last", "seg_end") - F.greatest("start", "seg_start") + 1).alias("n_covered"), F.count("*").alias("n_runs"))
    return windows.select("species", "chrom", "start", "end").join(n, ["species", "chrom", "start", "end"], "left").na.fill(0, ["n_covered", "n_runs"])


def annotated_windows(windows: DataFrame, cds: DataFrame, classes: list[str], bin_bits: int = 13) -> DataFrame:
    """(species, chrom, start, end, n_covered, n_<class>..., offsets): bases of 0-based windows that lie in (cds start,
    cds end] of any row and of those of each label; offsets lists the covered runs in the window as first-last, ''
    where there are none.

    Coverage counts every base once per label and once over all; windows of no bases are not covered. cds: species,
    chrom, start, end, label.
    """
    from strandloom.operators.sweep import coverage_segments

    place = ["species", "chrom", "start", "end"]
    closed = cds.select("species", "chrom", F.explode(F.array(F.col("label"), F.lit(""))).alias("label"), (F.col("start") + 1).alias("s"), F.col("end").alias("e"))
    runs = coverage_segments(closed, ["species", "chrom", "label"], "s", "e", 0).filter("kind = 'period'")
    spread = lambda df, s, e: df.withColumn("bin", F.explode(F.sequence(F.shiftright(s, bin_bits), F.shiftright(e, bin_bits))))
    w = spread(windows.select(*place).filter("start < end").withColumn("last", F.col("end") - 1), "start", "last")
    r = spread(runs.select("species", "chrom", "label", "seg_start", "seg_end"), "seg_start", "seg_end")
    both = w.join(r, ["species", "chrom", "bin"]).filter("seg_start <= last and start <= seg_end").filter(F.shiftright(F.greatest("start", "seg_start"), bin_bits) == F.col("bin"))
    a, b = F.greatest("start", "seg_start") - F.col("start"), F.least("last", "seg_end") - F.col("start")
    both = both.select(*place, "label", a.alias("a"), b.alias("b"))
    bases = lambda label: F.sum(F.when(F.col("label") == label, F.col("b") - F.col("a") + 1).otherwise(0))
    parts = F.array_sort(F.collect_list(F.when(F.col("label") == "", F.struct("a", "b"))))
    offsets = F.array_join(F.transform(parts, lambda x: F.concat_ws("-", x["a"].cast("string"), x["b"].cast("string"))), ",")
    names = {"n_covered": "", **{f"n_{c}": c for c in classes}}
    n = both.groupBy(*place).agg(*[bases(label).alias(c) for c, label in names.items()], offsets.alias("offsets"))
    return windows.select(*place).join(n, place, "left").na.fill(0, list(names)).na.fill("", ["offsets"])


def merged_strands(forward: DataFrame, backward: DataFrame, keys: list[str], indexes: str) -> DataFrame:
    """(keys, indexes): union of the index arrays of both strands, sorted; a missing side counts as empty."""
    b = backward.select(*keys, F.col(indexes).alias("__b"))
    none = F.array().cast("array<bigint>")
    return forward.select(*keys, F.col(indexes).alias("__f")).join(b, keys, "full_outer").select(*keys, F.array_sort(F.array_union(F.coalesce("__f", none), F.coalesce("__b", none))).alias(indexes))


def sampled_windows(runs: DataFrame, size: int, per_group: int, group: list[str], seed: int = 42) -> DataFrame:
    """(group, start, end): up to per_group windows of size bases at the begin of the runs (s, e) that hold one, drawn by a
    seeded hash, so equal inputs give equal windows. Each of many parts of a group is drawn from first."""
    from pyspark.sql import Window as W

    ok = runs.filter(F.col("e") - F.col("s") + 1 >= size).withColumn("__h", F.md5(F.concat_ws("|", *group, "s", F.lit(seed))))
    ok = ok.withColumn("__part", F.substring("__h", 31, 2))
    for keys in ([*group, "__part"], group):
        ok = ok.withColumn("__r", F.row_number().over(W.partitionBy(*keys).orderBy("__h", "s"))).filter(f"__r <= {per_group}")
    return ok.select(*group, F.col("s").alias("start"), (F.col("s") + size - 1).alias("end"))


def composition(seq: Column, alphabet: str = "ACGTNacgt") -> list[Column]:
    from strandloom.functions.sequence import count_char

    return [count_char(seq, ch).alias(f"n_{'upper' if ch.isupper() else 'lower'}_{ch.lower()}") for ch in alphabet]
