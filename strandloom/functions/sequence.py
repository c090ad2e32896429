"""Scalar functions over base sequences: Column in, Column out, all JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: IUPAC codes and their complements, and the codons that end a reading frame.
IUPAC, IUPAC_COMPLEMENT = "ACGTUMRWSYKVHDBNacgtumrwsykvhdbn", "TGCAAKYWSRMBDHVNtgcaakywsrmbdhvn"
STOP_CODONS = ("TAA", "TAG", "TGA", "TAR", "TRA")
#: Canonical donor-acceptor pairs.
CANONICAL_PAIRS = ("GTAG", "GCAG", "ATAC")
#: Bases that are counted one by one.
BASES = "ACGTNacgt"


def reverse_complement(seq: Column) -> Column:
    """Case kept; letters other than A, C, G, T stay as they are. Null gives null."""
    return F.translate(F.reverse(seq), "ACGTacgt", "TGCAtgca")


def reverse_complement_iupac(seq: Column) -> Column:
    return F.translate(F.reverse(seq), IUPAC, IUPAC_COMPLEMENT)


def complement(seq: Column) -> Column:
    return F.translate(seq, "ACGTacgt", "TGCAtgca")


def count_char(seq: Column, ch: str) -> Column:
    return F.length(seq) - F.length(F.replace(seq, F.lit(ch), F.lit("")))


def interval_bases(seq: Column, start: Column, end: Column) -> Column:
    """Bases of a 1-based closed interval; '' where it lies outside the sequence."""
    return F.substring(seq, F.greatest(start, F.lit(1)).cast("int"), F.greatest(end - F.greatest(start, F.lit(1)) + 1, F.lit(0)).cast("int"))


def periodic_bases(seq: Column, start: Column, end: Column) -> Column:
    """Bases of a 1-based closed interval on the endless repetition of seq."""
    n = F.length(seq)
    width = end - start + 1
    return F.substring(F.repeat(seq, F.ceil(width / n).cast("int") + 1), ((start - 1) % n + 1).cast("int"), width.cast("int"))


def has_inner_stop(cds: Column) -> Column:
    """Does a codon before the last one end the frame? Whole codons count from the first base; phase is ignored."""
    return F.exists(
        F.transform(F.sequence(F.lit(1), F.length(cds) - 5, F.lit(3)), lambda i: F.upper(cds.substr(i, F.lit(3)))),
        lambda c: c.isin(*STOP_CODONS),
    ) & (F.length(cds) >= 6)


def inner_stop(cds: Column) -> Column:
    """has_inner_stop, false for sequences of fewer than two codons (sequence() would count down there)."""
    return F.when(F.length(cds) >= 6, has_inner_stop(cds)).when(cds.isNotNull(), F.lit(False))


def attribute(field: Column, key: str) -> Column:
    """First value of a key in a GFF3 or GTF attribute field by pattern; null where the key or its value is missing."""
    return F.nullif(F.regexp_extract(field, attribute_pattern(key), 1), F.lit(""))


def attribute_pattern(key: str) -> str:
    return r"(?:^|[;,|])\s*" + key + r"""\s*[= ]\s*["']?([^;,|"'\s]+)"""


def attribute_at(field: Column, position: int) -> Column:
    """The piece at a position between semicolons (negative: from the end), blanks trimmed; null outside."""
    return F.trim(F.try_element_at(F.split(field, ";"), F.lit(position)))


def attribute_map(field: Column) -> Column:
    """All key=value pairs between semicolons as a map; of equal keys the last wins."""
    pairs = F.filter(F.transform(F.split(field, ";"), lambda p: F.split(F.trim(p), "=", 2)), lambda p: F.size(p) == 2)
    return F.aggregate(pairs, F.create_map().cast("map<string,string>"), lambda m, p: F.map_concat(F.map_filter(m, lambda k, _: k != p[0]), F.create_map(p[0], p[1])))


def round_half_even(numerator: Column, denominator: Column, digits: int = 2) -> Column:
    """numerator / denominator rounded half to even on the exact fraction of two integers."""
    scale = 10**digits
    twice = numerator * 2 * scale
    low = F.floor(twice / (denominator * 2))
    low = F.expr("0") + low
    rest = twice - low * denominator * 2
    up = (rest > denominator) | ((rest == denominator) & (low % 2 != 0))
    return (low + F.when(up, 1).otherwise(0)) / scale


def lowest_bit(mask: Column) -> Column:
    """Number of the lowest set bit, 0 for an empty mask (argmax of a 0/1 row)."""
    return F.when(mask == 0, 0).otherwise(F.log2(mask.bitwiseAND(-mask).cast("double")).cast("int"))


def splice_pair(intron: Column, strand: Column) -> Column:
    """Donor and acceptor dinucleotides of an intron's forward bases, read on its strand."""
    on = F.when(strand == "-", reverse_complement(intron)).otherwise(intron)
    return F.upper(F.concat(F.substring(on, 1, 2), F.right(on, F.lit(2))))


def without_type(ident: Column) -> Column:
    """The id in type:id, up to a further colon; an id without colon as it is."""
    return F.when(ident.contains(":"), F.split(ident, ":")[1]).otherwise(ident)
