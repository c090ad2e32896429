"""The 15 states of every base as run-length segments, and their slices for chunks.

States: IR (intergenic), I0..I2 (intron by the frame before it), E0..E2 (coding, by frame), START, STOP, EI0..EI2 and IE0..IE2
(outer bases of coding rows). A coding run is one segment though its frame turns with every base: what stays is the
frame less the position, from which the frame at any base follows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandloom.operators import labels as lb
from strandloom.operators import transcripts as tx
from strandloom.operators.labels import PLACE
from strandloom.session import materialize

EDGES = ["START", "STOP", "EI0", "EI1", "EI2", "IE0", "IE1", "IE2"]
#: Bit of each label: introns, coding bases by frame less position, edges, and the sequence itself.
BITS = {"I0": 1, "I1": 2, "I2": 4, "E0": 8, "E1": 16, "E2": 32, **{x: 64 << k for k, x in enumerate(EDGES)}, "SEQ": 1 << 14}


def _turn(strand: Column) -> Column:
    return F.when(strand == "-", -1).otherwise(1)


def state_segments(features: DataFrame, places: DataFrame) -> DataFrame:
    """(place, s, e, mask): longest runs of bases with the same labels; places (place, length) are covered from 1 to length.

    features: rows as of features_of; their CDS rows with a transcript count. Where an intron lies on coding bases of
    another transcript both bits stand; an edge overrules both (see state_at). Null places match nothing.
    """
    cds = features.filter("feature = 'CDS' and tx_id is not null")
    runs = materialize(lb.coding_segments(cds, PLACE), "coding")
    introns = materialize(lb.intron_states(tx.introns(features), runs), "introns")
    frame = lb.frame_at(F.col("s"), F.col("cs"), F.col("ce"), F.col("phase"), F.col("strand"))
    still = F.pmod(frame - _turn(F.col("strand")) * F.col("s"), F.lit(3)).cast("string")
    rows = runs.select(*PLACE, F.col("s").alias("start"), F.col("e").alias("end"), F.concat(F.lit("E"), still).alias("label"))
    rows = rows.unionByName(introns.filter("state is not null").select(*PLACE, F.col("intron_start").alias("start"), F.col("intron_end").alias("end"), F.col("state").alias("label")))
    rows = rows.unionByName(lb.edge_states(cds, introns).select(*PLACE, F.col("position").alias("start"), F.col("position").alias("end"), F.col("state").alias("label")))
    whole = places.select(*PLACE, F.lit(1).cast("bigint").alias("start"), F.col("length").alias("end"), F.lit("SEQ").alias("label"))
    return lb.cover_segments(rows.unionByName(whole), PLACE, BITS)


def state_at(mask: Column, position: Column, strand: Column) -> Column:
    """The state of a base of a segment as text: an edge alone, else the coding frame and the introns joined by +, or IR."""
    on = lambda label: mask.bitwiseAND(F.lit(BITS[label])) != 0
    still = F.when(on("E0"), 0).when(on("E1"), 1).when(on("E2"), 2)
    coding = F.concat(F.lit("E"), F.pmod(still + _turn(strand) * position, F.lit(3)).cast("string"))
    inner = F.concat_ws("+", coding, *[F.when(on(f"I{k}"), f"I{k}") for k in range(3)])
    edge = F.coalesce(*[F.when(on(x), x) for x in EDGES])
    return F.coalesce(edge, F.when(inner != "", inner), F.lit("IR"))


def chunk_states(chunks: DataFrame, segments: DataFrame, bin_bits: int = 12) -> DataFrame:
    """(chunk_id, begin, end, state): the segments under each chunk (chunk_id, place, fb, fe: forward half-open), 0-based
    half-open in the chunk's own direction, with the state at their first base there. IR is left out: it is what no
    segment covers. One equi-join on coordinate bins; a pair counts in the first bin that both share."""
    spread = lambda df, s, e: df.withColumn("bin", F.explode(F.sequence(F.shiftright(s, bin_bits), F.shiftright(e, bin_bits))))
    c = spread(chunks.filter("fb < fe").select("chunk_id", *PLACE, "fb", "fe", (F.col("fb") + 1).alias("cs")), "cs", "fe")
    g = spread(segments.filter(F.col("mask") != BITS["SEQ"]), "s", "e")
    both = c.join(g, [*PLACE, "bin"]).filter("s <= fe and cs <= e").withColumn("ps", F.greatest("s", "cs")).withColumn("pe", F.least("e", "fe"))
    both = both.filter(F.shiftright("ps", bin_bits) == F.col("bin"))
    minus = F.col("strand") == "-"
    begin = F.when(minus, F.col("fe") - F.col("pe")).otherwise(F.col("ps") - F.col("cs"))
    state = state_at(F.col("mask"), F.when(minus, F.col("pe")).otherwise(F.col("ps")), F.col("strand"))
    return both.select("chunk_id", begin.alias("begin"), (begin + F.col("pe") - F.col("ps") + 1).alias("end"), state.alias("state"))
