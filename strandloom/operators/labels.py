"""Per-base labels as run-length segments; rows grow with features, never with bases.

A segment is (place, s, e, mask) with 1-based closed coordinates. Elementary intervals come from the boundaries of the
features that touch a coordinate bin, so every window sees one bin of one place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandloom.operators.sweep import prefix_max, prefix_sum, with_previous

PLACE = ["species", "chrom", "strand"]


def cover_segments(features: DataFrame, keys: list[str], bits: dict[str, int], bin_bits: int = 14) -> DataFrame:
    """(keys, s, e, mask): longest runs of bases with the same OR of the bits of all features that cover them.

    features: keys, start, end, label; rows with labels outside bits are ignored. Bases without a feature get no
    segment. Per bit a sweep line counts active features, so overlapping copies cost nothing.
    """
    names = list(bits)
    rows = features.filter(F.col("label").isin(names)).filter("start <= end").select(*keys, "start", "end", "label")
    ends = F.explode(F.array(F.struct(F.col("start").alias("p"), F.lit(1).alias("d")), F.struct((F.col("end") + 1).alias("p"), F.lit(-1).alias("d"))))
    events = rows.select(*keys, "label", ends.alias("x")).groupBy(*keys, F.col("x.p").alias("p")).agg(
        *[F.sum(F.when(F.col("label") == n, F.col("x.d")).otherwise(0)).alias(f"d{i}") for i, n in enumerate(names)]
    )
    events = prefix_sum(events, keys, "p", {f"n{i}": f"d{i}" for i in range(len(names))}, bin_bits)
    mask = F.lit(0)
    for i, n in enumerate(names):
        mask = mask + F.when(F.col(f"n{i}") > 0, bits[n]).otherwise(0)
    at = with_previous(events.select(*keys, F.col("p").alias("s"), mask.alias("mask")), keys, "s", "mask", "__was", bin_bits)
    return _with_ends(at.filter("__was is null or __was <> mask").drop("__was"), keys, bin_bits).filter("mask > 0")


def _with_next(at: DataFrame, keys: list[str], pos: str, bin_bits: int) -> DataFrame:
    """at with the position of each row's next row as __next (null at the last), found inside its bin or at the first row of
    the next bin."""
    binned = at.withColumn("__bin", F.shiftright(pos, bin_bits)).withColumn("__real", F.lit(True))
    bins = binned.groupBy(*keys, "__bin").agg(F.min(pos).alias("__first"))
    nxt = bins.select(*keys, "__bin", F.lit(False).alias("__real"), F.lead("__first").over(W.partitionBy(*keys).orderBy("__bin")).alias(pos)).filter(F.col(pos).isNotNull())
    w = W.partitionBy(*keys, "__bin").orderBy(pos)
    return binned.unionByName(nxt, allowMissingColumns=True).withColumn("__next", F.lead(pos).over(w)).filter("__real").drop("__bin", "__real")


def _with_ends(at: DataFrame, keys: list[str], bin_bits: int) -> DataFrame:
    """Each row's end: one before the next row's start; a key's last row has none and is left out."""
    return _with_next(at, keys, "s", bin_bits).filter("__next is not null").select(*keys, "s", (F.col("__next") - 1).alias("e"), "mask")


def coding_segments(cds: DataFrame, keys: list[str], bin_bits: int = 14) -> DataFrame:
    """(keys, s, e, cs, ce, phase): runs of coding bases with the CDS row that was written last (by end, ord) there.

    Of the rows that have started, the one that ends last covers a base if any does; so the row written last at a base is
    the prefix maximum of (end, ord) by start, and only rows that exceed all before them ever show.
    """
    rows = cds.filter("start <= end").select(*keys, F.col("start").alias("s"), F.struct("end", "ord", "start", F.coalesce(F.col("phase").try_cast("int"), F.lit(0)).alias("phase")).alias("top"))
    first = rows.groupBy(*keys, "s").agg(F.max("top").alias("top"))
    shown = prefix_max(first, keys, "s", "top", "__was", bin_bits, before=True).filter("__was is null or top > __was")
    shown = _with_next(shown.select(*keys, "s", "top"), keys, "s", bin_bits)
    last = F.least(F.col("top.end"), F.coalesce(F.col("__next") - 1, F.col("top.end")))
    return shown.select(*keys, "s", last.alias("e"), F.col("top.start").alias("cs"), F.col("top.end").alias("ce"), F.col("top.phase").alias("phase"))


def frame_at(position, cs, ce, phase, strand):
    """Frame 0..2 of a coding base: counted from the 5' end of its CDS row."""
    k = F.when(strand == "-", ce - position).otherwise(position - cs)
    return F.pmod(k + F.pmod(3 - phase, F.lit(3)), F.lit(3)).cast("int")


def state_counts(seg: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, state, n): coding bases of each of the states E0, E1, E2 from coding segments, by arithmetic."""
    n = F.col("e") - F.col("s") + 1
    first = frame_at(F.col("s"), F.col("cs"), F.col("ce"), F.col("phase"), F.col("strand"))
    step = F.when(F.col("strand") == "-", -1).otherwise(1)
    parts = [F.struct(F.lit(f"E{f}").alias("state"), F.floor((n + 2 - F.pmod((f - first) * step, F.lit(3))) / 3).cast("bigint").alias("n")) for f in range(3)]
    return seg.withColumn("x", F.explode(F.array(*parts))).groupBy(*keys, F.col("x.state").alias("state")).agg(F.sum("x.n").alias("n"))


def intron_states(introns: DataFrame, runs: DataFrame, transition: bool = False) -> DataFrame:
    """(place, intron_start, intron_end, state): I0..I2 by the frame of the coding base before the intron (after it on
    -, one base further with transition); null where no CDS covers that base. runs: coding_segments of the place."""
    far = 1 if transition else 0
    probe = F.when(F.col("strand") == "+", F.col("intron_start") - 1 - far).otherwise(F.col("intron_end") + 1 + far)
    at = introns.select(*PLACE, "intron_start", "intron_end").distinct().withColumn("p", probe)
    # the last coding run that starts at or before the probe, if it reaches that far: runs don't overlap
    runs = runs.select(*PLACE, F.col("s").alias("p"), F.struct("s", "e", "cs", "ce", "phase").alias("run"))
    both = prefix_max(at.unionByName(runs, allowMissingColumns=True), PLACE, "p", "run", "t", 13, then=("intron_start",)).filter("intron_start is not null")
    frame = frame_at(F.col("p"), F.col("t.cs"), F.col("t.ce"), F.col("t.phase"), F.col("strand"))
    return both.select(*PLACE, "intron_start", "intron_end", F.when(F.col("t.e") >= F.col("p"), F.concat(F.lit("I"), frame)).alias("state"))


def edge_states(cds: DataFrame, introns: DataFrame) -> DataFrame:
    """(place, position, state): START, STOP, EI0..2, IE0..2 on the outer bases of CDS rows (the 15-state labels).

    The first transcribed base is START where its outer neighbour is intergenic and IE_k where it is an intron of state
    k; the last one STOP or EI_k. A base that several CDS rows end on takes the row that is last by (end, ord); a CDS of
    one base keeps the state of its last base.
    """
    ends = cds.groupBy(*PLACE, "start", "end").agg(F.max("ord").alias("ord"))
    sides = F.explode(F.array(F.struct(F.lit(-1).alias("out"), F.col("start").alias("p")), F.struct(F.lit(1).alias("out"), F.col("end").alias("p"))))
    pts = ends.withColumn("x", sides).select(*PLACE, "end", "ord", F.col("x.p").alias("position"), F.col("x.out").alias("out"))
    pts = pts.withColumn("five", (F.col("out") == -1) == (F.col("strand") == "+")).groupBy(*PLACE, "position").agg(F.max(F.struct("end", "ord", (-F.col("five").cast("int")).alias("late"), "out", "five")).alias("t"))
    pts = pts.select(*PLACE, "position", F.col("t.five").alias("five"), (F.col("position") + F.col("t.out")).alias("probe"))
    i = introns.filter("state is not null").withColumn("probe", F.explode(F.array_distinct(F.array("intron_start", "intron_end")))).groupBy(*PLACE, "probe").agg(F.min("state").alias("near"))
    known = pts.join(i, [*PLACE, "probe"], "left")
    k = F.substring("near", 2, 1)
    state = F.when(F.col("near").isNull(), F.when(F.col("five"), "START").otherwise("STOP")).when(F.col("five"), F.concat(F.lit("IE"), k)).otherwise(F.concat(F.lit("EI"), k))
    return known.select(*PLACE, "position", state.alias("state"))
