"""Alignment tables: normal form, islands, grouping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from syntenia.functions import intervals as iv
from syntenia.operators.stretches import Before, UpTo, running
from syntenia.options import Clustering

KEYS = ("chr_id", "strand", "prot_id")


def with_strand(hsps: DataFrame) -> DataFrame:
    """strand 1 where loc_start < loc_end, else -1."""
    return hsps.withColumn("strand", F.when(F.col("loc_start") < F.col("loc_end"), F.lit(1)).otherwise(F.lit(-1)))


def oriented(hsps: DataFrame, exact_origin: bool = False) -> DataFrame:
    """Adds strand and coordinates that grow along the protein on either strand.

    On the minus strand a coordinate is the file-wide maximum plus 1000 minus the
    location (``exact_origin``), or just the negative location: only differences are
    used later, and no pass over the table is needed.
    """
    h = with_strand(hsps)
    low, high = F.least("loc_start", "loc_end"), F.greatest("loc_start", "loc_end")
    if exact_origin:
        top = hsps.agg((F.max(F.greatest("loc_start", "loc_end")) + 1000).alias("origin"))
        h = h.crossJoin(F.broadcast(top))  # one row
        origin: Column = F.col("origin")
    else:
        origin = F.lit(0).cast("long")
    minus = F.col("strand") == -1
    h = h.withColumn("loc_startS", F.when(minus, origin - high).otherwise(low)).withColumn("loc_endS", F.when(minus, origin - low).otherwise(high))
    return h.drop("origin")


def sequence_maxima(hsps: DataFrame) -> DataFrame:
    """(chr_id, max_coordinate): the furthest position of each sequence that an alignment reaches."""
    return hsps.groupBy("chr_id").agg(F.max(F.greatest("loc_start", "loc_end")).alias("max_coordinate"))


#: Fixed value: what the earlier finder adds to a sequence's furthest position.
MIRROR = 1_000_000
#: Shares in which a sequence's alignments meet its furthest position, so that one sequence isn't one task.
SPREAD = 64


def mirrored(hsps: DataFrame) -> DataFrame:
    """Strand, stranded sequence name and coordinates as the earlier finder has them: on the minus strand counted back from the sequence's furthest position."""
    spread = F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1)))
    deal = F.pmod(F.xxhash64("prot_id", "loc_start", "loc_end"), F.lit(SPREAD)).cast("int")
    h = with_strand(hsps).withColumn("__deal", deal).join(sequence_maxima(hsps).withColumn("__deal", spread), ["chr_id", "__deal"]).drop("__deal")
    plus, origin = F.col("strand") == 1, F.col("max_coordinate") + MIRROR
    turned = lambda c: F.when(plus, F.col(c)).otherwise(origin - F.col(c))
    name = F.when(plus, F.col("chr_id")).otherwise(F.concat("chr_id", F.lit("_revcomp")))
    return h.withColumns({"chrS_id": name, "loc_startS": turned("loc_start"), "loc_endS": turned("loc_end")}).drop("max_coordinate")


def sorted_hsps(hsps: DataFrame) -> DataFrame:
    """Sequence, strand, protein, start; ties by end and protein start."""
    return hsps.orderBy("chr_id", "strand", "prot_id", "loc_startS", "loc_endS", "prot_start")


def gap_limit(longest_intron: Column, options: Clustering) -> Column:
    """The gap that an island may span: longer introns stretch it."""
    return F.greatest(F.lit(options.max_gap), F.coalesce((longest_intron * options.intron_factor).cast("long"), F.lit(0)))


def islands(rows: DataFrame, keys: Sequence[str], start: str, end: str, limit: Column, ties: Sequence[str] = (), name: str = "island", stretch: int | None = None) -> DataFrame:
    """Numbers runs of rows in which each starts within ``limit`` of all ends before it.

    The running maximum of ends runs over the whole partition, which is the same as
    over the island: a new island begins beyond every end before it. With ``stretch`` a
    key's rows are dealt out by stretches of so many positions (``stretches.running``),
    so that one sequence isn't one task.
    """
    if stretch is not None:
        along = lambda df, what: running(df, keys, start, [start, end, *ties], what, stretch)
        marked = along(rows, {"__before": Before("max", F.col(end))})
        new = F.when(F.col("__before").isNull() | (F.col(start) - F.col("__before") > limit), F.lit(1)).otherwise(F.lit(0))
        return along(marked.withColumn("__new", new).drop("__before"), {name: UpTo("sum", F.col("__new"))}).drop("__new")
    order = Window.partitionBy(*keys).orderBy(start, end, *ties)
    before = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(before.isNull() | (F.col(start) - before > limit), F.lit(1)).otherwise(F.lit(0))
    marked = rows.withColumn("__new", new)
    return marked.withColumn(name, F.sum("__new").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("__new")


def hsp_islands(hsps: DataFrame, genes: DataFrame | None = None, options: Clustering = Clustering()) -> DataFrame:
    """Islands of each (sequence, strand, protein); genes (gene, longest_intron) stretch the gap of their protein."""
    if genes is None:
        h = hsps.withColumn("longest_intron", F.lit(None).cast("long"))
    else:
        h = hsps.join(genes.select(F.col("gene").alias("prot_id"), "longest_intron"), "prot_id", "left")
    return islands(h, KEYS, "loc_startS", "loc_endS", gap_limit(F.col("longest_intron"), options), ("prot_start", "prot_end", "nident"))


def island_summary(rows: DataFrame, keys: Sequence[str] = (*KEYS, "island"), start: str = "loc_startS", end: str = "loc_endS") -> DataFrame:
    """Hull, sums and covered positions of each island."""
    spans = F.collect_list(F.struct(F.col(start).alias("start"), F.col(end).alias("end")))
    return rows.groupBy(*keys).agg(F.count("*").alias("n"), F.min(start).alias("start"), F.max(end).alias("end"), F.sum("nident").alias("nident"), iv.union_length(spans).alias("covered"))


def grouped_hsps(hsps: DataFrame, stretch: int = 1 << 20) -> DataFrame:
    """(chr_id, strand, stretch, hsps): alignments of each sequence and strand as arrays of structs.

    An array holds those that begin in one stretch of ``stretch`` positions, so that no
    row grows with a whole chromosome.
    """
    cols = [c for c in hsps.columns if c not in ("chr_id", "strand")]
    at = F.floor(F.col("loc_startS") / stretch).alias("stretch")
    return hsps.groupBy("chr_id", "strand", at).agg(F.sort_array(F.collect_list(F.struct(*cols))).alias("hsps"))


def identity_between(hsps: DataFrame, low: float, high: float) -> DataFrame:
    """Alignments whose identity is in a closed range."""
    return hsps.where(F.col("pident").between(low, high))


def far_from_own_locus(rows: DataFrame, genes: DataFrame, min_distance: int, start: str = "start", end: str = "end") -> DataFrame:
    """Drops islands on their own gene's sequence that are nearer than ``min_distance`` to it (0: none)."""
    if min_distance <= 0:
        return rows
    g = genes.select(F.col("gene").alias("prot_id"), F.col("seqid").alias("__chr"), F.col("start").alias("__s"), F.col("end").alias("__e"))
    gap = iv.distance(F.col(start), F.col(end), F.col("__s"), F.col("__e"))
    near = F.coalesce((F.col("chr_id") == F.col("__chr")) & (gap < min_distance), F.lit(False))
    return rows.join(g, "prot_id", "left").where(~near).drop("__chr", "__s", "__e")
