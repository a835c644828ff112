"""Gene-model drafts: cleaning CDS runs, lifting them, choosing the best."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from syntenia.functions import coordinates
from syntenia.operators.alignments import islands
from syntenia.operators.intervals import without_contained

MERGE_GAP, NEAR_GAP, EXON_GAP, ALTERATION_GAP, SHORT = 15, 25, 30, 25, 3


def glued(cds: DataFrame, keys: Sequence[str], ties: Sequence[str] = ()) -> DataFrame:
    """Joins CDS that follow each other without a gap."""
    found = islands(without_contained(cds, keys, ties=ties), keys, "start", "end", F.lit(1), ties)
    return found.groupBy(*keys, "island").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("island")


def long_enough(rows: DataFrame, least: int = SHORT) -> DataFrame:
    return rows.where(F.col("end") - F.col("start") > least)


def _runs(rows: DataFrame, keys: Sequence[str], joins: Column) -> DataFrame:
    """Hulls of runs of rows that each join the row before; ``joins`` sees its end as ``__before``."""
    order = Window.partitionBy(*keys).orderBy("start", "end")
    marked = rows.withColumn("__before", F.lag("end").over(order))
    marked = marked.withColumn("__new", F.when(F.coalesce(joins, F.lit(False)), F.lit(0)).otherwise(F.lit(1)))
    numbered = marked.withColumn("__run", F.sum("__new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*keys, "__run").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("parts")).drop("__run")


def merged_in_frame(cds: DataFrame, keys: Sequence[str], gap: int = NEAR_GAP) -> DataFrame:
    """Joins CDS at most ``gap`` apart if whole codons lie between."""
    space = F.col("start") - F.col("__before") - 1
    return _runs(cds, keys, (F.col("start") - F.col("__before") <= gap) & (space % 3 == 0))


def predicted_exons(cds: DataFrame, keys: Sequence[str], gap: int = EXON_GAP) -> DataFrame:
    """Exons: runs of CDS that start before the last end plus ``gap``."""
    return _runs(cds, keys, F.col("start") < F.col("__before") + gap)


def predicted_alterations(cds: DataFrame, keys: Sequence[str], gap: int = ALTERATION_GAP) -> DataFrame:
    """Sequence alterations between close CDS: the gap, or the overlap."""
    before = F.lag("end").over(Window.partitionBy(*keys).orderBy("start", "end"))
    near = cds.withColumn("__p", before).where(F.col("start") < F.col("__p") + gap)
    apart = F.col("start") > F.col("__p")
    return near.select(*keys, F.when(apart, F.col("__p") + 1).otherwise(F.col("start")).alias("start"), F.when(apart, F.col("start") - 1).otherwise(F.col("__p")).alias("end"))


def short_introns_closed(cds: DataFrame, keys: Sequence[str], gap: int = MERGE_GAP) -> DataFrame:
    """A scan that joins a CDS to the kept one before it.

    They join if they overlap by less than ``gap`` or lie at most ``gap`` apart, in
    the same frame. The kept end decides, so the scan folds over the sorted array.
    """
    span = F.struct(F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"))
    lists = cds.groupBy(*keys).agg(F.array_sort(F.collect_list(span)).alias("c"))

    def step(acc: Column, x: Column) -> Column:
        last = F.get(acc, F.size(acc) - 1)
        space = x["start"] - last["end"] - 1
        joins = (F.size(acc) > 0) & (space <= gap) & (space > -gap) & (space % 3 == 0)
        grown = F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"))
        return F.when(joins, F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(grown))).otherwise(F.concat(acc, F.array(x)))

    empty = F.array().cast("array<struct<start:bigint,end:bigint>>")
    return lists.select(*keys, F.explode(F.aggregate("c", empty, step)).alias("x")).select(*keys, "x.start", "x.end")


def overlaps_fixed(cds: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Moves a CDS start behind the end before it, by whole codons; a CDS that vanishes goes."""
    before = F.max("end").over(Window.partitionBy(*keys).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1))
    short = F.greatest(F.lit(0), F.coalesce(before - F.col("start") + 1, F.lit(0)))
    return cds.withColumn("start", F.col("start") + F.ceil(short / 3) * 3).where(F.col("start") <= F.col("end"))


def gene_hulls(cds: DataFrame, keys: Sequence[str]) -> DataFrame:
    return cds.groupBy(*keys).agg(F.min("start").alias("start"), F.max("end").alias("end"))


def consistent_hits(hits: DataFrame, keys: Sequence[str], slack: int = 10) -> DataFrame:
    """Keeps hits, by query start, that lie behind the last kept one on query and subject (within ``slack``)."""
    row = F.struct("qstart", "qend", "sstart", "send")
    lists = hits.groupBy(*keys).agg(F.array_sort(F.collect_list(row)).alias("h"))

    def step(acc: Column, x: Column) -> Column:
        last = F.get(acc, F.size(acc) - 1)
        fits = (F.size(acc) == 0) | (x["qstart"] > last["qend"] - slack) & (x["sstart"] > last["send"] - slack)
        return F.when(fits, F.concat(acc, F.array(x))).otherwise(acc)

    kind = "array<struct<qstart:bigint,qend:bigint,sstart:bigint,send:bigint>>"
    kept = F.aggregate(F.col("h").cast(kind), F.array().cast(kind), step)
    return lists.select(*keys, F.explode(kept).alias("x")).select(*keys, "x.*")


def hits_as_cds(hits: DataFrame, keys: Sequence[str], slack: int = 10) -> DataFrame:
    """CDS rows from consistent hits; ends swap where they are reversed."""
    kept = consistent_hits(hits, keys, slack)
    return kept.select(*keys, F.least("sstart", "send").alias("start"), F.greatest("sstart", "send").alias("end")).distinct()


def cleaned_draft(cds: DataFrame, keys: Sequence[str]) -> DataFrame:
    """An aligner's CDS rows: duplicates, contained rows, glued rows, short rows, short introns."""
    rows = glued(cds.select(*keys, F.least("start", "end").alias("start"), F.greatest("start", "end").alias("end")).distinct(), keys)
    return short_introns_closed(long_enough(rows), keys)


def lifted(rows: DataFrame, target: str = "target", strand: str = "strand", back: bool = False) -> DataFrame:
    """Rows moved between genome and target coordinates; target ids end in their origin."""
    span = coordinates.lifted(F.col("start"), F.col("end"), coordinates.target_position(F.col(target)), F.col(strand), back)
    return rows.withColumn("__x", span).withColumn("start", F.col("__x.start")).withColumn("end", F.col("__x.end")).drop("__x")


DRAFT_KEYS = ("target", "method", "seqid", "strand")


def draft_models(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """An aligner's CDS rows on targets as cleaned CDS rows of the genome.

    rows: (target, method, start, end) in coordinates of the target, whose id ends in
    its origin; targets: (target, seqid, strand). Rows are lifted, then cleaned as by
    ``cleaned_draft``; those of an unknown target are left out.
    """
    placed = rows.select("target", "method", "start", "end").join(targets.select("target", "seqid", "strand"), "target")
    return cleaned_draft(lifted(placed, back=True), list(DRAFT_KEYS))


def hit_models(hits: DataFrame, targets: DataFrame, method: str = "mapping") -> DataFrame:
    """CDS rows of the genome from a target's consistent hits (target, qstart, qend, sstart, send), and the same cleaning."""
    return draft_models(hits_as_cds(hits, ["target"]).withColumn("method", F.lit(method)), targets)


def protein_lengths(cds: DataFrame, keys: Sequence[str]) -> DataFrame:
    """floor((sum of |end - start| + 3) / 3) of each model."""
    return cds.groupBy(*keys).agg(F.floor((F.sum(F.abs(F.col("end") - F.col("start"))) + 3) / 3).alias("aa"))


def evaluated(models: DataFrame) -> DataFrame:
    """Identity, coverage and score of each model.

    Needs n_identical, n_positive, template_len, own_len, longest (drafts of all
    methods) and penalty. Scores are shares of the longer of template and drafts.
    """
    den = F.greatest("template_len", "longest")
    part = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    return (
        models.withColumn("ident", part(F.col("n_identical"), den))
        .withColumn("ident_query", part(F.col("n_identical"), F.col("template_len")))
        .withColumn("cov", part(F.col("n_positive"), F.col("longest")))
        .withColumn("cov_query", part(F.col("n_positive"), F.col("template_len")))
        .withColumn("score", part(F.col("n_positive"), den))
        .withColumn("score_nc", part(F.col("n_positive"), den) - 0.01 * F.col("penalty"))
    )


def best_method(models: DataFrame, target: str, score: str = "score", rank: str = "method_rank") -> DataFrame:
    """The best-scored model of each target: the earliest method wins ties, no positive score gives none."""
    best = models.where(F.col(score) > 0).groupBy(target).agg(F.max_by(F.struct(*[c for c in models.columns if c != target]), F.struct(F.col(score), -F.col(rank))).alias("m"))
    return best.select(target, "m.*")


def best_template(hits: DataFrame, query: str = "qseqid", subject: str = "sseqid") -> DataFrame:
    """The subject with the highest bit score for each query; of equal ones the last by name."""
    return hits.groupBy(query).agg(F.max(F.struct("bitscore", subject)).alias("x")).select(query, F.col(f"x.{subject}").alias("template"))
