"""Gene-model prediction in two rounds, from aligner drafts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from syntenia.operators import prediction, validation

#: The order in which drafts of equal score win.
METHODS = ("mapping", "cdna2genome", "cdna2genomeExon", "cds2genome", "cds2genomeExon", "prot2genome", "prot2genomeExon")


def best_models(drafts: DataFrame, fasta: DataFrame, scores: Callable[[DataFrame], DataFrame], guard: bool = False) -> DataFrame:
    """The best corrected model of each target.

    ``drafts``: (target, method, seqid, strand, start, end) CDS rows in genome
    coordinates. ``scores`` gets (target, method, cds, ...) and adds n_identical,
    n_positive, template_len and own_len, from an aligner or a table. ``guard``: CDS are
    not merged where that brings more stops in frame (off gives the established result).
    """
    keys = ["target", "method", "seqid", "strand"]
    clean = prediction.cleaned_draft(drafts, keys)
    cds = prediction.merged_in_frame(clean, keys)
    span = F.struct(F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"))
    lists = lambda rows: rows.groupBy(*keys).agg(F.array_sort(F.collect_list(span)).alias("cds")).withColumn("gene", F.concat_ws("|", "target", "method"))
    models = lists(cds)
    if guard:
        models = validation.merged_where_no_stop_comes(lists(clean), models, fasta)
    fixed = validation.corrected(models, fasta).join(models.select("gene", "target", "method"), "gene")
    flags = validation.penalty(validation.alerts(fixed.select("gene", "seqid", "strand", "cds"), fasta)).withColumnRenamed("prot_id", "gene")
    rows = scores(fixed).join(flags.drop("chr"), "gene")
    longest = prediction.protein_lengths(cds, ["target", "method"]).groupBy("target").agg(F.max("aa").alias("longest"))
    rank = F.array_position(F.array(*[F.lit(m) for m in METHODS]), F.col("method"))
    rows = rows.join(longest, "target").withColumn("method_rank", F.when(rank > 0, rank).otherwise(F.lit(len(METHODS) + 1)))
    return prediction.best_method(prediction.evaluated(rows), "target")


def two_rounds(first: DataFrame, templates: DataFrame, again: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Predicts once more where the best protein's nearest template isn't the one that was used.

    ``first``: best models with (target, query); ``templates``: (target, template).
    ``again`` predicts for (target, template) pairs. One more round, no fixpoint.
    """
    redo = first.join(templates, "target").where("template != query").select("target", "template")
    second = again(redo)
    return first.join(second.select("target").distinct(), "target", "left_anti").unionByName(second, allowMissingColumns=True)
