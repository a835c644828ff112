"""The whole transfer as one plan: alignments and drafts in, cleaned features and statistics out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from syntenia.operators import cleaning, evaluation, extraction, features, loci
from syntenia.options import Expansion, LocusOptions, Workflow
from syntenia.plans.candidate_loci import find_candidate_loci


def candidates(hsps: DataFrame, annotation: DataFrame, genome: DataFrame, options: LocusOptions = LocusOptions(expansion=Expansion())) -> dict[str, DataFrame]:
    """Loci with their features, pairs and sequences."""
    resolved = features.resolved(annotation)
    found = loci.with_ids(find_candidate_loci(hsps, resolved, options))
    return {"loci": found, "features": loci.as_features(found), "pairs": loci.pair_list(found), "sequences": extraction.locus_sequences(found, genome)}


def gathered(methods: dict[str, DataFrame], options: Workflow = Workflow()) -> dict[str, DataFrame]:
    """Cleaned union of all methods' models, and counts."""
    named = [m.withColumn("source", F.lit(name)) for name, m in methods.items()]
    every, placed = cleaning.merged_predictions(named, options.prefix)
    return {"features": every, "placed": placed, "counts": evaluation.model_counts(placed)}
