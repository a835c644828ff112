"""Candidate-locus discovery: alignments and a reference annotation in, loci out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from syntenia.operators import alignments, chaining, features, loci
from syntenia.options import LocusOptions


def find_candidate_loci(hsps: DataFrame, annotation: DataFrame, options: LocusOptions = LocusOptions(), chromosomes: Sequence[str] | None = None, stretch: int | None = None) -> DataFrame:
    """Loci of each sequence.

    Islands of alignments are chained, scored against their gene, filtered, made
    disjoint and, with ``options.expansion``, widened. ``annotation`` is a resolved
    feature table. ``chromosomes`` limits the search to some sequences; the filter reaches the scan.
    Loci are chosen in tiles of ``stretch`` positions (see ``loci.non_overlapping``).
    """
    if chromosomes is not None:
        hsps = hsps.where(F.col("chr_id").isin(*chromosomes))
    info = features.gene_info(annotation)
    found = alignments.hsp_islands(alignments.oriented(hsps), info, options.clustering)
    if options.clustering.min_distance:
        placed = found.withColumn("__lo", F.least("loc_start", "loc_end")).withColumn("__hi", F.greatest("loc_start", "loc_end"))
        own = alignments.island_summary(placed, start="__lo", end="__hi")
        near = alignments.far_from_own_locus(own, info, options.clustering.min_distance)
        found = found.join(near.select(*alignments.KEYS, "island"), [*alignments.KEYS, "island"], "left_semi")
    chains = chaining.chain_islands(found, options.scoring)
    good = loci.passing(loci.scored(chains, info, options.clustering, options.scoring), options.scoring)
    kept = loci.non_overlapping(good, options.scoring.shrink, stretch)
    if options.expansion is None:
        return kept
    templates = None
    if options.expansion.use_template:
        templates = features.cds_lists(annotation).join(features.longest_introns(annotation), "gene", "left").select("gene", "cds", "longest_intron")
    return loci.expanded(loci.wanted_expansion(kept, options.expansion, templates))
