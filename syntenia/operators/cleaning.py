"""Uniform ids, regenerated exons and adjusted bounds; merging of predictions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from syntenia.functions import attributes as at
from syntenia.operators.features import ordinal


def renamed(features: DataFrame, prefix: str = "", adjust: bool = False) -> DataFrame:
    """Genes, transcripts and CDS with new ids, and exons equal to the CDS.

    A gene is prefix, sequence and ten-digit start; its transcripts and their CDS
    are numbered by start. Rows whose parent is missing are left out (``orphans``
    lists them). ``adjust`` widens parents to their children, by number.
    """
    f = features.select("row_idx", "seqid", "source", "type", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), "score", "strand", "phase", "attributes")
    f = f.withColumn("own", at.piece(F.col("attributes"), "ID")).withColumn("parent", at.piece(F.col("attributes"), "Parent")).withColumn("rest", at.others(F.col("attributes")))
    genes = f.where("type = 'gene'").withColumn("new_gene", F.concat_ws("_", F.nullif(F.lit(prefix), F.lit("")), "seqid", at.padded(F.col("start"))))
    mrna = f.where("type = 'mRNA'").join(genes.select(F.col("own").alias("parent"), "new_gene"), "parent")
    mrna = mrna.withColumn("new_mrna", F.concat("new_gene", F.lit("_mrna_"), ordinal(mrna, "new_gene").cast("string")))
    cds = f.where("type = 'CDS'").join(mrna.select(F.col("own").alias("parent"), "new_mrna", "new_gene"), "parent")
    cds = cds.withColumn("n", ordinal(cds, "new_mrna").cast("string"))
    if adjust:
        span = lambda rows, key: rows.groupBy(key).agg(F.min("start").alias("__s"), F.max("end").alias("__e"))
        wide = lambda rows, low, key: rows.join(span(low, key), key, "left").withColumn("start", F.least("start", F.coalesce("__s", "start"))).withColumn("end", F.greatest("end", F.coalesce("__e", "end"))).drop("__s", "__e")
        mrna = wide(mrna, cds, "new_mrna")
        genes = wide(genes, mrna, "new_gene")
    cols = ["row_idx", "seqid", "source", "type", "start", "end", "score", "strand", "phase"]
    none = F.lit("")
    out = [
        genes.select(*cols, at.rebuilt(F.col("new_gene"), none, F.col("rest")).alias("attributes"), "new_gene", F.lit(0).alias("level")),
        mrna.select(*cols, at.rebuilt(F.col("new_mrna"), F.col("new_gene"), F.col("rest")).alias("attributes"), "new_gene", F.lit(1).alias("level")),
        cds.withColumn("type", F.lit("exon")).withColumn("phase", F.lit(None).cast("long")).select(*cols, at.rebuilt(F.concat("new_mrna", F.lit("_exon_"), "n"), F.col("new_mrna"), none).alias("attributes"), "new_gene", F.lit(2).alias("level")),
        cds.select(*cols, at.rebuilt(F.concat("new_mrna", F.lit("_CDS_"), "n"), F.col("new_mrna"), F.col("rest")).alias("attributes"), "new_gene", F.lit(3).alias("level")),
    ]
    return reduce(DataFrame.unionByName, out)


def orphans(features: DataFrame) -> DataFrame:
    """Transcripts without their gene and CDS without their transcript."""
    f = features.withColumn("own", at.piece(F.col("attributes"), "ID")).withColumn("parent", at.piece(F.col("attributes"), "Parent"))
    ids = lambda kind: f.where(F.col("type") == kind).select(F.col("own").alias("parent"))
    lost = lambda kind, above: f.where(F.col("type") == kind).join(ids(above), "parent", "left_anti")
    return lost("mRNA", "gene").unionByName(lost("CDS", "mRNA")).drop("own", "parent")


def merged_predictions(methods: Sequence[DataFrame], prefix: str = "", without: str = "contig") -> tuple[DataFrame, DataFrame]:
    """The union of all predictions, cleaned; and the same without one sequence."""
    every = renamed(reduce(DataFrame.unionByName, methods), prefix, adjust=True)
    return every, every.where(F.col("seqid") != without)
