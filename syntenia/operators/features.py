"""Feature hierarchies: gene, transcript, exon and CDS rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from syntenia.functions import attributes as at
from syntenia.functions.ordering import natural_key


def with_ids(rows: DataFrame) -> DataFrame:
    """ID and Parent from the attributes."""
    return rows.withColumn("ID", at.first_value(F.col("attributes"), "ID")).withColumn("ParentID", at.first_value(F.col("attributes"), "Parent"))


def resolved(rows: DataFrame) -> DataFrame:
    """Adds mRNA and gene of every row.

    A transcript is its own mRNA, other rows take their parent; the gene comes from
    the transcript, a gene row is its own. With exactly one gene id in the table,
    rows without a gene take it.
    """
    r = with_ids(rows).withColumn("mRNA", F.when(F.col("type") == "mRNA", F.col("ID")).otherwise(F.col("ParentID")))
    parents = r.where(F.col("type") == "mRNA").select("mRNA", F.col("ParentID").alias("gene"))
    r = r.join(parents, "mRNA", "left").withColumn("gene", F.when(F.col("type") == "gene", F.col("ID")).otherwise(F.col("gene")))
    one = r.where(F.col("type") == "gene").agg(F.when(F.count_distinct("ID") == 1, F.first("ID", ignorenulls=True)).alias("__one"))
    return r.crossJoin(F.broadcast(one)).withColumn("gene", F.coalesce("gene", "__one")).drop("__one")  # one row


def coding_regions(features: DataFrame) -> DataFrame:
    """(gene, seqid, strand, start, end): the hull of each gene's CDS rows; rows without a gene form one group."""
    first = lambda c: F.min_by(c, "row_idx").alias(c)
    return features.where(F.col("type") == "CDS").groupBy("gene").agg(first("seqid"), first("strand"), F.min("start").alias("start"), F.max("end").alias("end"))


def longest_introns(features: DataFrame) -> DataFrame:
    """(gene, longest_intron) of every gene with CDS or gene rows; 0 without an intron."""
    before = F.lag("end").over(Window.partitionBy("mRNA").orderBy("start", "row_idx"))
    gaps = features.where(F.col("type") == "CDS").withColumn("gap", F.greatest(F.lit(0), F.coalesce(F.col("start") - before - 1, F.lit(0))))
    found = gaps.groupBy("gene").agg(F.max("gap").alias("longest"))
    genes = features.where(F.col("type").isin("gene", "CDS") & F.col("gene").isNotNull()).select("gene").distinct()
    return genes.join(found, "gene", "left").select("gene", F.coalesce("longest", F.lit(0)).cast("long").alias("longest_intron"))


def gene_info(features: DataFrame) -> DataFrame:
    """Coding region and longest intron of each gene."""
    return coding_regions(features).join(longest_introns(features), "gene", "left").withColumn("longest_intron", F.coalesce("longest_intron", F.lit(0)))


def nearest_quantile(rows: DataFrame, column: str, q: float, width: int = 1 << 16) -> DataFrame:
    """One row: the value of a whole-number column at rank round(q * (n - 1)); none for no values.

    Values are counted by bands of ``width``, then one by one in the band that holds
    the rank, so only counts are put in order.
    """
    bands = rows.where(F.col(column).isNotNull()).groupBy(F.floor(F.col(column) / width).alias("band")).agg(F.count("*").alias("n"))
    before = Window.orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy("band").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    bands = bands.select("band", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"), F.round(F.lit(q) * (F.sum("n").over(every) - 1)).alias("rank"))
    band = bands.where("before <= rank and rank < before + n").select("band", "before", "rank")
    values = rows.join(F.broadcast(band), F.floor(F.col(column) / width) == F.col("band"))  # one band
    values = values.groupBy(F.col(column).alias("quantile"), "before", "rank").agg(F.count("*").alias("n"))
    upto = F.col("before") + F.sum("n").over(Window.orderBy("quantile"))
    return values.withColumn("upto", upto).where("upto - n <= rank and rank < upto").select("quantile")


def cds_lists(features: DataFrame) -> DataFrame:
    """(gene, cds, seqid, strand, start, end): sorted CDS intervals of all transcripts, with the gene row's bounds."""
    span = F.struct(F.col("start"), F.col("end"))
    lists = features.where(F.col("type") == "CDS").groupBy("gene").agg(F.array_sort(F.collect_list(span)).alias("cds"))
    first = lambda c: F.min_by(c, "row_idx").alias(c)
    genes = features.where(F.col("type") == "gene").groupBy("gene").agg(*(first(c) for c in ("seqid", "strand", "start", "end")))
    return lists.join(genes, "gene", "left")


def kept_by_attribute(features: DataFrame, key: str, value: str) -> DataFrame:
    """Transcripts with key=value, their children, and genes that keep a transcript."""
    flag = features.where(F.col("type") == "mRNA").select("mRNA", "gene", at.has_value(F.col("attributes"), key, value).alias("__keep"))
    good = flag.where("__keep = 1")
    below = features.where(F.col("type") != "gene").join(good.select("mRNA").distinct(), "mRNA", "left_semi")
    genes = features.where(F.col("type") == "gene").join(good.select("gene").distinct(), "gene", "left_semi")
    return below.unionByName(genes)


def unresolved_by_attribute(features: DataFrame, key: str, value: str) -> DataFrame:
    """All rows of genes that have no transcript with key=value."""
    mrna = features.where(F.col("type") == "mRNA")
    good = mrna.where(at.has_value(F.col("attributes"), key, value) == 1).select("gene").distinct()
    genes = features.where(F.col("type") == "gene").select("gene").distinct().join(good, "gene", "left_anti")
    return features.join(genes, "gene", "left_semi")


def of_genes(features: DataFrame, ids: DataFrame) -> DataFrame:
    """All rows of the listed genes (a column ``gene``)."""
    return features.join(ids.select("gene").distinct(), "gene", "left_semi")


def without_genes(features: DataFrame, ids: DataFrame) -> DataFrame:
    """All rows but those of the listed genes; an empty list removes none."""
    return features.join(ids.select("gene").distinct(), "gene", "left_anti")


def hierarchy_keys(features: DataFrame) -> DataFrame:
    """Adds gene_order, mRNA_order and type_order, the keys of the hierarchical order.

    Genes count from 0 by sequence and start, transcripts from 2; a gene row has
    transcript order 0, a row without transcript 1.
    """
    rank = lambda kind, key, name, base: _ranked(features.where(F.col("type") == kind), key, name, base)
    f = features.join(rank("gene", "gene", "gene_order", 0), "gene", "left").join(rank("mRNA", "mRNA", "mRNA_order", 2), "mRNA", "left")
    f = f.withColumn("mRNA_order", F.when(F.col("type") == "gene", F.lit(0)).otherwise(F.coalesce("mRNA_order", F.lit(1))).cast("long"))
    return f.withColumn("type_order", F.when(F.col("type") == "gene", F.lit(1)).when(F.col("type") == "mRNA", F.lit(2)).otherwise(F.lit(3)))


def _ranked(rows: DataFrame, key: str, name: str, base: int) -> DataFrame:
    """First rows of each key, counted by (seqid, start): ranks within a sequence plus the rows of those before."""
    first = rows.groupBy(key).agg(F.min(F.struct("seqid", "start", "row_idx")).alias("at")).select(key, "at.*")
    within = first.withColumn("__rank", F.row_number().over(Window.partitionBy("seqid").orderBy("start", "row_idx", key)))
    sizes = first.groupBy("seqid").agg(F.count("*").alias("n"))
    before = sizes.withColumn("__before", F.coalesce(F.sum("n").over(Window.orderBy("seqid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return within.join(before.select("seqid", "__before"), "seqid").select(key, (F.col("__before") + F.col("__rank") - 1 + base).alias(name))


def hierarchical(features: DataFrame) -> DataFrame:
    """The hierarchical order, ties by row order."""
    return hierarchy_keys(features).orderBy("gene_order", "mRNA_order", "type_order", "start", "row_idx")


def ordinal(rows: DataFrame, parent: str, start: str = "start", ties: tuple[str, ...] = ("row_idx",)) -> Column:
    """The row's number within its parent, by numeric start."""
    return F.row_number().over(Window.partitionBy(parent).orderBy(F.col(start).cast("long"), *ties))


def type_counts(features: DataFrame) -> DataFrame:
    """One row: genes, CDS and exon rows."""
    return features.agg(*(F.count_if(F.col("type").contains(k)).alias(f"n_{k.lower()}") for k in ("gene", "CDS", "exon")))


def natural_order(rows: DataFrame) -> DataFrame:
    """Rows by sequence and start as a version sort has them, at one start the gene row first, then by type."""
    kind = F.when(F.col("type") == "gene", F.lit("")).otherwise(F.col("type"))
    return rows.orderBy(natural_key(F.col("seqid")), "start", kind)


def exons_match(exons: Column, cds: Column, compat: bool = True) -> Column:
    """Whether exons (array of start, end, in order) have CDS with their starts and ends; false if either list is empty.

    The established result carries its two marks from exon to exon: it says no at the
    first exon where one is still missing, so all depends on the first exon. With
    ``compat`` off every exon needs a CDS with its start and one with its end.
    """
    marks = F.struct(F.lit(False).alias("start"), F.lit(False).alias("end"), F.lit(True).alias("ok"))

    def step(at: Column, x: Column) -> Column:
        carried = (lambda c: at[c]) if compat else (lambda c: F.lit(False))
        start = carried("start") | F.exists(cds, lambda y: y["start"] == x["start"])
        end = carried("end") | F.exists(cds, lambda y: y["end"] == x["end"])
        return F.struct(start.alias("start"), end.alias("end"), (at["ok"] & start & end).alias("ok"))

    return F.coalesce((F.size(exons) > 0) & (F.size(cds) > 0) & F.aggregate(exons, marks, step, lambda at: at["ok"]), F.lit(False))


def joined_cds(cds: Column, first: Column, second: Column) -> Column:
    """``cds`` with the interval at place ``first`` drawn out to the end of that at ``second``, which goes; places count from 1."""
    end = F.element_at(cds, second)["end"]
    drawn = F.transform(cds, lambda x, i: F.struct(x["start"].alias("start"), F.when(i + 1 == first, end).otherwise(x["end"]).alias("end"), (i + 1 == second).alias("gone")))
    return F.transform(F.filter(drawn, lambda x: ~x["gone"]), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))


def gene_extents(features: DataFrame) -> DataFrame:
    """(gene, longest_gap, genomic_length, coding_start, coding_end): the earlier finder's table of genes.

    A transcript's gaps are from one CDS end to the next start, in file order, both counted in; a gene has the
    largest of its transcripts'. Genes without CDS have no row.
    """
    rows = features.where((F.col("type") == "CDS") & F.col("mRNA").isNotNull())
    following = F.lead("start").over(Window.partitionBy("mRNA").orderBy("row_idx"))
    per = rows.withColumn("__gap", following - F.col("end")).groupBy("mRNA").agg(F.max("__gap").alias("gap"), F.min("start").alias("low"), F.max("end").alias("high"))
    owners = features.where(F.col("type") == "mRNA").select("mRNA", F.col("ParentID").alias("gene"))
    found = per.join(owners, "mRNA").groupBy("gene")
    return found.agg(F.coalesce(F.max("gap"), F.lit(0)).alias("longest_gap"), F.max(F.col("high") - F.col("low") + 1).alias("genomic_length"), F.min("low").alias("coding_start"), F.max("high").alias("coding_end"))


def with_extents(hsps: DataFrame, extents: DataFrame, named: int = 9) -> DataFrame:
    """Alignments with their gene's extents; the job fails if a protein has none, and names the first ``named``."""
    keys = hsps.select("prot_id").distinct()
    lost = keys.join(extents.select(F.col("gene").alias("prot_id")), "prot_id", "left_anti").orderBy("prot_id").limit(named).agg(F.array_join(F.sort_array(F.collect_list("prot_id")), ", ").alias("__lost"))
    rows = hsps.crossJoin(F.broadcast(lost)).where(F.when(F.col("__lost") == "", F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("no gene for the proteins "), "__lost")).cast("boolean"))).drop("__lost")  # one row
    return rows.join(extents.withColumnRenamed("gene", "prot_id"), "prot_id")
