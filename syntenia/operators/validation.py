"""Tests of gene models against their sequence, and correction of their ends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from syntenia.functions import attributes as at
from syntenia.functions import sequences as sq
from syntenia.operators.extraction import cut

FRAMESHIFT_GAP = 25


def models(features: DataFrame) -> DataFrame:
    """(gene, seqid, strand, cds): sorted CDS intervals of each gene."""
    span = F.struct(F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"))
    return features.where(F.col("type") == "CDS").groupBy("gene").agg(F.min("seqid").alias("seqid"), F.min("strand").alias("strand"), F.array_sort(F.collect_list(span)).alias("cds"))


#: Letters beside a model that its ends may be moved over: 20 codons, and one more.
AROUND = 63


def _beside_sequence(genes: DataFrame, fasta: DataFrame, margin: int) -> DataFrame:
    """Models with ``seq``, their stretch and ``margin`` letters on either side, and cds counted from it (``off`` less)."""
    low, high = F.array_min(F.transform("cds", lambda x: x["start"])), F.array_max(F.transform("cds", lambda x: x["end"]))
    # grouped first, so that no filter below is pushed into the expressions that made the models
    m = genes.groupBy("gene", "seqid", "strand").agg(F.collect_list("cds").alias("__all")).select("gene", "seqid", "strand", F.explode("__all").alias("cds"))
    m = m.where(F.size("cds") > 0).withColumn("start", low - margin).withColumn("end", high + margin)
    m = cut(m, fasta).withColumnRenamed("piece", "seq").withColumn("off", (F.greatest(F.col("start"), F.lit(1)) - 1).cast("long")).drop("start", "end")
    return m.withColumn("cds", _moved(F.col("cds"), -F.col("off")))


def _moved(cds, by):
    return F.transform(cds, lambda x: F.struct((x["start"] + by).cast("long").alias("start"), (x["end"] + by).cast("long").alias("end")))


def alerts(genes: DataFrame, fasta: DataFrame) -> DataFrame:
    """(chr, prot_id, no_start, no_stop, fs, splice, stop_in_frame, length_pb, validity) of each model.

    A gap of at most 25 positions between CDS is a frameshift; a wider one must be
    a canonical intron. Valid models raise nothing.
    """
    m = _beside_sequence(genes, fasta, 0)
    parts = F.transform("cds", lambda x: sq.piece(F.col("seq"), x["start"], x["end"]))
    m = m.withColumn("__cdna", F.upper(sq.stranded(F.array_join(parts, ""), F.col("strand"))))
    gaps = F.when(F.size("cds") > 1, F.transform(F.sequence(F.lit(1), F.size("cds") - 1), lambda i: F.struct(F.get("cds", i - 1)["end"].alias("a"), F.get("cds", i)["start"].alias("b")))).otherwise(F.array().cast("array<struct<a:bigint,b:bigint>>"))
    m = m.withColumn("__gaps", gaps).withColumn("__prot", sq.translate(F.col("__cdna")))
    size = lambda g: g["b"] - g["a"] - 1
    flags = {
        "no_start": sq.no_start(F.substring("__cdna", 1, 3)),
        "no_stop": sq.no_stop(F.substring(F.col("__cdna"), F.length("__cdna") - 2, F.lit(3))),
        "fs": F.exists("__gaps", lambda g: size(g) <= FRAMESHIFT_GAP),
        "splice": F.exists("__gaps", lambda g: (size(g) > FRAMESHIFT_GAP) & ~sq.canonical_intron(F.col("seq"), g["a"], g["b"], F.col("strand"))),
        "stop_in_frame": F.coalesce(F.instr("__prot", "*") > 0, F.lit(False)) & (F.instr("__prot", "*") < F.length("__prot")),
        "length_pb": F.length("__cdna") % 3 != 0,
    }
    out = m.select(F.col("seqid").alias("chr"), F.col("gene").alias("prot_id"), *(c.alias(k) for k, c in flags.items()))
    bad = F.lit(False)
    for k in flags:
        bad = bad | F.col(k)
    return out.withColumn("validity", F.when(bad, "NotValid").otherwise("Valid"))


FLAGS = ("no_start", "no_stop", "fs", "splice", "stop_in_frame", "length_pb")


def penalty(rows: DataFrame) -> DataFrame:
    """Adds penalty: twice the number of raised flags."""
    return rows.withColumn("penalty", 2 * sum((F.col(f).cast("int") for f in FLAGS), F.lit(0)))


def commented(rows: DataFrame, info: DataFrame, identity: str = "ident", coverage: str = "cov") -> DataFrame:
    """Adds tags, colour, family and class: alerts beside the locus information of their origin."""
    tags = F.array_join(F.array_compact(F.array(*(F.when(F.col(f), F.lit(f)) for f in FLAGS))), ",")
    same = (F.col(identity) >= 1) & (F.col(coverage) >= 1)
    joined = rows.join(info.select(F.col("gene_id").alias("prot_id"), at.family_name(F.col("family")).alias("family"), "class"), "prot_id", "left")
    return joined.withColumn("tags", tags).withColumn("color", at.colour(F.col("validity") == "Valid", same))


def parted(cds: Column) -> Column:
    """Sorted CDS, of which none starts before the end of one before it: starts move by whole codons, what vanishes goes."""

    def step(acc: Column, x: Column) -> Column:
        short = F.greatest(F.lit(0), F.coalesce(acc["end"] - x["start"] + 1, F.lit(0)))
        start = (x["start"] + F.ceil(short / 3) * 3).cast("long")
        own = F.struct(start.alias("start"), x["end"].cast("long").alias("end"))
        kept = F.when(start <= x["end"], F.concat(acc["cds"], F.array(own))).otherwise(acc["cds"])
        return F.struct(kept.alias("cds"), F.greatest(acc["end"], x["end"].cast("long")).alias("end"))

    zero = F.struct(F.array().cast("array<struct<start:bigint,end:bigint>>").alias("cds"), F.lit(None).cast("long").alias("end"))
    return F.aggregate(F.array_sort(cds), zero, step, lambda acc: acc["cds"])


def stops_in_frame(genes: DataFrame, fasta: DataFrame) -> DataFrame:
    """(gene, stops): stop codons of each model's CDS, read as one frame."""
    m = _beside_sequence(genes, fasta, 0)
    cdna = sq.stranded(F.array_join(F.transform("cds", lambda x: sq.piece(F.col("seq"), x["start"], x["end"])), ""), F.col("strand"))
    return m.select("gene", F.regexp_count(sq.translate(cdna), F.lit("\\*")).alias("stops"))


def merged_where_no_stop_comes(genes: DataFrame, merged: DataFrame, fasta: DataFrame) -> DataFrame:
    """Of each model the merged form, unless that has more stops in frame than the one before."""
    before, after = (stops_in_frame(g, fasta).withColumnRenamed("stops", name) for g, name in ((genes, "__before"), (merged, "__after")))
    worse = before.join(after, "gene").where("__after > __before").select("gene")
    return merged.join(worse, "gene", "left_anti").unionByName(genes.join(worse, "gene", "left_semi"))


def verified(models: DataFrame, fasta: DataFrame, info: DataFrame) -> DataFrame:
    """Models (gene, seqid, strand, cds, origin, method, ident, cov) with alerts, penalty, tags, colour, family, class and comment."""
    own = models.select(F.col("gene").alias("prot_id"), "origin", "method", "ident", "cov")
    rows = penalty(alerts(models, fasta)).join(own, "prot_id")
    out = commented(rows, info)
    return out.withColumn("comment", at.model_comment(F.col("origin"), F.col("method"), F.col("ident"), F.col("cov")))


def corrected(genes: DataFrame, fasta: DataFrame) -> DataFrame:
    """Moves a model's ends to start and stop codons and its introns to canonical sites.

    In this order: overlapping CDS are parted by whole codons, the last partial codon
    is dropped, the start is looked for upstream, the stop downstream (both within 20
    codons), each intron is shifted by up to two positions. Adds tags of what was done.
    """
    m = _beside_sequence(genes.withColumn("cds", parted(F.col("cds"))), fasta, AROUND).withColumn("__plus", F.col("strand") != "-")
    total = F.aggregate("cds", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"] + 1)
    last = lambda c: F.get(c, F.size(c) - 1)
    rest = total % 3

    def with_edges(cds, first, end):
        """cds with another first start and last end."""
        n = F.size(cds)
        return F.transform(cds, lambda x, i: F.struct(F.when(i == 0, first).otherwise(x["start"]).cast("long").alias("start"), F.when(i == n - 1, end).otherwise(x["end"]).cast("long").alias("end")))

    m = m.withColumn("__rest", rest)
    whole = with_edges(F.col("cds"), F.when(F.col("__plus"), F.get("cds", 0)["start"]).otherwise(F.get("cds", 0)["start"] + F.col("__rest")), F.when(F.col("__plus"), last(F.col("cds"))["end"] - F.col("__rest")).otherwise(last(F.col("cds"))["end"]))
    m = m.withColumn("__c1", whole)
    m = m.withColumn("__lo", F.get("__c1", 0)["start"]).withColumn("__hi", last(F.col("__c1"))["end"])
    five, three = F.when(F.col("__plus"), F.col("__lo")).otherwise(F.col("__hi")), F.when(F.col("__plus"), F.col("__hi")).otherwise(F.col("__lo"))
    seq, strand = F.col("seq"), F.col("strand")
    m = m.withColumn("__five", F.when(sq.is_start(seq, five, strand), five).otherwise(F.coalesce(sq.find_start(seq, five, strand), five)))
    m = m.withColumn("__three", F.when(sq.is_stop(seq, three, strand), three).otherwise(F.coalesce(sq.find_stop(seq, three, strand), three)))
    m = m.withColumn("__c2", with_edges(F.col("__c1"), F.when(F.col("__plus"), F.col("__five")).otherwise(F.col("__three")), F.when(F.col("__plus"), F.col("__three")).otherwise(F.col("__five"))))
    n = F.size("__c2")
    c = F.col("__c2")
    wide = lambda i: F.get(c, i)["start"] - F.get(c, i - 1)["end"] - 1 > FRAMESHIFT_GAP
    shift = lambda i: sq.splice_shift(seq, F.get(c, i - 1)["end"], F.get(c, i)["start"], strand)
    zero = F.lit(0)
    m = m.withColumn(
        "__c3",
        F.transform(
            c,
            lambda x, i: F.struct(
                (x["start"] + F.when((i > 0) & wide(i), shift(i)["right"]).otherwise(zero)).cast("long").alias("start"),
                (x["end"] + F.when((i < n - 1) & wide(i + 1), shift(i + 1)["left"]).otherwise(zero)).cast("long").alias("end"),
            ),
        ),
    )
    done = F.array_compact(
        F.array(
            F.when(F.col("__rest") > 0, F.lit("length")),
            F.when(F.col("__five") != five, F.lit("start")),
            F.when(F.col("__three") != three, F.lit("stop")),
            F.when(F.col("__c3") != F.col("__c2"), F.lit("splice")),
        )
    )
    return m.select("gene", "seqid", "strand", _moved(F.col("__c3"), F.col("off")).alias("cds"), F.array_join(done, ",").alias("corrections"))
