"""Predictions against known annotations, input checks and statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from syntenia.functions import intervals as iv
from syntenia.operators.intervals import overlap_join

BIN = 1 << 14
#: Positions of a block in which a candidate looks for genes that lie inside it.
NEAR = 32


def best_matches(candidates: DataFrame, reference: DataFrame, width: int = BIN) -> DataFrame:
    """The reference gene that each candidate covers most.

    Both sides: gene, seqid, start, end, cds (reference: bounds of its coding
    region). loci_overlap is the share of reference CDS inside the candidate's
    bounds, cds_overlap inside its CDS. Of equal ones the first by start wins;
    candidates that cover nothing have no row.

    No pair is formed where a gene lies wholly inside a candidate: no share is larger, so
    the first such gene wins. Genes are kept by start, the least end of each start in blocks of
    ``NEAR`` positions; a candidate looks it up in two blocks. The other candidates meet each
    start once, however many genes begin there. Genes whose CDS begins behind their start
    are compared in pairs.
    """
    c = candidates.select(F.col("gene").alias("candidate"), "seqid", F.col("start").alias("c_start"), F.col("end").alias("c_end"), iv.merged(F.col("cds")).alias("c_cds")).where("c_start <= c_end")
    r = reference.select(F.col("gene").alias("reference"), "seqid", F.col("start").alias("r_start"), F.col("end").alias("r_end"), iv.merged(F.col("cds")).alias("r_cds"))
    r = r.where("r_start <= r_end").withColumn("size", iv.union_length(F.col("r_cds"))).where("size > 0")
    last = F.element_at("r_cds", -1)["end"]
    plain = (F.get("r_cds", F.lit(0))["start"] == F.col("r_start")) & (last <= F.col("r_end")) & F.forall("r_cds", lambda x: x["start"] <= x["end"])

    alike = r.where(plain).groupBy("seqid", "r_start", "r_cds").agg(F.min("reference").alias("reference"), F.first("size").alias("size"))
    starts = alike.groupBy("seqid", "r_start").agg(F.sort_array(F.collect_list(F.struct(last.alias("end"), "reference", "r_cds", "size"))).alias("genes"))
    first_end = F.get("genes", F.lit(0))["end"]
    at = F.floor(F.col("r_start") / NEAR)
    filed = starts.select("seqid", F.explode(F.array(at - 1, at)).alias("__block"), F.struct(F.col("r_start").alias("at"), first_end.alias("end")).alias("x"))
    blocks = filed.groupBy("seqid", "__block").agg(F.sort_array(F.collect_list("x")).alias("__ends"))
    inside = F.filter("__ends", lambda x: (x["at"] >= F.col("c_start")) & (x["end"] <= F.col("c_end")))
    looked = c.withColumn("__block", F.floor(F.col("c_start") / NEAR)).join(blocks, ["seqid", "__block"], "left").withColumn("r_start", F.get(inside, F.lit(0))["at"]).drop("__block", "__ends")

    row = ["candidate", "seqid", "c_cds"]
    whole = F.array(F.struct(F.col("c_start").cast("long").alias("start"), F.col("c_end").cast("long").alias("end")))
    # what decides comes first, so that the least one is the best
    judged = lambda x: F.struct((-(iv.shared_length(x["r_cds"], whole) / x["size"])).alias("less"), x["reference"].alias("reference"), x["r_cds"].alias("r_cds"), x["size"].alias("size"))
    placed = lambda df, best: df.withColumn("__b", best).where("__b.less < 0").select(*row, F.col("__b.less").alias("less"), "r_start", "__b.reference", "__b.r_cds", "__b.size")
    found = looked.where("r_start is not null").join(starts, ["seqid", "r_start"])
    contained = F.array_min(F.transform(F.filter("genes", lambda x: x["end"] <= F.col("c_end")), lambda x: F.struct(F.lit(-1.0).alias("less"), x["reference"].alias("reference"), x["r_cds"].alias("r_cds"), x["size"].alias("size"))))
    rest = looked.where("r_start is null").drop("r_start")
    spans = starts.withColumn("r_end", F.array_max(F.transform("genes", lambda x: x["end"])))
    partly = overlap_join(rest, spans, ["seqid"], ("c_start", "c_end"), ("r_start", "r_end"), width)
    pairs = overlap_join(c, r.where(F.coalesce(~plain, F.lit(True))), ["seqid"], ("c_start", "c_end"), ("r_start", "r_end"), width)
    one = {n: F.col(n) for n in ("r_cds", "size", "reference")}
    every = placed(found, contained).unionByName(placed(partly, F.array_min(F.transform("genes", judged)))).unionByName(placed(pairs, judged(one)))
    best = F.min(F.struct("less", "r_start", "reference", "seqid", "r_cds", "size", "c_cds"))
    won = every.groupBy("candidate").agg(best.alias("b")).select("candidate", "b.*")
    return won.select("candidate", "reference", "seqid", (-F.col("less")).alias("loci_overlap"), (iv.shared_length(F.col("r_cds"), F.col("c_cds")) / F.col("size")).alias("cds_overlap"))


def missed(reference: DataFrame, matches: DataFrame, min_score: float = 0.1) -> DataFrame:
    """Reference genes that no candidate matches well enough."""
    hit = matches.where(F.col("loci_overlap") >= min_score).select(F.col("reference").alias("gene")).distinct()
    return reference.join(hit, "gene", "left_anti")


def evaluation(reference: DataFrame, matches: DataFrame, min_score: float = 0.1) -> DataFrame:
    """One row: matching candidates, matched genes, missed genes. ``matches`` is read once."""
    good = matches.where(F.col("loci_overlap") >= min_score).select(F.col("reference").alias("gene"), F.lit(1).alias("hit"), F.lit(0).alias("known"))
    genes = reference.select("gene", F.lit(0).alias("hit"), F.lit(1).alias("known"))
    each = good.unionByName(genes).groupBy("gene").agg(F.sum("hit").alias("hits"), F.sum("known").alias("known"))
    met = (F.col("hits") > 0) & F.col("gene").isNotNull()
    total = lambda x: F.coalesce(F.sum(x), F.lit(0).cast("long"))
    return each.agg(total(F.col("hits")).alias("total_matches"), F.count_if(met).alias("matched_genes"), total(F.when(~met, F.col("known")).otherwise(F.lit(0))).alias("missed_genes"))


def input_errors(features: DataFrame, fasta: DataFrame, info: DataFrame) -> DataFrame:
    """(level, message): what is wrong with the inputs.

    Fatal: no sequences, no gene, CDS or exon rows, a sequence id that the FASTA
    lacks. A warning: a gene without locus information.
    """
    none = lambda rows, text: rows.groupBy().agg(F.count("*").alias("n")).where("n = 0").select(F.lit("fatal").alias("level"), F.lit(text).alias("message"))
    out = none(fasta, "no sequences")
    for kind in ("gene", "CDS", "exon"):
        out = out.union(none(features.where(F.col("type").contains(kind)), f"no {kind} rows"))
    lost = features.select("seqid").distinct().join(fasta.select("seqid"), "seqid", "left_anti")
    out = out.union(lost.agg(F.min("seqid").alias("s")).where("s is not null").select(F.lit("fatal"), F.concat(F.lit("no sequence "), "s")))
    unknown = features.where("type = 'gene'").select(F.col("ID").alias("gene_id")).distinct().join(info.select("gene_id"), "gene_id", "left_anti")
    return out.union(unknown.agg(F.min("gene_id").alias("g")).where("g is not null").select(F.lit("warning"), F.concat(F.lit("no locus information for "), "g")))


def model_counts(features: DataFrame) -> DataFrame:
    """Genes in all, by method and by sequence: (kind, name, n)."""
    g = features.where("type = 'gene'")
    total = g.agg(F.count("*").alias("n")).select(F.lit("total").alias("kind"), F.lit("").alias("name"), "n")
    by = lambda kind, c: g.groupBy(c).count().select(F.lit(kind).alias("kind"), F.col(c).alias("name"), F.col("count").alias("n"))
    return total.union(by("method", "source")).union(by("sequence", "seqid"))


def unusual_counts(logs: DataFrame, count: str = "lines") -> DataFrame:
    """Rows whose count isn't the most frequent one (the least of equally frequent ones)."""
    sizes = logs.groupBy(count).agg(F.count("*").alias("n"))
    usual = sizes.agg(F.min_by(F.col(count), F.struct(-F.col("n"), F.col(count))).alias("__usual"))
    return logs.crossJoin(F.broadcast(usual)).where(F.col(count) != F.col("__usual")).drop("__usual")


def alert_counts(alerts: DataFrame, by: str = "family") -> DataFrame:
    flags = ("no_start", "no_stop", "fs", "splice", "stop_in_frame", "length_pb")
    return alerts.groupBy(by).agg(F.count("*").alias("n"), *(F.count_if(F.col(f)).alias(f) for f in flags))


def evaluation_listing(reference: DataFrame, matches: DataFrame, min_score: float = 0.1) -> DataFrame:
    """(seqid, kind, candidate, reference, loci_overlap, cds_overlap): matches, then missed genes, with three decimals."""
    three = lambda c: F.format_string("%.3f", F.col(c)).alias(c)
    none = F.lit(None).cast("string")
    good = matches.where(F.col("loci_overlap") >= min_score).select("seqid", F.lit("match").alias("kind"), "candidate", "reference", three("loci_overlap"), three("cds_overlap"))
    lost = missed(reference, matches, min_score).select("seqid", F.lit("missed").alias("kind"), none.alias("candidate"), F.col("gene").alias("reference"), none.alias("loci_overlap"), none.alias("cds_overlap"))
    return good.unionByName(lost)


def count_lines(features: DataFrame) -> DataFrame:
    """One column ``value``: the counts of ``model_counts`` as lines of text."""
    name = F.when(F.col("name") == "", F.lit("all")).otherwise(F.col("name"))
    return model_counts(features).select(F.concat_ws("\t", "kind", name, F.col("n").cast("string")).alias("value"))
