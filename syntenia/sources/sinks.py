"""Writers. Empty tables still write their folder and schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from syntenia.operators.features import exons_match
from syntenia.options import Workflow, run_log
from syntenia.schema import GFF

GFF_COLUMNS = [c.split()[0] for c in GFF.split(", ")]


def gff_lines(features: DataFrame, dots: tuple[str, ...] = ("source", "score", "strand", "phase")) -> DataFrame:
    """One column ``value``; nulls in ``dots`` become ``.``, others stay empty; carriage returns go."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("." if c in dots else ""))
    return features.select(F.regexp_replace(F.concat_ws("\t", *(text(c) for c in GFF_COLUMNS)), "\r", "").alias("value"))


def write_gff(features: DataFrame, path: str, dots: tuple[str, ...] = ("source", "score", "strand", "phase")) -> None:
    gff_lines(features, dots).write.text(path)


def write_sorted_gff(features: DataFrame, path: str) -> None:
    """Only score and phase get a ``.``."""
    write_gff(features, path, ("score", "phase"))


def fasta_lines(rows: DataFrame, name: str = "seqid", seq: str = "seq") -> DataFrame:
    return rows.select(F.concat(F.lit(">"), name, F.lit("\n"), seq).alias("value"))


def write_fasta(rows: DataFrame, path: str, name: str = "seqid", seq: str = "seq") -> None:
    """Two lines for each record."""
    fasta_lines(rows, name, seq).write.text(path)


def write_fasta_by_record(rows: DataFrame, path: str, name: str = "seqid", seq: str = "seq") -> None:
    """A folder for each record, named by the id up to ``;`` or ``::``."""
    key = F.regexp_extract(F.col(name), r"^(.*?)(?:;|::|\s|$)", 1)
    rows.select(F.concat(F.lit(">"), name, F.lit("\n"), seq).alias("value"), key.alias("record")).write.partitionBy("record").text(path)


def bed_rows(features: DataFrame, name: Column | None = None, one_based: bool = False) -> DataFrame:
    """(seqid, start, end, name, score, strand), 0-based half-open unless ``one_based``."""
    start = F.col("start") if one_based else F.col("start") - 1
    return features.select("seqid", start.alias("start"), "end", (name if name is not None else F.col("gene")).alias("name"), F.lit(0).alias("score"), "strand")


def write_tsv(rows: DataFrame, path: str, header: bool = True) -> None:
    """Tabs, booleans as True and False."""
    text = [F.when(F.col(c), "True").when(~F.col(c), "False").alias(c) if t == "boolean" else F.col(c) for c, t in rows.dtypes]
    rows.select(*text).write.options(sep="\t", header=header).csv(path)


def feature_rows(models: DataFrame, reverse_numbers: bool = True) -> DataFrame:
    """gene, mRNA, exon and CDS rows of models (gene, seqid, source, strand, cds); numbers run against the minus strand."""
    n = F.size("cds")
    number = lambda i: F.when((F.col("strand") == "-") & F.lit(reverse_numbers), n - i).otherwise(i + 1).cast("string")
    first, last = F.array_min(F.transform("cds", lambda x: x["start"])), F.array_max(F.transform("cds", lambda x: x["end"]))
    row = lambda kind, s, e, phase, text: F.struct(F.lit(kind).alias("type"), s.cast("long").alias("start"), e.cast("long").alias("end"), phase.cast("long").alias("phase"), text.alias("attributes"))
    none = F.lit(None)
    g = F.col("gene")
    part = lambda kind, tag, phase: F.transform("cds", lambda x, i: row(kind, x["start"], x["end"], phase, F.concat(F.lit("ID="), g, F.lit(f":{tag}_"), number(i), F.lit(";Parent="), g, F.lit("_mrna"))))
    rows = F.concat(
        F.array(row("gene", first, last, none, F.concat(F.lit("ID="), g)), row("mRNA", first, last, none, F.concat(F.lit("ID="), g, F.lit("_mrna;Parent="), g))),
        part("exon", "exon", none),
        part("CDS", "cds", F.lit(0)),
    )
    out = models.select("gene", "seqid", "source", "strand", F.posexplode(rows).alias("rank", "r"))
    return out.select("gene", "rank", "seqid", "source", "r.type", "r.start", "r.end", F.lit(None).cast("string").alias("score"), "strand", "r.phase", "r.attributes")


#: Nearer CDS are parts of one exon; nearer ones are marked as altered sequence.
EXON_GAP, ALTERATION_GAP = 30, 25
_SPANS = "array<struct<start:bigint,end:bigint>>"


def exons_of(cds: Column) -> Column:
    """Exons of a model's CDS in their order: a CDS that starts near the last one's end goes on in its exon."""
    span = lambda a, b: F.struct(a.cast("long").alias("start"), b.cast("long").alias("end"))

    def step(acc: Column, x: Column) -> Column:
        n = F.size(acc)
        last = F.get(acc, n - 1)
        near = (n > 0) & (x["start"] < last["end"] + EXON_GAP)
        return F.when(near, F.concat(F.slice(acc, F.lit(1), n - 1), F.array(span(last["start"], x["end"])))).otherwise(F.concat(acc, F.array(span(x["start"], x["end"]))))

    return F.aggregate(cds, F.array().cast(_SPANS), step)


def alterations_of(cds: Column) -> Column:
    """What lies between, or is shared by, CDS that follow each other closely."""
    at = lambda i: (F.get(cds, i - 1)["end"], F.get(cds, i)["start"])

    def between(i: Column) -> Column:
        a, b = at(i)
        return F.struct(F.when(a < b, a + 1).otherwise(b).cast("long").alias("start"), F.when(a < b, b - 1).otherwise(a).cast("long").alias("end"))

    places = F.filter(F.sequence(F.lit(1), F.size(cds) - 1), lambda i: at(i)[1] < at(i)[0] + ALTERATION_GAP)
    return F.when(F.size(cds) > 1, F.transform(places, between)).otherwise(F.array().cast(_SPANS))


def formatted_rows(models: DataFrame) -> DataFrame:
    """gene, mRNA, exon, CDS and sequence_alteration rows of models (gene, seqid, source, strand, start, end, attributes, cds, exons).

    Exons that don't match the CDS are predicted from them; given exons beyond the number of
    predicted ones stay, as established. A model without CDS keeps its exons. Numbers run against the minus strand.
    """
    new = exons_of(F.col("cds"))
    given = F.coalesce("exons", F.array().cast(_SPANS))
    rest = F.filter(F.transform(given, lambda x, i: F.struct(x["start"].alias("start"), x["end"].alias("end"), i.alias("i"))), lambda x: x["i"] >= F.size(new))
    mended = F.concat(new, F.transform(rest, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))))
    rows = models.withColumn("cds", F.coalesce("cds", F.array().cast(_SPANS)))
    rows = rows.withColumn("exons", F.when(exons_match(given, F.col("cds")) | (F.size("cds") == 0), given).otherwise(mended)).withColumn("__altered", alterations_of(F.col("cds")))
    g = F.col("gene")
    row = lambda kind, s, e, text: F.struct(F.lit(kind).alias("type"), s.cast("long").alias("start"), e.cast("long").alias("end"), text.alias("attributes"))

    def part(kind: str, tag: str, column: str) -> Column:
        n = F.size(column)
        number = lambda i: F.when(F.col("strand") == "-", n - i).otherwise(i + 1).cast("string")
        return F.transform(column, lambda x, i: row(kind, x["start"], x["end"], F.concat(F.lit("ID="), g, F.lit(f":{tag}_"), number(i), F.lit(";Parent="), g, F.lit("_mrna"))))

    heads = F.array(row("gene", F.col("start"), F.col("end"), F.col("attributes")), row("mRNA", F.col("start"), F.col("end"), F.concat(F.lit("ID="), g, F.lit("_mrna;Parent="), g)))
    every = F.concat(heads, part("exon", "exon", "exons"), part("CDS", "cds", "cds"), part("sequence_alteration", "frameshift", "__altered"))
    out = rows.select("gene", "seqid", "source", "strand", F.posexplode(every).alias("rank", "r"))
    none = F.lit(None)
    return out.select("gene", "rank", "seqid", "source", "r.type", "r.start", "r.end", none.cast("string").alias("score"), "strand", none.cast("long").alias("phase"), "r.attributes")


def write_run_log(spark: SparkSession, options: Workflow, commit: str, when: str, path: str) -> None:
    """The lines of ``options.run_log`` as a text file."""
    spark.createDataFrame([(x,) for x in run_log(options, commit, when)], "value string").coalesce(1).write.text(path)
