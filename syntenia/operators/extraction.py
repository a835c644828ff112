"""Sequences of features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from syntenia.functions import sequences as sq
from syntenia.sources.tables import CHUNK, chunked

#: A CDS that starts within so many nucleotides of the last end marks a frameshift.
FRAMESHIFT_GAP = 15


def cut(rows: DataFrame, fasta: DataFrame, size: int = CHUNK) -> DataFrame:
    """Rows (seqid, start, end, ...) with ``piece``, their closed stretch, clamped to the sequence.

    Sequences are joined as chunks of ``size`` letters, so no row carries a whole
    chromosome; ``fasta`` has whole sequences (seqid, seq) or is such chunks already
    (seqid, chunk_no, seq), as ``read_fasta_chunks`` gives them; a stretch is put together from the chunks it touches. Rows that lie
    wholly outside their sequence, or whose sequence is missing, are left out.
    """
    names = rows.columns
    chunk = lambda at: F.floor((at - 1) / size).cast("int")
    first = F.greatest(F.col("start"), F.lit(1))
    want = rows.groupBy(*names).agg(F.count("*").alias("__rows")).where(F.col("end") >= first)
    want = want.withColumn("__chunk", F.explode(F.sequence(chunk(first), chunk(F.col("end")))))
    chunks = fasta if "chunk_no" in fasta.columns else chunked(fasta, size)
    there = chunks.select(F.col("seqid").alias("__seqid"), F.col("chunk_no").alias("__chunk_no"), F.col("seq").alias("__seq"))
    met = want.join(there, (F.col("seqid") == F.col("__seqid")) & (F.col("__chunk") == F.col("__chunk_no")))
    off = F.col("__chunk") * size
    part = sq.piece(F.col("__seq"), F.col("start") - off, F.col("end") - off)
    whole = met.groupBy(*names, "__rows").agg(F.array_sort(F.collect_list(F.struct(F.col("__chunk").alias("k"), part.alias("part")))).alias("__parts"))
    whole = whole.withColumn("piece", F.array_join(F.transform("__parts", lambda x: x["part"]), "")).where("piece != ''")
    return whole.withColumn("__row", F.explode(F.sequence(F.lit(1), F.col("__rows").cast("int")))).select(*names, "piece")


def gene_sequences(genes: DataFrame, fasta: DataFrame, margin: int = 0) -> DataFrame:
    """(gene, seq) of gene rows with a margin, clamped to the sequence, read on their strand."""
    rows = genes.select("gene", "seqid", "strand", (F.col("start") - margin).alias("start"), (F.col("end") + margin).alias("end"))
    return cut(rows, fasta).select("gene", sq.stranded(F.col("piece"), F.col("strand")).alias("seq"))


def cds_sequences(features: DataFrame, fasta: DataFrame) -> DataFrame:
    """One record for each CDS row."""
    rows = cut(features.where(F.col("type") == "CDS").select("gene", "seqid", "strand", "start", "end"), fasta)
    return rows.select(F.concat("gene", F.lit("_cds")).alias("id"), "gene", "start", "end", sq.stranded(F.col("piece"), F.col("strand")).alias("seq"))


def _marked(rows: DataFrame) -> DataFrame:
    """CDS rows with ``__mark``, the frame mark where one begins right behind the last end."""
    before = F.lag("end").over(Window.partitionBy("gene").orderBy("start", "end"))
    return rows.withColumn("__mark", F.when(F.coalesce(F.col("start") - 1 <= before + FRAMESHIFT_GAP, F.lit(False)), F.lit(sq.FRAME_MARK)).otherwise(F.lit("")))


def _joined(features: DataFrame, fasta: DataFrame, kind: str, mark: bool) -> DataFrame:
    """(gene, strand, seq): the pieces of each gene in sequence order, with frame marks where asked for."""
    rows = features.where(F.col("type") == kind)
    rows = _marked(rows) if mark else rows.withColumn("__mark", F.lit(""))
    pieces = cut(rows.select("gene", "seqid", "strand", "start", "end", "__mark"), fasta).withColumn("__p", F.concat("__mark", "piece"))
    got = pieces.groupBy("gene").agg(F.min("strand").alias("strand"), F.array_sort(F.collect_list(F.struct("start", "end", "__p"))).alias("p"))
    return got.select("gene", "strand", F.array_join(F.transform("p", lambda x: x["__p"]), "").alias("seq"))


def coding_sequences(features: DataFrame, fasta: DataFrame, protein: bool = False) -> DataFrame:
    """cDNA of exon rows, or the protein up to the first stop with a closing ``*``."""
    rows = _joined(features, fasta, "exon", False)
    seq = sq.stranded(F.col("seq"), F.col("strand"))
    return rows.select("gene", (sq.translate_to_stop(seq) if protein else seq).alias("seq"))


def frameshift_sequences(features: DataFrame, fasta: DataFrame, protein: bool = False, marks: bool = True) -> DataFrame:
    """Upper-case cDNA of CDS rows with ``!!!`` at frameshifts, or its whole protein with X there."""
    rows = _joined(features, fasta, "CDS", marks)
    seq = F.upper(sq.stranded(F.col("seq"), F.col("strand")))
    return rows.select("gene", (sq.translate(seq) if protein else seq).alias("seq"))


def locus_sequences(loci: DataFrame, fasta: DataFrame) -> DataFrame:
    """(locus_id, seq) of loci (chr_id, chr_start, chr_end, strand 1 or -1)."""
    rows = loci.select("locus_id", F.col("chr_id").alias("seqid"), F.col("chr_start").alias("start"), F.col("chr_end").alias("end"), "strand")
    return cut(rows, fasta).select("locus_id", sq.stranded(F.col("piece"), F.col("strand")).alias("seq"))


def clamped(bed: DataFrame, index: DataFrame) -> DataFrame:
    """0-based half-open rows cut to their sequence's length."""
    return bed.join(index, "seqid").withColumn("start", F.greatest("start", F.lit(0))).withColumn("end", F.least("end", "len")).drop("len")


def reference_library(features: DataFrame, fasta: DataFrame) -> DataFrame:
    """(id, kind, seq): proteins, cDNA without marks, and CDS records of a reference.

    All three are read from the same pieces (see ``frameshift_sequences``, ``cds_sequences``), which are cut once.
    """
    rows = _marked(features.where(F.col("type") == "CDS"))
    pieces = cut(rows.select("gene", "seqid", "strand", "start", "end", "__mark"), fasta)
    part = F.struct("start", "end", F.concat("__mark", "piece").alias("marked"), "piece", F.col("strand").alias("sign"))
    genes = pieces.groupBy("gene").agg(F.min("strand").alias("strand"), F.array_sort(F.collect_list(part)).alias("p"))
    joined = lambda parts, c: F.upper(sq.stranded(F.array_join(F.transform(parts, lambda x: x[c]), ""), F.col("strand")))
    plain = F.array_sort(F.transform("p", lambda x: F.struct(x["start"], x["end"], x["piece"].alias("piece"))))
    whole = genes.select("gene", sq.translate(joined(F.col("p"), "marked")).alias("protein"), joined(plain, "piece").alias("cdna"), F.transform("p", lambda x: sq.stranded(x["piece"], x["sign"])).alias("cds"))
    row = lambda name, kind, seq: F.struct(name.alias("id"), F.lit(kind).alias("kind"), seq.alias("seq"))
    records = F.transform("cds", lambda x: row(F.concat("gene", F.lit("_cds")), "cds", x))
    return whole.select(F.explode(F.concat(F.array(row(F.col("gene"), "protein", F.col("protein")), row(F.col("gene"), "cdna", F.col("cdna"))), records)).alias("r")).select("r.*")
