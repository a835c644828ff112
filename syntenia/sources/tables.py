"""Readers of feature, alignment, sequence and list files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from syntenia import schema
from syntenia.functions.sequences import letters

#: Letters of a chunk.
CHUNK = 1 << 16


def _tsv(spark: SparkSession, path: str, fields: str, encoding: str = "UTF-8", mode: str = "FAILFAST") -> DataFrame:
    return spark.read.schema(fields).options(sep="\t", comment="#", nullValue=".", mode=mode, encoding=encoding, ignoreTrailingWhiteSpace=True, quote="").csv(path)


def read_gff(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """Nine columns with ``.`` as null, and row_idx in file order; further columns and carriage returns are dropped."""
    lines = spark.read.option("encoding", encoding).text(path).where("value != '' and not startswith(value, '#')")
    p = F.split(F.rtrim(F.regexp_replace("value", "\r$", "")), "\t")
    kinds = [c.split() for c in schema.GFF.split(", ")]
    # a field of the wrong kind fails the read
    cols = [F.nullif(F.get(p, i), F.lit(".")).cast(kind).alias(name) for i, (name, kind) in enumerate(kinds)]
    return lines.select(F.monotonically_increasing_id().alias("row_idx"), *cols)


def read_hsps(spark: SparkSession, path: str, positive: bool = False, strict: bool = True) -> DataFrame:
    """Tabular alignments of 13 columns, or 14 with ``positive``; a file or a folder of shards.

    A job that reads a line with too few columns, or with a field that isn't a number
    where one belongs, fails; an empty field is null. Without ``strict`` what can't be read is null.
    """
    fields = schema.HSP_POSITIVE if positive else schema.HSP
    if not strict:
        return _tsv(spark, path, fields, mode="PERMISSIVE")
    kinds = [c.split() for c in fields.split(", ")]
    line = F.regexp_replace("value", "\r$", "")
    p = F.split(line, "\t", -1)
    # the columns of strings are there in every line, so each line's width is looked at
    wide = F.when(F.size(p) >= len(kinds), p).otherwise(F.raise_error(F.concat(F.lit(f"fewer than {len(kinds)} columns: "), "value")).cast("array<string>"))
    rows = spark.read.text(path).where("trim(value) != '' and not startswith(value, '#')").select(wide.alias("p"))
    text = lambda i: F.nullif(F.nullif(F.trim(F.get("p", i)), F.lit(".")), F.lit(""))
    return rows.select(*(text(i).cast(kind).alias(name) for i, (name, kind) in enumerate(kinds)))


def read_blast12(spark: SparkSession, path: str) -> DataFrame:
    return _tsv(spark, path, schema.BLAST12)


def read_blast8(spark: SparkSession, path: str) -> DataFrame:
    """Eight columns between any white space."""
    p = F.split(F.trim("value"), r"\s+")
    kinds = [c.split() for c in schema.BLAST8.split(", ")]
    return spark.read.text(path).where("trim(value) != ''").select(*(F.get(p, i).cast(kind).alias(name) for i, (name, kind) in enumerate(kinds)))


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """(seqid, description, seq, len); the id is the header's first word."""
    records = spark.read.option("lineSep", ">").text(path).where("trim(value) != ''")
    head = F.substring_index("value", "\n", 1)
    seq = F.regexp_replace(F.regexp_replace("value", r"^[^\n]*\n?", ""), r"\s", "")
    return records.select(F.regexp_extract(head, r"^\S+", 0).alias("seqid"), F.trim(F.regexp_replace(head, r"^\S+", "")).alias("description"), seq.alias("seq"), F.length(seq).cast("long").alias("len"))


def read_fasta_chunks(spark: SparkSession, path: str, size: int = CHUNK) -> DataFrame:
    """(seqid, chunk_no, seq): the sequences in pieces of ``size`` letters; no row or task holds a chromosome.

    Files are read in Spark's byte ranges, line by line. What a range can't know - the record
    that a line belongs to and its offset - comes from one row for each range: the letters
    before it and the last header. Lines are then cut at the edges of the chunks they
    lie in. A record without letters has one empty chunk; text before the first header is left
    out; an id that stands twice fails the job. A file whose sequences aren't wrapped has
    long lines: such a line is one row while it is read.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range"), F.monotonically_increasing_id().alias("n"), F.rtrim("value").alias("line")
    )
    is_head = F.startswith(F.col("line"), F.lit(">"))
    seqid = F.regexp_extract("line", r"^>\s*(\S*)", 1)
    lines = lines.select("file", "range", "n", F.when(is_head, seqid).alias("head"), F.when(is_head, F.lit("")).otherwise(F.regexp_replace("line", r"\s", "")).alias("seq"))
    size_of = F.length("seq").cast("long")

    here = Window.partitionBy("file", "range").orderBy("n")
    local = lines.withColumn("at", F.coalesce(F.sum(size_of).over(here.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    record = F.when(F.col("head").isNotNull(), F.struct("head", F.col("at").alias("begins")))
    local = local.withColumn("record", F.last(record, True).over(here.rowsBetween(Window.unboundedPreceding, 0)))

    ends = local.groupBy("file", "range").agg(F.sum(size_of).alias("letters"), F.max_by("record", "n").alias("last"))
    past = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    base = F.coalesce(F.sum("letters").over(past), F.lit(0))
    carried = ends.withColumn("base", base).withColumn("last", F.when(F.col("last").isNotNull(), F.struct("last.head", (F.col("last.begins") + F.col("base")).alias("begins"))))
    carried = carried.select("file", "range", "base", F.last("last", True).over(past).alias("before"))

    whole = local.join(carried, ["file", "range"])
    own = F.when(F.col("record").isNotNull(), F.struct("record.head", (F.col("record.begins") + F.col("base")).alias("begins")))
    whole = whole.withColumn("of", F.coalesce(own, "before")).where("of is not null")
    whole = whole.select("file", F.col("of.head").alias("seqid"), F.col("of.begins").alias("begins"), (F.col("base") + F.col("at") - F.col("of.begins")).alias("at"), "seq", (F.col("head").isNotNull()).alias("is_head"))
    last = F.greatest(F.col("at"), F.col("at") + F.length("seq") - 1)
    cut = whole.where("is_head or seq != ''").withColumn("chunk_no", F.explode(F.sequence(F.floor(F.col("at") / size).cast("int"), F.floor(last / size).cast("int"))))
    low = F.greatest(F.col("at"), F.col("chunk_no").cast("long") * size)
    piece = F.substring("seq", (low - F.col("at") + 1).cast("int"), (F.least(F.col("at") + F.length("seq"), (F.col("chunk_no").cast("long") + 1) * size) - low).cast("int"))
    parts = cut.groupBy("file", "seqid", "begins", "chunk_no").agg(F.array_sort(F.collect_list(F.struct(low.alias("at"), F.col("is_head"), piece.alias("part")))).alias("parts"), F.max("is_head").alias("first"))
    chunks = parts.select("seqid", "chunk_no", F.array_join(F.transform("parts", lambda x: x["part"]), "").alias("seq"))

    heads = spark.read.text(path).where("startswith(value, '>')").select(F.regexp_extract("value", r"^>\s*(\S*)", 1).alias("twice"))
    twice = heads.groupBy("twice").count().where("count > 1").select("twice").limit(1)
    once = F.when(F.col("twice").isNull(), F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("repeated sequence id "), "twice")).cast("boolean"))
    return chunks.join(F.broadcast(twice), F.lit(True), "left").where(once).drop("twice")  # one row at most


def unique_ids(fasta: DataFrame) -> DataFrame:
    """The same records; a job that reads them fails if an id stands twice."""
    n = fasta.groupBy("seqid").agg(F.count("*").alias("__n"))
    one = F.when(F.col("__n") == 1, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("repeated sequence id "), "seqid")).cast("boolean"))
    return fasta.join(n, "seqid").where(one).drop("__n").select(*fasta.columns)


def chunked(fasta: DataFrame, size: int = 1 << 20) -> DataFrame:
    """(seqid, chunk_no, seq): long sequences in pieces, so that no row holds a chromosome."""
    n = F.greatest(F.ceil(F.octet_length("seq") / size).cast("int"), F.lit(1))
    cut = letters(F.col("seq"), F.col("chunk_no") * size + 1, F.lit(size))
    return fasta.select("seqid", "seq", F.explode(F.sequence(F.lit(0), n - 1)).alias("chunk_no")).select("seqid", "chunk_no", cut.alias("seq"))


def fasta_index(fasta: DataFrame) -> DataFrame:
    """(seqid, len) of records or of chunks."""
    if "chunk_no" in fasta.columns:
        return fasta.groupBy("seqid").agg(F.sum(F.length("seq").cast("long")).alias("len"))
    return fasta.groupBy("seqid").agg(F.max("len").alias("len"))


def read_gene_list(spark: SparkSession, path: str) -> DataFrame:
    return _tsv(spark, path, "gene string").where("gene is not null")


def read_locus_info(spark: SparkSession, path: str) -> DataFrame:
    """(gene_id, family, class); of repeated ids the last line counts."""
    rows = _tsv(spark, path, schema.LOCUS_INFO).withColumn("__n", F.monotonically_increasing_id())
    last = rows.groupBy("gene_id").agg(F.max_by(F.struct("family", "class"), "__n").alias("x"))
    return last.select("gene_id", "x.family", "x.class")


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    return _tsv(spark, path, schema.PAIRS, mode="PERMISSIVE")


def workflow_options(values: dict) -> object:
    """Workflow options from configuration keys in any case; unknown keys are ignored."""
    from dataclasses import fields

    from syntenia.options import Workflow

    names = {f.name for f in fields(Workflow)}
    return Workflow(**{k.lower(): v for k, v in values.items() if k.lower() in names and v is not None})
