import pytest
from pyspark.sql import functions as F

from syntenia.functions import attributes as at
from syntenia.operators import cleaning, evaluation, features, prediction, regions
from syntenia.options import Workflow, positive
from syntenia.sources import aligners, sinks, tables

ROWS = [
    ("c2", "gene", 500, 900, "+", "ID=gb"),
    ("c1", "CDS", 160, 190, "+", "ID=k2;Parent=m1"),
    ("c1", "gene", 100, 200, "+", "ID=ga;Name=x"),
    ("c1", "mRNA", 100, 200, "+", "ID=m1;Parent=ga;rank=1"),
    ("c1", "CDS", 100, 140, "+", "ID=k1;Parent=m1"),
    ("c2", "mRNA", 500, 900, "+", "ID=m2;Parent=gb;rank=2"),
    ("c2", "CDS", 500, 600, "+", "ID=k3;Parent=m2"),
    ("c1", "CDS", 1, 9, "+", "ID=lost;Parent=nobody"),
]
GFF_IDX = "row_idx long, seqid string, source string, type string, start long, end long, score string, strand string, phase long, attributes string"


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame([(i, s, "t", k, a, b, None, x, None, t) for i, (s, k, a, b, x, t) in enumerate(ROWS)], GFF_IDX)


def test_resolution(raw):
    got = {r["ID"]: (r["mRNA"], r["gene"]) for r in features.resolved(raw).collect()}
    assert got["k1"] == ("m1", "ga") and got["m2"] == ("m2", "gb") and got["ga"] == (None, "ga") and got["lost"] == ("nobody", None)


def test_one_gene_takes_rows_without_gene(raw):
    got = {r["ID"]: r["gene"] for r in features.resolved(raw.where("seqid = 'c1'")).collect()}
    assert got["lost"] == "ga"


def test_attributes_are_unanchored(spark):
    r = spark.createDataFrame([("geneID=z;ID=x",), ("Name=q",), (None,)], "a string").select(at.first_value(F.col("a"), "ID").alias("x"), at.has_value(F.col("a"), "ID", "z").alias("y")).collect()
    assert [(x["x"], x["y"]) for x in r] == [("z", 1), (None, 0), (None, None)]


def test_hierarchical_order(raw):
    ids = [r["ID"] for r in features.hierarchical(features.resolved(raw)).collect()]
    assert ids == ["lost", "ga", "m1", "k1", "k2", "gb", "m2", "k3"]


def test_attribute_filters(raw):
    f = features.resolved(raw)
    assert {r["ID"] for r in features.kept_by_attribute(f, "rank", "1").collect()} == {"ga", "m1", "k1", "k2"}
    assert {r["ID"] for r in features.unresolved_by_attribute(f, "rank", "1").collect()} == {"gb", "m2", "k3"}


def test_gene_lists(spark, raw):
    f = features.resolved(raw)
    ids = spark.createDataFrame([("ga",), ("ga",)], "gene string")
    assert features.of_genes(f, ids).count() == 4
    assert features.without_genes(f, ids).count() == 4
    assert features.without_genes(f, ids.limit(0)).count() == 8


def test_introns_and_quantile(raw):
    got = {r["gene"]: r["longest_intron"] for r in features.longest_introns(features.resolved(raw)).collect()}
    assert got == {"ga": 19, "gb": 0}
    assert features.nearest_quantile(features.longest_introns(features.resolved(raw)), "longest_intron", 0.7).first()[0] == 19


def test_gff_round_trip(spark, raw, tmp_path):
    p = str(tmp_path / "a.gff")
    sinks.write_gff(raw.orderBy("row_idx").coalesce(1), p)
    back = tables.read_gff(spark, p)
    assert [tuple(r)[1:] for r in back.orderBy("row_idx").collect()] == [tuple(r)[1:] for r in raw.orderBy("row_idx").collect()]


def test_gff_reader_takes_comments_returns_and_more_columns(spark, tmp_path):
    (tmp_path / "b.gff").write_bytes(b"##gff\r\nc1\t.\tgene\t1\t9\t.\t+\t.\tID=x\textra\r\n\r\n# c\nc1\ts\tCDS\t2\t3\t.\t-\t0\tParent=x\n")
    got = tables.read_gff(spark, str(tmp_path / "b.gff")).collect()
    assert [(r["source"], r["start"], r["phase"], r["attributes"]) for r in got] == [(None, 1, None, "ID=x"), ("s", 2, 0, "Parent=x")]


def test_fasta_round_trip_and_chunks(spark, tmp_path):
    p = str(tmp_path / "a.fa")
    (tmp_path / "a.fa").write_text(">s1 first one\nACGT\nAC\n>s2\nTTTTT\n")
    got = tables.read_fasta(spark, p)
    assert [(r["seqid"], r["description"], r["seq"], r["len"]) for r in got.collect()] == [("s1", "first one", "ACGTAC", 6), ("s2", "", "TTTTT", 5)]
    sinks.write_fasta(got, str(tmp_path / "out"))
    assert sorted(r["seq"] for r in tables.read_fasta(spark, str(tmp_path / "out")).collect()) == ["ACGTAC", "TTTTT"]
    parts = {(r["seqid"], r["chunk_no"]): r["seq"] for r in tables.chunked(got, 4).collect()}
    assert parts == {("s1", 0): "ACGT", ("s1", 1): "AC", ("s2", 0): "TTTT", ("s2", 1): "T"}


def test_other_readers(spark, tmp_path):
    (tmp_path / "h.tsv").write_text("p\tc\t9\t3\t1\t3\t5\t13\t3\t99.5\t0\t1e-5\t50.1\t3\n")
    r = tables.read_hsps(spark, str(tmp_path / "h.tsv"), positive=True).first()
    assert (r["prot_id"], r["pident"], r["positive"]) == ("p", 99.5, 3)
    (tmp_path / "i.tsv").write_text("g\tRLK\tA\ng\tRLP\tB\n")
    assert tuple(tables.read_locus_info(spark, str(tmp_path / "i.tsv")).first()) == ("g", "RLP", "B")
    (tmp_path / "l").write_text("#x\ng1\n")
    assert [r["gene"] for r in tables.read_gene_list(spark, str(tmp_path / "l")).collect()] == ["g1"]
    (tmp_path / "e").write_text("1 5  2 6 9.5 4 3 5\n")
    assert tables.read_blast8(spark, str(tmp_path / "e")).first()["bitscore"] == 9.5


def test_options():
    assert tables.workflow_options({"PREFIX": "x", "PREBUILT": "", "OTHER": 1}) == Workflow(prefix="x", prebuilt="NULL")
    with pytest.raises(ValueError):
        positive(-1, "margin")


def test_aligner_rows(spark):
    rows = spark.createDataFrame([("t", "similarity", 1, 2, "+", "alignment_id 0 ; Query q ; Align 13 1 99 ; Align 200 34 30"), ("t", "similarity", 1, 2, "-", "Align 1 1 1"), ("t", "exon", 5, 9, "+", "")], "seqid string, type string, start long, end long, strand string, attributes string")
    assert sorted((r["start"], r["end"]) for r in aligners.similarity_rows(rows).collect()) == [(13, 111), (200, 229)]
    assert [(r["type"], r["start"]) for r in aligners.renamed_rows(rows, "exon").collect()] == [("CDS", 5)]


def test_reports(spark, tmp_path):
    (tmp_path / "r.txt").write_text("Length=8\n\n Score = 10\n\nQuery  2  MKV-LA  6\n          MK+ L \nSbjct  1  MKIGLC  6\n")
    r = aligners.read_reports(spark, str(tmp_path / "r.txt")).first()
    assert (r["length"], r["marks"]) == (8, [0, 2, 2, 1, 2, 0, 0, 0])


def test_tolerant_rows(spark):
    rows = spark.createDataFrame([(1, None), (2, "known: x")], "i int, error string")
    assert [r["i"] for r in aligners.tolerant(rows, "error", ["known"]).collect()] == [1]
    with pytest.raises(Exception, match="aligner"):
        aligners.tolerant(spark.createDataFrame([(1, "new")], "i int, error string"), "error", ["known"]).collect()


def test_renaming(raw):
    got = {r["type"] + str(r["start"]): r["attributes"] for r in cleaning.renamed(raw, "p").collect()}
    assert got["gene100"] == "ID=p_c1_0000000100;Name=x"
    assert got["CDS160"] == "ID=p_c1_0000000100_mrna_1_CDS_2;Parent=p_c1_0000000100_mrna_1"
    assert got["exon160"] == "ID=p_c1_0000000100_mrna_1_exon_2;Parent=p_c1_0000000100_mrna_1"
    assert "CDS1" not in got and [r["start"] for r in cleaning.orphans(raw).collect()] == [1]


def test_adjusting_is_numeric(spark):
    rows = [(0, "c", "t", "gene", 95, 99, None, "+", None, "ID=g"), (1, "c", "t", "mRNA", 95, 99, None, "+", None, "ID=m;Parent=g"), (2, "c", "t", "CDS", 90, 1000, None, "+", None, "ID=k;Parent=m")]
    got = cleaning.renamed(spark.createDataFrame(rows, GFF_IDX), adjust=True).where("type = 'gene'").first()
    assert (got["start"], got["end"]) == (90, 1000)


def test_merged_predictions(raw):
    every, placed = cleaning.merged_predictions([raw, raw.withColumn("seqid", F.lit("contig"))])
    assert every.count() == 2 * placed.count() > 0


def genes(spark, rows):
    return spark.createDataFrame([(g, "c", a, b, [{"start": s, "end": e} for s, e in cds]) for g, a, b, cds in rows], "gene string, seqid string, start long, end long, cds array<struct<start:bigint,end:bigint>>")


def test_evaluation(spark):
    ref = genes(spark, [("r1", 100, 200, [(100, 149), (151, 200)]), ("r2", 500, 599, [(500, 599)]), ("r3", 900, 950, [(900, 950)])])
    cand = genes(spark, [("a", 90, 149, [(100, 149)]), ("b", 480, 700, [(500, 549)]), ("d", 2000, 2100, [(2000, 2100)])])
    m = evaluation.best_matches(cand, ref)
    got = {r["candidate"]: (r["reference"], r["loci_overlap"], r["cds_overlap"]) for r in m.collect()}
    assert got == {"a": ("r1", 0.5, 0.5), "b": ("r2", 1.0, 0.5)}
    assert tuple(evaluation.evaluation(ref, m).first()) == (2, 2, 1)


def test_input_errors(spark, raw):
    fasta = spark.createDataFrame([("c1", "A")], "seqid string, seq string")
    info = spark.createDataFrame([("ga",)], "gene_id string")
    got = {tuple(r) for r in evaluation.input_errors(features.resolved(raw), fasta, info).collect()}
    assert got == {("fatal", "no exon rows"), ("fatal", "no sequence c2"), ("warning", "no locus information for gb")}


def test_best_method_ties_and_zeros(spark):
    rows = [("t", "b", 0.5, 2), ("t", "a", 0.5, 1), ("u", "a", 0.0, 1)]
    df = spark.createDataFrame(rows, "target string, method string, score double, method_rank int")
    assert [(r["target"], r["method"]) for r in prediction.best_method(df, "target").collect()] == [("t", "a")]


def test_regions(spark):
    rows = [("k", 1, 100, 1, 60, 100, 90.0, 100, 10.0), ("k", 150, 260, 50, 100, 100, 90.0, 110, 20.0), ("k", 9000, 9010, 1, 5, 100, 90.0, 10, 99.0)]
    h = spark.createDataFrame(rows, "k string, loc_startS long, loc_endS long, prot_start long, prot_end long, prot_len long, pident double, length long, bitscore double")
    runs = regions.concatenated_hits(h, ["k"])
    assert [(r["start"], r["end"]) for r in runs.collect()] == [(1, 260)]
    assert regions.best_of_regions(runs, ["k"]).count() == 1
    assert regions.without_nested(h, ["k"]).count() == 3


def test_sessions(spark):
    from syntenia.streaming.sessions import sessions

    rows = [(1, "2024-01-01 00:00:00"), (1, "2024-01-01 00:10:00"), (1, "2024-01-01 02:00:00"), (2, "2024-01-01 00:00:00")]
    df = spark.createDataFrame(rows, "user_id long, ts string")
    assert sorted((r["user_id"], r["n"]) for r in sessions(df).collect()) == [(1, 1), (1, 2), (2, 1)]
