"""Drafts to gene models, verification, workflow, writers."""

import random

import pytest
from pyspark.sql import functions as F

from syntenia import options
from syntenia.functions import intervals as iv
from syntenia.operators import evaluation, prediction, validation
from syntenia.plans import gene_models, workflow
from syntenia.sources import sinks, tables

GENOME = "CC" + "ATGAAA" + "GT" + "C" * 30 + "AG" + "TTTTAG" + "CC" + "ATGTAAGGGTGA" + "CCC"
FASTA = "seqid string, seq string"
SPAN = "array<struct<start:bigint,end:bigint>>"


@pytest.fixture(scope="module")
def fasta(spark):
    return spark.createDataFrame([("c", GENOME)], FASTA)


def test_drafts_are_lifted_and_cleaned(spark):
    targets = spark.createDataFrame([("c_1_101", "c", "+"), ("c_2_500", "c", "-")], "target string, seqid string, strand string")
    rows = [("c_1_101", "m", 1, 30), ("c_1_101", "m", 1, 30), ("c_1_101", "m", 5, 20), ("c_1_101", "m", 31, 60), ("c_1_101", "m", 200, 202), ("c_1_101", "m", 300, 330), ("c_2_500", "m", 10, 40), ("lost", "m", 1, 9)]
    got = prediction.draft_models(spark.createDataFrame(rows, "target string, method string, start long, end long"), targets)
    assert sorted((r["target"], r["start"], r["end"]) for r in got.collect()) == [("c_1_101", 101, 160), ("c_1_101", 400, 430), ("c_2_500", 461, 491)]
    hits = spark.createDataFrame([("c_1_101", 1, 10, 1, 30), ("c_1_101", 30, 40, 90, 120), ("c_1_101", 50, 60, 20, 50)], "target string, qstart long, qend long, sstart long, send long")
    assert sorted((r["start"], r["end"]) for r in prediction.hit_models(hits, targets).collect()) == [(101, 130), (190, 220)]


def test_overlaps_are_parted_by_codons(spark):
    rnd = random.Random(3)
    for _ in range(5):
        spans = sorted((a, a + rnd.randint(3, 40)) for a in rnd.sample(range(1, 120), 6))
        want, end = [], 0
        for a, b in spans:
            start = a + -(-max(0, end - a + 1) // 3) * 3 if end else a
            if start <= b:
                want.append((start, b))
            end = max(end, b)
        one = spark.createDataFrame([([{"start": a, "end": b} for a, b in spans],)], f"cds {SPAN}")
        assert [tuple(x) for x in one.select(validation.parted(F.col("cds"))).first()[0]] == want


def test_merging_is_given_up_where_a_stop_comes(spark, fasta):
    kind = f"gene string, seqid string, strand string, cds {SPAN}"
    row = lambda *s: ("g", "c", "+", [{"start": a, "end": b} for a, b in s])
    apart, joined = spark.createDataFrame([row((51, 53), (57, 59))], kind), spark.createDataFrame([row((51, 59))], kind)
    assert validation.stops_in_frame(joined, fasta).first()["stops"] == 1
    assert [tuple(x) for x in validation.merged_where_no_stop_comes(apart, joined, fasta).first()["cds"]] == [(51, 53), (57, 59)]
    assert [tuple(x) for x in validation.merged_where_no_stop_comes(joined, apart, fasta).first()["cds"]] == [(51, 53), (57, 59)]


def test_best_models_and_the_second_round(spark, fasta):
    cds = [("t", "mapping", "c", "+", 6, 8), ("t", "mapping", "c", "+", 43, 48), ("t", "prot2genome", "c", "+", 3, 8), ("t", "prot2genome", "c", "+", 43, 48)]
    drafts = spark.createDataFrame(cds, "target string, method string, seqid string, strand string, start long, end long")

    def scores(models):
        n = F.when(F.col("method") == "mapping", 2.0).otherwise(3.0)
        return models.select("gene", "target", "method", n.alias("n_identical"), n.alias("n_positive"), F.lit(4.0).alias("template_len"), F.lit(4.0).alias("own_len"))

    for guard in (False, True):
        best = gene_models.best_models(drafts, fasta, scores, guard).first()
        assert (best["target"], best["method"], best["validity"], best["penalty"]) == ("t", "prot2genome", "Valid", 0)
    equal = gene_models.best_models(drafts, fasta, lambda m: scores(m).withColumn("n_positive", F.lit(1.0))).first()
    assert equal["method"] == "mapping"  # the earlier method wins

    first = spark.createDataFrame([("t", "q1", 1), ("u", "q2", 1)], "target string, query string, n int")
    templates = spark.createDataFrame([("t", "q1"), ("u", "q9")], "target string, template string")
    asked = []

    def again(pairs):
        asked.extend(tuple(r) for r in pairs.collect())
        return pairs.select("target", F.col("template").alias("query"), F.lit(2).alias("n"))

    got = gene_models.two_rounds(first, templates, again).orderBy("target").collect()
    assert asked == [("u", "q9")] and [tuple(r) for r in got] == [("t", "q1", 1), ("u", "q9", 2)]


def test_verified_models_carry_alerts_and_comments(spark, fasta):
    rows = [("a", "c", "+", [{"start": 3, "end": 8}, {"start": 43, "end": 48}], "o", "m", 0.5, 0.75), ("b", "c", "+", [{"start": 6, "end": 8}], "o", "m", 1.0, 1.0)]
    models = spark.createDataFrame(rows, f"gene string, seqid string, strand string, cds {SPAN}, origin string, method string, ident double, cov double")
    info = spark.createDataFrame([("a", "RLK", "x")], "gene_id string, family string, class string")
    a, b = validation.verified(models, fasta, info).orderBy("prot_id").collect()
    assert (a["validity"], a["tags"], a["color"], a["family"]) == ("Valid", "", 3, "LRR-RLK")
    assert a["comment"] == "Origin:o / pred:m / prot-%-ident:0.50 / prot-%-cov:0.75"
    assert (b["color"], b["tags"], b["family"], b["penalty"]) == (10, "no_start,no_stop", None, 4)


def test_gathered_methods(spark, tmp_path):
    models = spark.createDataFrame([("g", "c", "m", "+", [{"start": 10, "end": 20}, {"start": 40, "end": 60}])], f"gene string, seqid string, source string, strand string, cds {SPAN}")
    rows = sinks.feature_rows(models).withColumn("row_idx", F.col("rank").cast("long"))
    assert [(r["type"], r["start"], r["end"]) for r in rows.orderBy("rank").collect()] == [("gene", 10, 60), ("mRNA", 10, 60), ("exon", 10, 20), ("exon", 40, 60), ("CDS", 10, 20), ("CDS", 40, 60)]
    other = rows.withColumn("seqid", F.lit("contig")).withColumn("attributes", F.regexp_replace("attributes", "=g", "=h"))
    out = workflow.gathered({"first": rows.drop("gene", "rank"), "second": other.drop("gene", "rank")}, options.Workflow(prefix="P"))
    assert out["features"].count() == 12 and out["placed"].count() == 6
    assert {(r["kind"], r["name"], r["n"]) for r in out["counts"].collect()} == {("total", "", 1), ("method", "first", 1), ("sequence", "c", 1)}
    assert "ID=P_c_0000000010" in [r["attributes"] for r in out["placed"].collect()]
    path = str(tmp_path / "sorted")
    sinks.write_sorted_gff(rows, path)
    assert sorted(r["value"].split("\t")[5] for r in spark.read.text(path).collect()) == ["."] * 6
    assert {r["value"] for r in evaluation.count_lines(out["placed"]).collect()} == {"total\tall\t1", "method\tfirst\t1", "sequence\tc\t1"}


def test_listing_and_writers(spark, tmp_path):
    genes = spark.createDataFrame([("r1", "c"), ("r2", "c")], "gene string, seqid string")
    matches = spark.createDataFrame([("k1", "r1", "c", 0.5, 0.25), ("k2", "r2", "c", 0.01, 0.0)], "candidate string, reference string, seqid string, loci_overlap double, cds_overlap double")
    got = {tuple(r) for r in evaluation.evaluation_listing(genes, matches).collect()}
    assert got == {("c", "match", "k1", "r1", "0.500", "0.250"), ("c", "missed", None, "r2", None, None)}
    flags = spark.createDataFrame([("a", True), ("b", False)], "id string, fs boolean")
    sinks.write_tsv(flags, str(tmp_path / "tsv"))
    assert sorted(r["value"] for r in spark.read.text(str(tmp_path / "tsv")).distinct().collect()) == ["a\tTrue", "b\tFalse", "id\tfs"]
    records = spark.createDataFrame([("x;1 y", "ACG"), ("z::2", "T")], FASTA)
    sinks.write_fasta_by_record(records, str(tmp_path / "records"))
    assert {r["record"] for r in spark.read.text(str(tmp_path / "records")).select("record").distinct().collect()} == {"x", "z"}
    sinks.write_fasta(records.limit(0), str(tmp_path / "none"))
    assert spark.read.text(str(tmp_path / "none")).count() == 0


def test_repeated_sequence_ids_fail(spark):
    one = spark.createDataFrame([("a", "AC"), ("b", "G")], FASTA)
    assert tables.unique_ids(one).count() == 2
    with pytest.raises(Exception, match="repeated sequence id a"):
        tables.unique_ids(one.union(one.limit(1))).collect()


def test_pairs_index_and_run_log(spark, tmp_path):
    (tmp_path / "f.fa").write_text(">a one\nACGT\nAC\n>b\nGG\n")
    index = tables.fasta_index(tables.read_fasta(spark, str(tmp_path / "f.fa")))
    assert {tuple(r) for r in index.collect()} == {("a", 6), ("b", 2)}
    lines = options.run_log(options.Workflow(prefix="P"), "abc", "today")
    assert lines[:2] == ["date\ttoday", "version\tabc"] and "prefix\tP" in lines


def test_older_interval_measures(spark):
    path = F.array(*[F.struct(F.lit(a).alias("start"), F.lit(b).alias("end")) for a, b in ((1, 10), (6, 20))])
    r = spark.range(1).select(iv.overlap_of_ends(F.lit(1), F.lit(10), F.lit(6), F.lit(20)), iv.possible_coverage(path, F.lit(5), F.lit(40)), iv.possible_coverage(F.slice(path, 1, 1), F.lit(5), F.lit(40))).first()
    assert tuple(r) == (4, 0.5, 0.125)
