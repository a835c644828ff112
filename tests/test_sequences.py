import pytest
from pyspark.sql import functions as F

from syntenia.functions import coordinates
from syntenia.functions import sequences as sq
from syntenia.operators import extraction, features, prediction, proteins, validation

GFF_IDX = "row_idx long, seqid string, source string, type string, start long, end long, score string, strand string, phase long, attributes string"


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_reverse_complement_is_its_own_inverse(spark):
    s = F.lit("ACGTNRYKMBVDHacgtn")
    assert one(spark, sq.reverse_complement(F.lit("AACGTN"))) == "NACGTT"
    assert one(spark, sq.reverse_complement(sq.reverse_complement(s))) == "ACGTNRYKMBVDHacgtn"


@pytest.mark.parametrize(("seq", "want"), [("ATGGCCTAA", "MA*"), ("ATGNNNTA", "MX"), ("", ""), ("AT", ""), ("ATG!!!TAG", "MX*")])
def test_translate(spark, seq, want):
    assert one(spark, sq.translate(F.lit(seq))) == want


def test_translate_to_stop(spark):
    assert one(spark, sq.translate_to_stop(F.lit("ATGTAAGCC"))) == "M*"


def test_codon_searches(spark):
    s = F.lit("CCATGAAATTTTAGCC")
    assert one(spark, sq.is_start(s, F.lit(3), F.lit("+")))
    assert one(spark, sq.is_stop(s, F.lit(14), F.lit("+")))
    assert one(spark, sq.find_stop(s, F.lit(8), F.lit("+"))) == 14
    assert one(spark, sq.find_start(s, F.lit(9), F.lit("+"))) == 3
    assert one(spark, sq.find_stop(s, F.lit(14), F.lit("+"))) is None
    r = sq.reverse_complement(s)
    assert one(spark, sq.is_start(r, F.lit(14), F.lit("-")))
    assert one(spark, sq.find_stop(r, F.lit(9), F.lit("-"))) == 3


def test_splice_sites(spark):
    s = F.lit("AAAGTCCCCCAGAAA")
    assert one(spark, sq.canonical_intron(s, F.lit(3), F.lit(13), F.lit("+")))
    assert tuple(one(spark, sq.splice_shift(s, F.lit(4), F.lit(14), F.lit("+")))) == (-1, -1)
    assert one(spark, sq.canonical_intron(sq.reverse_complement(s), F.lit(3), F.lit(13), F.lit("-")))


def test_lift_round_trip(spark):
    for strand in "+-":
        there = coordinates.lifted(F.lit(120), F.lit(150), F.lit(200), F.lit(strand))
        back = coordinates.lifted(there["start"], there["end"], F.lit(200), F.lit(strand), back=True)
        assert tuple(one(spark, back)) == (120, 150)


def test_genomic_position(spark):
    cds = F.array(*[F.struct(F.lit(a).alias("start"), F.lit(b).alias("end")) for a, b in ((101, 130), (201, 230))])
    assert one(spark, coordinates.genomic_position(cds, F.lit(5), F.lit(1))) == 116
    assert one(spark, coordinates.genomic_position(cds, F.lit(12), F.lit(1))) == 207
    assert one(spark, coordinates.genomic_position(cds, F.lit(12), F.lit(-1))) == 124
    assert one(spark, coordinates.genomic_position(cds, F.lit(99), F.lit(1))) is None


def test_smoothing(spark):
    marks = lambda *x: F.array(*[F.lit(v) for v in x])
    assert one(spark, sq.smoothed(marks(2, 2, 2, 0, 2, 0, 0))) == [2, 2, 2, 3, 3, 0, 0]
    assert one(spark, sq.smoothed(marks(0, 0, 1, 0, 0))) == [0] * 5


GENOME = "CC" + "ATGAAA" + "GT" + "C" * 30 + "AG" + "TTTTAG" + "CC"


def model(spark, pieces, strand="+", seq=GENOME):
    genes = spark.createDataFrame([("g", "c", strand, [{"start": a, "end": b} for a, b in pieces])], "gene string, seqid string, strand string, cds array<struct<start:bigint,end:bigint>>")
    return genes, spark.createDataFrame([("c", seq)], "seqid string, seq string")


def test_valid_model(spark):
    r = validation.alerts(*model(spark, [(3, 8), (43, 48)])).first()
    assert r["validity"] == "Valid", r


@pytest.mark.parametrize(
    ("pieces", "flag"),
    [([(6, 8), (43, 48)], "no_start"), ([(3, 8), (43, 45)], "no_stop"), ([(3, 9), (43, 48)], "splice"), ([(3, 9), (43, 48)], "length_pb"), ([(3, 8), (12, 48)], "fs")],
)
def test_alerts(spark, pieces, flag):
    r = validation.alerts(*model(spark, pieces)).first()
    assert r[flag] and r["validity"] == "NotValid"
    p = validation.penalty(validation.alerts(*model(spark, pieces))).first()
    assert p["penalty"] == 2 * sum(p[f] for f in validation.FLAGS)


@pytest.mark.parametrize("pieces", [[(6, 8), (43, 45)], [(3, 8), (43, 45)], [(3, 8), (43, 48)]])
def test_correction_makes_the_model_valid(spark, pieces):
    genes, fasta = model(spark, pieces)
    fixed = validation.corrected(genes, fasta)
    assert [tuple(x) for x in fixed.first()["cds"]] == [(3, 8), (43, 48)]
    assert validation.alerts(fixed.drop("corrections"), fasta).first()["validity"] == "Valid"


def gff(spark, rows):
    return features.resolved(spark.createDataFrame([(i, "c", "t", k, s, e, None, strand, None, a) for i, (k, s, e, strand, a) in enumerate(rows)], GFF_IDX))


def test_extraction(spark):
    f = gff(spark, [("gene", 3, 48, "+", "ID=g"), ("mRNA", 3, 48, "+", "ID=m;Parent=g"), ("exon", 3, 8, "+", "Parent=m"), ("exon", 43, 48, "+", "Parent=m"), ("CDS", 3, 8, "+", "Parent=m"), ("CDS", 43, 48, "+", "Parent=m")])
    fasta = spark.createDataFrame([("c", GENOME)], "seqid string, seq string")
    assert extraction.coding_sequences(f, fasta).first()["seq"] == "ATGAAATTTTAG"
    assert extraction.coding_sequences(f, fasta, protein=True).first()["seq"] == "MKF*"
    assert extraction.gene_sequences(f.where("type = 'gene'"), fasta, 100).first()["seq"] == GENOME
    assert {r["seq"] for r in extraction.cds_sequences(f, fasta).collect()} == {"ATGAAA", "TTTTAG"}
    near = gff(spark, [("gene", 3, 14, "+", "ID=g"), ("mRNA", 3, 14, "+", "ID=m;Parent=g"), ("CDS", 3, 8, "+", "Parent=m"), ("CDS", 12, 14, "+", "Parent=m")])
    assert extraction.frameshift_sequences(near, fasta).first()["seq"] == "ATGAAA!!!CCC"
    assert extraction.frameshift_sequences(near, fasta, protein=True).first()["seq"] == "MKXP"
    assert extraction.reference_library(f, fasta).count() == 4
    assert extraction.coding_sequences(f.limit(0), fasta).count() == 0


def cds(spark, pairs):
    return spark.createDataFrame([("g", a, b) for a, b in pairs], "g string, start long, end long")


def spans(df):
    return sorted((r["start"], r["end"]) for r in df.collect())


def test_cleaning_of_drafts(spark):
    assert spans(prediction.glued(cds(spark, [(1, 10), (11, 20), (3, 5), (40, 50)]), ["g"])) == [(1, 20), (40, 50)]
    assert spans(prediction.merged_in_frame(cds(spark, [(1, 9), (13, 20), (22, 30)]), ["g"])) == [(1, 20), (22, 30)]
    assert spans(prediction.short_introns_closed(cds(spark, [(1, 9), (13, 20), (22, 30), (90, 99)]), ["g"])) == [(1, 20), (22, 30), (90, 99)]
    assert spans(prediction.predicted_alterations(cds(spark, [(1, 10), (15, 20), (18, 30)]), ["g"])) == [(11, 14), (18, 20)]
    assert spans(prediction.predicted_exons(cds(spark, [(1, 10), (30, 40), (90, 99)]), ["g"])) == [(1, 40), (90, 99)]
    assert spans(prediction.overlaps_fixed(cds(spark, [(1, 10), (8, 20)]), ["g"])) == [(1, 10), (11, 20)]


def test_consistent_hits(spark):
    rows = [("q", 1, 50, 100, 250), ("q", 30, 60, 90, 180), ("q", 45, 90, 245, 380)]
    h = spark.createDataFrame(rows, "g string, qstart long, qend long, sstart long, send long")
    assert {r["qstart"] for r in prediction.consistent_hits(h, ["g"]).collect()} == {1, 45}


def test_colinear_chain(spark):
    rows = [("q", 1, 50, 1, 50, 90.0, 40, 30, 50), ("q", 40, 80, 10, 60, 50.0, 9, 9, 9), ("q", 60, 90, 70, 99, 40.0, 20, 10, 30)]
    h = spark.createDataFrame(rows, "g string, qstart long, qend long, sstart long, send long, bitscore double, positive long, nident long, length long")
    r = proteins.colinear_chain(h, ["g"]).first()
    assert (r["n"], r["bitscore"], r["positive"]) == (2, 130.0, 60)
