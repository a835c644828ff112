import itertools
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from syntenia.operators import alignments, chaining, features, loci
from syntenia.operators.chaining import SKIP, _coverage, _Hits, best_chain, pair_costs
from syntenia.options import Clustering, Expansion, LocusOptions, Scoring
from syntenia.plans.candidate_loci import find_candidate_loci
from syntenia.schema import HSP


def hits(rnd, n):
    rows = []
    for _ in range(n):
        s, p, size = rnd.randint(1, 400), rnd.randint(1, 120), rnd.randint(3, 30)
        rows.append((s, s + 3 * size - 1, p, p + size - 1, s, s + 3 * size - 1, rnd.randint(1, size)))
    return pd.DataFrame(rows, columns=["loc_startS", "loc_endS", "prot_start", "prot_end", "loc_start", "loc_end", "nident"])


def chain_value(h, costs, upto, path):
    skipped = int(upto(h.s[path[0]]))
    n = int(h.n[path[0]])
    for a, b in zip(path, path[1:]):
        n += int(h.n[b])
        skipped += int(upto(h.s[b]) - upto(h.e[a]) + 1) if h.s[b] >= h.e[a] else 0
    n -= sum(int(costs[a, b]) for a, b in itertools.combinations(path, 2))
    return n - int(skipped / SKIP)


@pytest.mark.parametrize("seed", range(6))
def test_best_chain_is_compatible_and_no_single_is_better(seed):
    h = _Hits(hits(random.Random(seed), 9))
    costs, upto = pair_costs(h), _coverage(h.s, h.e)
    path = best_chain(h)
    assert all(costs[a, b] >= 0 for a, b in itertools.combinations(path, 2))
    value = chain_value(h, costs, upto, path)
    assert all(value >= int(h.n[i]) - int(upto(h.s[i]) / SKIP) for i in range(len(h)))
    # of two-member chains none is better either: the search sees them all
    assert all(value >= chain_value(h, costs, upto, [a, b]) for a, b in itertools.combinations(range(len(h)), 2) if costs[a, b] >= 0 and chain_value(h, costs, upto, [a, b]) > chain_value(h, costs, upto, [b]))


def test_coverage_function():
    upto = _coverage(np.array([10, 30, 50]), np.array([20, 40, 60]))
    assert [int(upto(np.int64(x))) for x in (5, 10, 20, 30, 60, 99)] == [0, 1, 11, 12, 33, 33]


def hsps(spark, rows):
    return spark.createDataFrame(rows, HSP)


def row(prot, chrom, ps, pe, ls, le, n, size=100):
    return (prot, chrom, size, pe - ps + 1, ps, pe, ls, le, n, 90.0, 0, 0.0, 50.0)


ANNOTATION = [
    ("c9", "t", "gene", 1000, 2000, None, "+", None, "ID=g1"),
    ("c9", "t", "mRNA", 1000, 2000, None, "+", None, "ID=m1;Parent=g1"),
    ("c9", "t", "CDS", 1000, 1149, None, "+", 0, "ID=x1;Parent=m1"),
    ("c9", "t", "CDS", 1850, 2000, None, "+", 0, "ID=x2;Parent=m1"),
]
GFF_IDX = "row_idx long, seqid string, source string, type string, start long, end long, score string, strand string, phase long, attributes string"


def annotation(spark):
    return features.resolved(spark.createDataFrame([(i, *r) for i, r in enumerate(ANNOTATION)], GFF_IDX))


def test_gene_info(spark):
    r = features.gene_info(annotation(spark)).first()
    assert (r["gene"], r["start"], r["end"], r["longest_intron"]) == ("g1", 1000, 2000, 700)


def test_two_strands_give_two_loci(spark):
    rows = [row("g1", "c1", 1, 50, 5000, 5149, 50), row("g1", "c1", 51, 100, 5850, 5999, 50), row("g1", "c1", 1, 50, 99999, 99850, 50), row("g1", "c1", 51, 100, 99149, 99000, 50)]
    found = find_candidate_loci(hsps(spark, rows), annotation(spark)).collect()
    assert sorted((r["strand"], r["chr_start"], r["chr_end"], r["nident"]) for r in found) == [(-1, 99000, 99999, 100), (1, 5000, 5999, 100)]


def test_default_expansion_adds_300(spark):
    rows = [row("g1", "c1", 1, 50, 5000, 5149, 50), row("g1", "c1", 51, 100, 5850, 5999, 50)]
    r = find_candidate_loci(hsps(spark, rows), annotation(spark), LocusOptions(expansion=Expansion())).first()
    assert (r["chr_start"], r["chr_end"]) == (4700, 6299)


def test_incomplete_side_gets_more_room(spark):
    rows = [row("g1", "c1", 30, 100, 5000, 5212, 70)]
    r = find_candidate_loci(hsps(spark, rows), annotation(spark), LocusOptions(scoring=Scoring(min_score=1, min_similarity=0.1), expansion=Expansion())).first()
    assert (r["chr_start"], r["chr_end"]) == (2000, 5512)


def test_island_gap_grows_with_the_intron(spark):
    h = alignments.oriented(hsps(spark, [row("g1", "c1", 1, 50, 1000, 1149, 50), row("g1", "c1", 51, 100, 7000, 7149, 50)]))
    genes = spark.createDataFrame([("g1", 6000)], "gene string, longest_intron long")
    n = lambda g: alignments.hsp_islands(h, g).agg(F.max("island")).first()[0]
    assert (n(None), n(genes)) == (2, 1)


def brute_select(rows, shrink):
    kept = []
    for r in sorted(rows, key=lambda r: (-r[4], r[5], r[6], r[1], r[2])):
        _, s, e = r[:3]
        clear = lambda a, b: all(b < x or a > y for x, y in kept)  # noqa: B023, E731
        if not clear(s, e) and e - s + 1 >= 10 * shrink and clear(s + shrink, e - shrink):
            if clear(s + shrink, e):
                s += shrink
            elif clear(s, e - shrink):
                e -= shrink
            elif e - s + 1 >= 20 * shrink:
                s, e = s + shrink, e - shrink
        if clear(s, e):
            kept.append((s, e))
    return sorted(kept)


def test_selection_by_components_equals_the_whole(spark):
    rnd = random.Random(9)
    rows = [("c", s, s + rnd.randint(20, 400), i, rnd.random(), rnd.choice([1, -1]), f"p{i}") for i, s in enumerate(rnd.randint(1, 20000) for _ in range(120))]
    df = spark.createDataFrame(rows, "chr_id string, chr_start long, chr_end long, i long, score double, strand int, prot_id string")
    got = sorted((r["chr_start"], r["chr_end"]) for r in loci.non_overlapping(df, shrink=10).collect())
    assert got == brute_select(rows, 10)


def test_neighbours_share_a_gap(spark):
    rows = [("c", 1000, 2000, 1, "a", 300, 300, False, False), ("c", 2101, 3000, 1, "b", 100, 300, False, False)]
    df = spark.createDataFrame(rows, "chr_id string, chr_start long, chr_end long, strand int, prot_id string, exp_left long, exp_right long, shrink_left boolean, shrink_right boolean")
    got = [(r["chr_start"], r["chr_end"]) for r in loci.expanded(df).orderBy("chr_start").collect()]
    assert got == [(700, 2075), (2076, 3300)]


def test_features_and_ids(spark):
    rows = [row("g1", "c1", 1, 50, 5000, 5149, 50), row("g1", "c1", 51, 100, 5850, 5999, 50)]
    found = find_candidate_loci(hsps(spark, rows), annotation(spark))
    got = loci.as_features(found).orderBy("rank").collect()
    assert [(r["type"], r["start"], r["end"]) for r in got] == [("gene", 5000, 5999), ("mRNA", 5000, 5999), ("CDS", 5000, 5149), ("CDS", 5850, 5999)]
    assert got[0]["attributes"].startswith("ID=c1_0000005000;")
    assert loci.pair_list(found).first().asDict() == {"target": "c1_0000005000", "query": "g1", "strand": "+"}


def test_empty_alignments(spark):
    assert find_candidate_loci(hsps(spark, []), annotation(spark), LocusOptions(expansion=Expansion())).count() == 0


def test_own_locus_is_left_out(spark):
    rows = [row("g1", "c9", 1, 50, 1000, 1149, 50), row("g1", "c9", 51, 100, 1850, 1999, 50)]
    opts = LocusOptions(clustering=Clustering(min_distance=10))
    assert find_candidate_loci(hsps(spark, rows), annotation(spark)).count() == 1
    assert find_candidate_loci(hsps(spark, rows), annotation(spark), opts).count() == 0


def test_chain_table_schema(spark):
    h = alignments.hsp_islands(alignments.oriented(hsps(spark, [row("g1", "c1", 1, 50, 1, 150, 50)])))
    r = chaining.chain_islands(h).first()
    assert (r["chr_start"], r["chr_end"], r["nhomol_loc"], r["nhomol_prot"]) == (1, 150, 150, 50)
