"""Best matches and nearest intervals against loops, and that no pairs arise where a gene lies inside a candidate."""

import random

import pytest

from syntenia.operators import evaluation

GENES = "gene string, seqid string, start long, end long, cds array<struct<start:bigint,end:bigint>>"


def best_by_loop(candidates, genes):
    out = {}
    for c, seq, s, e, cds in candidates:
        mine = {p for a, b in cds for p in range(a, b + 1)}
        found = []
        for g, gseq, gs, ge, gcds in genes:
            theirs = {p for a, b in gcds for p in range(a, b + 1)}
            share = len([p for p in theirs if s <= p <= e]) / len(theirs)
            if seq == gseq and s <= ge and gs <= e and share > 0:
                found.append((-share, gs, g, len(theirs & mine) / len(theirs)))
        if found:
            less, _, g, inner = min(found)
            out[c] = (g, seq, -less, inner)
    return out


def test_best_matches_equal_a_loop(spark):
    rnd = random.Random(3)

    def rows(tag, n, most):
        for i in range(n):
            s = rnd.randint(1, 300)
            e = s + rnd.randint(0, most)
            a = rnd.choice([s, s, rnd.randint(s, e)])  # some begin behind their start
            m = rnd.randint(a, e)
            cds = [(a, m)] + ([(m + 2, e)] if m + 2 <= e and rnd.random() < 0.5 else [])
            yield f"{tag}{rnd.randint(0, 10**6)}_{i}", rnd.choice("AB"), s, e, cds

    candidates, genes = list(rows("c", 400, 60)), list(rows("g", 250, 40))
    genes += [(f"copy{i}", *g[1:]) for i, g in enumerate(genes[:60])]  # equal ones: the first by name wins
    got = evaluation.best_matches(spark.createDataFrame(candidates, GENES), spark.createDataFrame(genes, GENES), 16).collect()
    assert {r["candidate"]: tuple(r)[1:] for r in got} == best_by_loop(candidates, genes)
    assert len(got) == len({r["candidate"] for r in got})


def test_best_matches_form_no_pairs_around_inner_genes(spark, monkeypatch):
    """300 candidates around 300 genes were 90,000 pairs."""
    pairs, join = [], evaluation.overlap_join

    def counted(*args, **more):
        out = join(*args, **more)
        pairs.append(out.count())
        return out

    monkeypatch.setattr(evaluation, "overlap_join", counted)
    rows = lambda tag, s, e: spark.createDataFrame([(f"{tag}{i}", "A", s, e, [(s, e)]) for i in range(300)], GENES)
    got = evaluation.best_matches(rows("c", 10, 90), rows("g", 20, 40), 128).collect()
    assert {r["reference"] for r in got} == {"g0"} and len(got) == 300
    assert sum(pairs) == 0


def test_evaluation_reads_the_matches_once(spark):
    """The matches were worked out twice, once for the hits and once for the missed genes."""
    seen = spark.sparkContext.accumulator(0)

    def noted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    matches = spark.createDataFrame([("a", "g1", 0.5), ("b", "g1", 0.1), ("c", "g2", 0.05), ("d", "g3", 1.0)], "candidate string, reference string, loci_overlap double")
    genes = spark.createDataFrame([("g1",), ("g2",), ("g3",), ("g4",), (None,)], "gene string")
    got = evaluation.evaluation(genes, matches.mapInArrow(noted, matches.schema)).collect()
    assert [tuple(r) for r in got] == [(3, 2, 3)]
    assert seen.value == 4
    assert [tuple(r) for r in evaluation.evaluation(genes.limit(0), matches.limit(0)).collect()] == [(0, 0, 0)]


@pytest.mark.parametrize("stretch", [None, 50])
def test_nearest_ties_equal_a_loop(spark, stretch):
    from syntenia.operators.intervals import nearest_ties

    rnd = random.Random(4)
    side = lambda n, names: [(i, rnd.choice(names), s, s + rnd.randint(0, 9)) for i, s in enumerate(rnd.choices(range(1000), k=n))]
    a, b = side(300, "ABC"), side(120, "AB") + [(999, "A", 7, 7), (998, "A", 7, 7)]
    want = {}
    for i, seq, s, e in a:
        apart = [max(0, s - u, t - e) for _, other, t, u in b if other == seq]
        if apart:
            want[i] = (min(apart), apart.count(min(apart)))
    left, right = spark.createDataFrame(a, "id long, seqid string, s long, e long"), spark.createDataFrame(b, "ref long, seqid string, t long, u long")
    got = nearest_ties(left, right, ["seqid"], ("s", "e"), ("t", "u"), "id", stretch).collect()
    assert {r["id"]: (r["distance"], r["ties"]) for r in got} == want and len(got) == len(want)


@pytest.mark.parametrize("stretch", [None, 50])
def test_nearest_ties_work_on_positions(spark, monkeypatch, stretch):
    """Every left row went through the windows, and a frame up to the end took the square of a stretch's rows."""
    from syntenia.operators import intervals

    seen, running = [], intervals.running

    def counted(rows, *args):
        seen.append(rows.count())
        return running(rows, *args)

    monkeypatch.setattr(intervals, "running", counted)
    left = spark.range(4000).selectExpr("id", "'A' as seqid", "id % 10 * 20 as s", "cast(id % 10 * 20 + 3 as int) as e")
    right = spark.createDataFrame([(i, "A", 20 * i + 10 * (i % 2), 20 * i + 10 * (i % 2) + 2) for i in range(9) for _ in range(1 + i % 3)], "ref long, seqid string, t long, u long")
    near = intervals.nearest_ties(left, right, ["seqid"], ("s", "e"), ("t", "u"), "id", stretch)
    got = near.collect()
    spans = [(r["t"], r["u"]) for r in right.collect()]
    for r in got:
        s = r["id"] % 10 * 20
        apart = [max(0, s - u, t - s - 3) for t, u in spans]
        assert (r["distance"], r["ties"]) == (min(apart), apart.count(min(apart)))
    assert sorted(r["id"] for r in got) == list(range(4000))
    assert all(n <= 19 for n in seen) and len(seen) == (2 if stretch else 0)
    assert "unboundedfollowing" not in near._jdf.queryExecution().toString().lower()


def test_best_of_regions_in_stretches(spark):
    """A region over several stretches has one best run; missing scores come last, NaN first, as when sorted."""
    from syntenia.operators import regions

    rnd = random.Random(5)
    score = lambda: rnd.choice([None, float("nan"), *[float(rnd.randint(1, 30))] * 8])
    rows = [(rnd.choice("AB"), s, s + rnd.randint(0, 40), score()) for s in rnd.choices(range(3000), k=400)]
    runs = spark.createDataFrame(rows, "k string, start long, end long, bitscore double")
    want = []
    for k in "AB":
        part, top = [], None
        for r in sorted((r for r in rows if r[0] == k), key=lambda r: r[1:3]):
            if top is not None and r[1] > top:
                want.append(part)
                part, top = [], None
            part.append(r)
            top = r[2] if top is None else max(top, r[2])
        want.append(part)
    rank = lambda r: (r[3] is None, r[3] == r[3], -(r[3] or 0) if r[3] == r[3] else 0, r[1], r[2])
    want = sorted(repr(min(part, key=rank)) for part in want)
    got = regions.best_of_regions(runs, ["k"], stretch=64)
    assert got.columns == runs.columns and sorted(repr(tuple(r)) for r in got.collect()) == want
