"""Forms that hold for one island, one place or one sequence that has most rows: equal to the plain forms."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from syntenia.operators import alignments, chaining, extraction, intervals, loci, stretches
from syntenia.options import Expansion
from syntenia.sources import tables


# ---- chaining ----------------------------------------------------------------


def island(rnd, n, span, protein, sloped):
    rows = []
    for _ in range(n):
        size, p = rnd.randint(3, 60), rnd.randint(1, protein)
        s = max(1, int(3 * p + rnd.gauss(0, span / 20))) if sloped else rnd.randint(1, span)
        e = s + max(3, 3 * size + rnd.choice([0, 0, 0, 3, -3, 30])) - 1
        rows.append((s, e, p, p + size - 1, s, e, rnd.randint(1, size)))
    return chaining._Hits(dict(zip(("loc_startS", "loc_endS", "prot_start", "prot_end", "loc_start", "loc_end", "nident"), np.array(rows).T)))


def plain_chain(h):
    """All predecessors, nearest first, with explicit paths."""
    upto = chaining._coverage(h.s, h.e)
    start, end, costs = upto(h.s), upto(h.e), chaining.pair_costs(h)
    best = []
    for j in range(len(h)):
        mine = (int(h.n[j]), int(start[j]), [j])
        for i in reversed(range(j)):
            n, skipped, path = best[i]
            if (costs[path, j] < 0).any():
                continue
            n, skipped = n + int(h.n[j] - costs[path, j].sum()), skipped + (int(start[j] - end[i] + 1) if h.s[j] >= h.e[i] else 0)
            if n - skipped // chaining.SKIP > mine[0] - mine[1] // chaining.SKIP:
                mine = (n, skipped, [*path, j])
        best.append(mine)
    values = [n - skipped // chaining.SKIP for n, skipped, _ in best]
    n, _, path = best[values.index(max(values))]
    return path, n


@pytest.mark.parametrize("sloped", [True, False])
def test_best_path_equals_the_plain_search(sloped):
    rnd = random.Random(7)
    for _ in range(250):
        h = island(rnd, rnd.randint(1, 45), rnd.choice([150, 900, 5000]), rnd.choice([50, 300]), sloped)
        assert chaining.best_path(h) == plain_chain(h)


def test_ten_thousand_alignments_in_one_island():
    rnd = random.Random(1)
    for h in (island(rnd, 10_000, 400_000, 80_000, True), island(rnd, 10_000, 3000, 1000, True)):
        began = time.process_time()
        path, n = chaining.best_path(h)
        assert time.process_time() - began < 40 and len(path) > 5 and n > 0


# ---- selection ---------------------------------------------------------------


def test_disjoint_intervals_answer_like_a_list():
    rnd = random.Random(3)
    kept, plain = loci.Disjoint(), []
    kept.RUN = 8
    for _ in range(4000):
        s = rnd.randint(0, 100_000)
        e = s + rnd.randint(0, 40)
        clear = all(e < a or s > b for a, b in plain)
        assert kept.clear(s, e) == clear
        if clear:
            kept.add(s, e)
            plain.append((s, e))
    assert len(kept.runs) > 20 and sorted(x for r in kept.runs for x in zip(*r)) == sorted(plain)


def test_selection_of_a_long_connected_stretch(spark):
    from test_loci import brute_select

    rnd = random.Random(11)
    rows = [("c", s, s + rnd.randint(20, 400), i, rnd.random(), rnd.choice([1, -1]), f"p{i}") for i, s in enumerate(rnd.randint(1, 9000) for _ in range(600))]
    rows += [("d", 10 * i, 10 * i + 5, i, None, 1, "q") for i in range(20)] + [("e", 1, 9, 0, 2.0, 1, "z"), ("e", 5, 9, 0, None, 1, "y")]
    df = spark.createDataFrame(rows, "chr_id string, chr_start long, chr_end long, i long, score double, strand int, prot_id string")
    for stretch in (None, 700):
        got = loci.non_overlapping(df, shrink=10, stretch=stretch)
        assert got.columns == [*df.columns, "shrink_left", "shrink_right"]
        got = got.collect()
        assert sorted((r["chr_start"], r["chr_end"]) for r in got if r["chr_id"] == "c") == brute_select([r for r in rows if r[0] == "c"], 10)
        assert sum(r["chr_id"] == "d" for r in got) == 20 and [r["prot_id"] for r in got if r["chr_id"] == "e"] == ["z"]
    assert loci.non_overlapping(df.limit(0)).count() == 0


# ---- windows along one sequence ----------------------------------------------


def test_running_carries_equal_windows_over_the_whole(spark):
    rnd = random.Random(5)
    rows = [(rnd.choice(["a", "a", "a", "b", None]), rnd.choice([None, *range(0, 400, 3)]), i, rnd.choice([None, 1, 5, 9, 40])) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, at long, i long, v long")
    w = Window.partitionBy("k").orderBy("at", "i")
    upto, past, rest = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(1, Window.unboundedFollowing)
    v = F.col("v")
    want = df.select("i", F.max(v).over(upto).alias("m"), F.min(v).over(past).alias("n"), F.coalesce(F.sum(v).over(past), F.lit(0)).alias("s"), F.last(v, True).over(upto).alias("l"), F.max(v).over(rest).alias("b"), F.lag(v).over(w).alias("p"), F.lead(v).over(w).alias("f"))
    what = {"m": stretches.UpTo("max", v), "n": stretches.Before("min", v), "s": stretches.Before("sum", v), "l": stretches.UpTo("last", v), "b": stretches.Behind("max", v), "p": stretches.Beside(v, -1), "f": stretches.Beside(v, 1)}
    for size in (7, 50, 10_000):
        got = stretches.running(df, ["k"], "at", ["at", "i"], what, size)
        assert got.columns == [*df.columns, *what]
        assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))


def spans(rnd, n, names=("k", "start", "end")):
    return [(rnd.choice("xy"), s, s + rnd.choice([0, 3, 20, 150])) for s in (rnd.randint(0, 900) for _ in range(n))]


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_interval_operators_in_stretches_give_the_same_rows(spark):
    rnd = random.Random(6)
    names = "k string, start long, end long"
    a, b = spark.createDataFrame(spans(rnd, 90), names), spark.createDataFrame(spans(rnd, 70), names)
    for f in (lambda s: intervals.merged(a, ["k"], stretch=s), lambda s: intervals.coverage_at_ends(a, ["k"], stretch=s), lambda s: intervals.without_contained(a.distinct(), ["k"], stretch=s), lambda s: intervals.union(a, b, ["k"], stretch=s), lambda s: intervals.symmetric_difference(a, b, ["k"], stretch=s), lambda s: intervals.intersection(a, b, ["k"], stretch=s)):
        assert rows_of(f(None)) == rows_of(f(64))
    x = a.withColumn("i", F.monotonically_increasing_id())
    y = b.select("k", F.col("start").alias("t"), F.col("end").alias("u"), F.monotonically_increasing_id().alias("j"))
    near = lambda s: intervals.nearest_join(x, y, ["k"], ("start", "end"), ("t", "u"), "i", stretch=s)
    assert rows_of(near(None)) == rows_of(near(64))


def test_one_sequence_is_many_tasks(spark):
    rnd = random.Random(2)
    df = spark.createDataFrame([("c", s, s + 5, i) for i, s in enumerate(rnd.randint(0, 100_000) for _ in range(2000))], "k string, s long, e long, i long")
    got = alignments.islands(df, ["k"], "s", "e", F.lit(20), ("i",), stretch=1000)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so few rows would be put together
    try:
        tasks = got.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(tasks) == 4 and max(r["count"] for r in tasks) < 1000
    assert rows_of(got) == rows_of(alignments.islands(df, ["k"], "s", "e", F.lit(20), ("i",)))


def test_expansion_in_stretches(spark):
    rnd = random.Random(8)
    rows, at = [], 0
    for i in range(150):
        at += rnd.randint(1, 500)
        rows.append((rnd.choice("ab"), at, at + rnd.randint(5, 90), 1, f"p{i}", rnd.choice([0, 100, 300]), rnd.choice([0, 100, 300]), rnd.random() < 0.2, rnd.random() < 0.2))
        at = rows[-1][2]
    df = spark.createDataFrame(rows, "chr_id string, chr_start long, chr_end long, strand int, prot_id string, exp_left long, exp_right long, shrink_left boolean, shrink_right boolean")
    whole = loci.expanded(df)
    part = loci.expanded(df, stretch=800)
    assert part.columns == whole.columns and rows_of(part) == rows_of(whole)


# ---- nested bins -------------------------------------------------------------


@pytest.mark.parametrize("salt", [1, 3])
def test_overlaps_of_very_long_and_very_short_intervals(spark, salt):
    rnd = random.Random(4)
    sizes = [0, 3, 90, 5000, 10**6, 10**8]
    make = lambda n: [(i, rnd.choice("xy"), s, s + rnd.choice(sizes)) for i, s in enumerate(rnd.choice([rnd.randint(-50, 3000), rnd.randint(0, 10**8)]) for _ in range(n))]
    a, b = make(120), make(120) + [(500, "x", 9, 3), (501, "y", None, 5)]
    x, y = spark.createDataFrame(a, "i long, k string, s long, e long"), spark.createDataFrame(b, "j long, k string, t long, u long")
    want = {(p[0], q[0]) for p in a for q in b if p[1] == q[1] and q[2] is not None and q[2] <= q[3] and p[2] <= q[3] and q[2] <= p[3]}
    got = intervals.overlap_join(x, y, ["k"], ("s", "e"), ("t", "u"), 100, salt=salt)
    assert got.columns == ["k", "i", "s", "e", "j", "t", "u"]
    pairs = [(r["i"], r["j"]) for r in got.collect()]
    assert set(pairs) == want and len(pairs) == len(want)
    semi = intervals.overlap_join(x, y, ["k"], ("s", "e"), ("t", "u"), 100, how="left_semi", salt=salt)
    anti = intervals.overlap_join(x, y, ["k"], ("s", "e"), ("t", "u"), 100, how="left_anti", salt=salt)
    assert {r["i"] for r in semi.collect()} == {i for i, _ in want} and semi.count() + anti.count() == len(a)


def test_an_interval_costs_a_few_rows_for_each_level(spark):
    rows = spark.createDataFrame([(0, 10**8), (5, 104), (7, 10_000)], "s long, e long")
    other = spark.createDataFrame([([1, 2, 3, 4, 5, 6],)], "__levels array<int>")
    for first in (True, False):
        filed = intervals._binned(rows, "s", "e", 100, other, first, 1)
        per = filed.groupBy("s", "__level", "__role").count()
        assert per.agg(F.max("count")).first()[0] <= 2


# ---- sequences ---------------------------------------------------------------


def test_fasta_chunks_by_ranges(spark, tmp_path):
    rnd = random.Random(9)
    seqs = {f"s{i}": "".join(rnd.choice("ACGTN") for _ in range(n)) for i, n in enumerate([0, 1, 64, 65, 3000, 7777])}
    text = "stray line\n" + "".join(f">{k} text > more\r\n" + "".join(v[i : i + w] + "\r\n" for i in range(0, len(v), w)) for k, v in seqs.items() for w in [rnd.choice([7, 60, 5000])])
    (tmp_path / "a.fa").write_text(text)
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        chunks = tables.read_fasta_chunks(spark, str(tmp_path / "a.fa"), 64)
        got = {(r["seqid"], r["chunk_no"]): r["seq"] for r in chunks.collect()}
        assert got == {(k, i): v[64 * i : 64 * i + 64] for k, v in seqs.items() for i in range(max(1, -(-len(v) // 64)))}
        assert {r["seqid"]: r["len"] for r in tables.fasta_index(chunks).collect()} == {k: len(v) for k, v in seqs.items()}
        wanted = [(f"s{k}", s, s + rnd.randint(0, 300)) for k in (3, 4, 5) for s in (rnd.randint(-5, 3000) for _ in range(20))]
        pieces = extraction.cut(spark.createDataFrame(wanted, "seqid string, start long, end long"), chunks, 64)
        assert all(r["piece"] == seqs[r["seqid"]][max(0, r["start"] - 1) : max(0, r["end"])] for r in pieces.collect()) and pieces.count() > 30
        (tmp_path / "b.fa").write_text(">x\nAC\n>y\nA\n>x\nG\n")
        with pytest.raises(Exception, match="repeated sequence id x"):
            tables.read_fasta_chunks(spark, str(tmp_path / "b.fa")).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_bad_alignment_files_fail_the_read(spark, tmp_path):
    good = "p\tc\t9\t3\t1\t3\t5\t13\t3\t99.5\t0\t1e-5\t50.1"
    (tmp_path / "good.tsv").write_text(f"# c\n{good}\r\n\n{good}\n")
    assert tables.read_hsps(spark, str(tmp_path / "good.tsv")).where("pident = 99.5 and bitscore = 50.1").count() == 2
    for name, line in (("number", good.replace("\t5\t", "\tfive\t")), ("short", good.rsplit("\t", 2)[0])):
        (tmp_path / f"{name}.tsv").write_text(f"{good}\n{line}\n")
        with pytest.raises(Exception, match="five|fewer than 13 columns"):
            tables.read_hsps(spark, str(tmp_path / f"{name}.tsv")).collect()
        assert tables.read_hsps(spark, str(tmp_path / f"{name}.tsv"), strict=False).count() == 2
    (tmp_path / "shards").mkdir()
    for i in range(3):
        (tmp_path / "shards" / f"{i}.tsv").write_text(good + "\n")
    assert tables.read_hsps(spark, str(tmp_path / "shards")).count() == 3


# ---- expansion ---------------------------------------------------------------

TEMPLATE = [("g", [(1000, 1299), (5000, 5599)], 3700)]  # 100 and 200 residues


def wishes(spark, start, end, strand=1, template=False, length=300):
    row = [("c", strand, "g", length, start, end, 90_000, 91_000)]
    df = spark.createDataFrame(row, "chr_id string, strand int, prot_id string, prot_len long, prot_start long, prot_end long, chr_start long, chr_end long")
    genes = spark.createDataFrame(TEMPLATE, "gene string, cds array<struct<start:long,end:long>>, longest_intron long") if template else None
    r = loci.wanted_expansion(df, Expansion(use_template=template), genes).first()
    return r["exp_left"], r["exp_right"]


@pytest.mark.parametrize(("start", "end", "want"), [(10, 300, (300, 300)), (11, 300, (3000, 300)), (12, 300, (3000, 300)), (1, 290, (300, 300)), (1, 289, (300, 3000))])
def test_missing_ends_at_the_edge(spark, start, end, want):
    assert wishes(spark, start, end) == want
    assert wishes(spark, start, end, strand=-1) == want[::-1]


def test_templates_give_the_room_that_the_missing_part_takes(spark):
    long_ = int(3700 * 1.1)
    # residue 120 + 6 is 3 * 126 - 300 = 78 into the second CDS
    assert wishes(spark, 120, 300, template=True) == (max(long_, int((5078 - 1000 + 1) * 1.1)), 300)
    # on the minus strand the first CDS is the right one: 3 * 126 = 378 into its 600
    assert wishes(spark, 120, 300, strand=-1, template=True) == (300, max(long_, int((5599 - (5599 - 378) + 1) * 1.1)))
    # residue 90 - 6 lies 252 into the first CDS, the end is 5599
    assert wishes(spark, 1, 90, template=True) == (300, int((5599 - 1252 + 1) * 1.1))
    assert wishes(spark, 1, 90, strand=-1, template=True) == (int((5599 - 252 - 1000 + 1) * 1.1), 300)
    # three residues are missing: less than the least, but more than nothing
    assert wishes(spark, 4, 300, template=True) == (300, 300)
    with pytest.raises(Exception, match="no genomic position of residue 426"):
        wishes(spark, 420, 430, template=True, length=430)


def test_selection_in_tiles_with_loci_longer_than_a_tile(spark):
    """One connected stretch of many loci, copies included, is chosen in many tasks, as a loop chooses."""
    from test_loci import brute_select

    rnd = random.Random(12)
    rows = []
    for i in range(1500):
        s, p = rnd.randint(1, 20_000), rnd.choice("pq")
        e = s + rnd.choice([20, 90, 400, 400, 3000])
        rows += [("c", s, e, i, rnd.random(), rnd.choice([1, -1]), p) for _ in range(rnd.randint(1, 3))]
    df = spark.createDataFrame(rows, "chr_id string, chr_start long, chr_end long, i long, score double, strand int, prot_id string")
    want = brute_select(rows, 10)
    for stretch in (64, 500, 2048, None):
        got = loci.non_overlapping(df, shrink=10, stretch=stretch)
        assert sorted((r["chr_start"], r["chr_end"]) for r in got.collect()) == want
    plan = loci.non_overlapping(df, shrink=10, stretch=500)._jdf.queryExecution().toString()
    assert "Window" not in plan  # no task holds a sequence's loci


def test_what_a_tile_leaves_open():
    spots = loci._Open()
    plain = set()
    rnd = random.Random(14)
    for _ in range(600):
        s = rnd.randint(0, 3000)
        e = s + rnd.randint(0, 30)
        assert spots.meets(s, e) == any(x in plain for x in range(s, e + 1))
        if rnd.random() < 0.3:
            spots.add(s, e)
            plain |= set(range(s, e + 1))
    assert all(a <= b for a, b in zip(spots.starts, spots.ends)) and all(b < a for a, b in zip(spots.starts[1:], spots.ends))


@pytest.mark.parametrize("sloped", [True, False])
def test_few_alignments_on_plain_numbers_chain_as_on_arrays(sloped):
    rnd = random.Random(15)
    for _ in range(400):
        h = island(rnd, rnd.randint(2, 30), rnd.choice([150, 900, 5000]), rnd.choice([50, 300]), sloped)
        few = list(zip(*(getattr(h, c).tolist() for c in "sepqabn")))
        assert chaining._path_of_few(few) == chaining.best_path(h)
        for shrink in (1, 60):
            assert chaining._chains_of_few(few, shrink) == chaining.chains_of(h, shrink)


def test_a_hundred_thousand_small_islands():
    rnd = random.Random(16)
    few = [list(zip(*(getattr(island(rnd, 3, 900, 300, True), c).tolist() for c in "sepqabn"))) for _ in range(200)]
    began = time.process_time()
    for _ in range(500):
        for h in few:
            chaining._chains_of_few(h, 60)
    assert time.process_time() - began < 12


def test_the_fewest_places_of_an_interval(spark):
    """Where all intervals are of one level, each is filed in one role."""
    rows = spark.createDataFrame([(5, 104), (7, 60)], "s long, e long")
    alike, longer = ([1],), ([2],)
    places = lambda other, first: sorted((r["__level"], r["__role"]) for r in intervals._binned(rows, "s", "e", 128, spark.createDataFrame([other], "__levels array<int>"), first, 1).select("__level", "__role", "s").distinct().collect())
    assert places(alike, True) == [(1, 1)] * 2 and places(alike, False) == [(1, 1)] * 2
    assert places(longer, True) == [(2, 2)] * 2 and places(longer, False) == [(2, 1)] * 2


def test_arrays_of_alignments_hold_short_stretches(spark):
    import syntenia.queries as q

    plan = q.queries()["grouped_hsps"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert f"/ {float(q.STRETCH)}" in plan


def test_mirrored_deals_one_sequence_to_many_shares(spark):
    rows = spark.createDataFrame([("p%d" % i, "c", i, i + 9) for i in range(300)], "prot_id string, chr_id string, loc_start long, loc_end long")
    got = alignments.mirrored(rows)
    assert got.columns == ["chr_id", "prot_id", "loc_start", "loc_end", "strand", "chrS_id", "loc_startS", "loc_endS"] and got.count() == 300
    assert "__deal" in got._jdf.queryExecution().optimizedPlan().toString()


def test_rows_without_nested_ones_need_no_grouping(spark):
    import syntenia.queries as q

    plan = q.queries()["without_nested"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan


def test_reference_library_cuts_its_pieces_once(spark):
    f = spark.createDataFrame([("g", "c", "-", "CDS", 1, 6), ("g", "c", "-", "CDS", 10, 15), ("h", "c", "+", "CDS", 4, 9), ("h", "c", "+", "exon", 4, 9)], "gene string, seqid string, strand string, type string, start long, end long")
    fasta = spark.createDataFrame([("c", "ACGTACGTACGTTTGACA")], "seqid string, seq string")
    got = extraction.reference_library(f, fasta)
    kind = lambda df, k: [(r["gene"], k, r["seq"]) for r in df.collect()]
    want = kind(extraction.frameshift_sequences(f, fasta, protein=True), "protein") + kind(extraction.frameshift_sequences(f, fasta, marks=False), "cdna") + [(r["id"], "cds", r["seq"]) for r in extraction.cds_sequences(f, fasta).collect()]
    assert sorted(map(tuple, got.collect())) == sorted(want) and "X" in str(want)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1
