"""Hits joined in two passes, protein hits merged, version order, exons beside CDS: against loops and sort -V."""

import os
import random
import subprocess

import pytest
from pyspark.sql import functions as F

import syntenia.queries as q
from syntenia.functions.ordering import natural_key
from syntenia.operators import features, regions

DIR = "/root/testdata/sf0.001"
tables = pytest.mark.skipif(not os.path.isdir(DIR), reason="no driver tables")


def two_passes(rows, introns):
    """A dictionary of hits by line, worked through in order, as a table script would."""

    def strand(h):
        return "+" if h["loc_start"] < h["loc_end"] else "-"

    def goes_on(h, run):
        if (h["prot_id"], h["chr_id"], strand(h)) != (run["prot_id"], run["chr_id"], strand(run)):
            return False
        widest = introns.get(h["prot_id"], 0)
        limit = widest + 500 if widest > 5000 else 5000
        near = h["loc_start"] - run["loc_end"] < limit or h["loc_end"] - run["loc_start"] < limit
        if strand(h) == "+":
            return near and h["prot_end"] > run["prot_end"] and run["prot_end"] < h["prot_start"] + 100
        return near and h["prot_start"] < run["prot_start"] and h["prot_end"] < run["prot_start"] + 100

    def join(hits):
        out, run, place = {}, None, None
        for line in sorted(hits):
            h = dict(hits[line])
            if run is None:
                run, place = h, line
            elif goes_on(h, run):
                ends = (min, max) if strand(h) == "+" else (max, min)
                for c in ("length", "nident", "gapopen", "bitscore"):
                    h[c] += run[c]
                h["prot_start"], h["prot_end"] = min(h["prot_start"], run["prot_start"]), max(h["prot_end"], run["prot_end"])
                h["loc_start"], h["loc_end"] = ends[0](h["loc_start"], run["loc_start"]), ends[1](h["loc_end"], run["loc_end"])
                h["pident"] = h["nident"] / h["length"] * 100
                run = h
            else:
                if (run["prot_end"] - run["prot_start"] + 1.0) / run["prot_len"] >= 0.6 and run["pident"] >= 50.0:
                    out[place] = run
                run, place = h, line
        if run is not None:
            out[place] = run
        return out

    hits = join({h["line"]: h for h in rows if 65 <= h["pident"] <= 100})
    hits |= {h["line"]: dict(h) for h in rows if 45 <= h["pident"] <= 65}
    last, kept = None, {}
    for line in sorted(hits):
        h = hits[line]
        same = last is not None and (h["prot_id"], h["chr_id"], strand(h)) == (last["prot_id"], last["chr_id"], strand(last))
        if not same or h["loc_start"] < h["loc_end"] and h["loc_end"] > last["loc_end"] or h["loc_start"] > h["loc_end"] and h["loc_start"] > last["loc_start"]:
            kept[line] = last = h
    return join(kept)


COLUMNS = ("prot_id", "chr_id", "prot_len", "length", "prot_start", "prot_end", "loc_start", "loc_end", "nident", "gapopen", "bitscore")


def as_set(lines):
    return sorted((line, *(h[c] for c in COLUMNS), round(h["pident"], 9)) for line, h in lines)


def test_two_passes_equal_the_loop(spark):
    rnd = random.Random(13)
    for n, introns in ((0, {}), (400, {"a": 9000, "b": 100}), (60, {})):
        rows = []
        for line in range(n):
            prot, plus, size = "abc"[3 * line // n], rnd.random() < 0.6, rnd.randint(5, 60)
            ps, at = rnd.randint(1, 90), rnd.randint(1, 9000)
            ends = (at, at + 3 * size) if plus else (at + 3 * size, at)
            rows.append((line + 1, prot, rnd.choice(["x", "x", "y"]), 120, size, ps, ps + size - 1, *ends, rnd.randint(1, size), float(rnd.choice([30, 45, 50, 60, 65, 65, 80, 99])), 1, 0.0, float(rnd.randint(1, 90))))
        names = [c for c in regions.HIT if c != "max_intron"]
        df = spark.createDataFrame(rows, regions._HIT_SCHEMA.rsplit(", ", 1)[0])
        table = spark.createDataFrame(list(introns.items()), "prot_id string, max_intron long")
        got = regions.two_pass_hits(df, table).collect()
        assert as_set((r["line"], r) for r in got) == as_set(two_passes([dict(zip(names, r)) for r in rows], introns).items())


@tables
def test_two_pass_query_equals_the_loop(spark, monkeypatch):
    seen = []
    plain = regions.two_pass_hits
    monkeypatch.setattr(regions, "two_pass_hits", lambda hits, introns: seen.append((hits, introns)) or plain(hits, introns))
    got = q.QUERIES["two_pass_hits"](spark, DIR).collect()
    hits, introns = seen[0]
    want = two_passes([r.asDict() for r in hits.select(*[c for c in regions.HIT if c != "max_intron"]).collect()], {r["prot_id"]: r["max_intron"] for r in introns.collect()})
    assert as_set((r["line"], r) for r in got) == as_set(want.items()) and len(want) > 100


def test_two_passes_stream_twice(spark):
    """Once for each pass, beside what ends the table; the run of its last line stays wherever its protein stands."""
    rnd = random.Random(17)
    for loose in (0, 1, 3):  # of four proteins, those up to which there are loose hits
        rows = []
        for line in range(120):
            k, ps = line // 30, rnd.randint(1, 60)
            rows.append((line + 1, f"p{k}", "x", 400, 20, ps, ps + 19, 10 * line, 10 * line + 60, 9, rnd.choice([50.0, 70.0]) if k < loose else 70.0, 1, 0.0, 1.0))
        df = spark.createDataFrame(rows, regions._HIT_SCHEMA.rsplit(", ", 1)[0])
        found = regions.two_pass_hits(df)
        names = [c for c in regions.HIT if c != "max_intron"]
        assert as_set((r["line"], r) for r in found.collect()) == as_set(two_passes([dict(zip(names, r)) for r in rows], {}).items())
    assert found._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 4


@tables
def test_carried_protein_hits_equal_a_loop(spark):
    rows = [r.asDict() for r in q.protein_hits(spark, DIR).collect()]
    rows.sort(key=lambda r: (int(r["qseqid"][1:]), r["sstart"], r["sseqid"], r["qstart"], r["qend"], r["send"], r["length"], r["nident"]))
    want, run, merged = [], None, 0
    for h in rows:
        if run is None or (h["qseqid"], h["sseqid"]) != (run["qseqid"], run["sseqid"]):
            want += [run] if run else []
            run = dict(h)
        elif h["sstart"] >= run["send"] - 30 and h["send"] > run["send"] and h["qstart"] > run["qstart"] and h["qstart"] > run["qend"] - 30:
            merged += 1
            n = h["nident"] + run["nident"]
            length = h["length"] + run["length"] - (run["send"] - h["sstart"])
            run |= {"length": length, "qend": h["qend"], "send": h["send"], "nident": n, "pident": n / length * 100}
    want.append(run)
    names = ("qseqid", "sseqid", "qlen", "length", "qstart", "qend", "sstart", "send", "nident")
    key = lambda r: (*(r[c] for c in names), r["pident"])
    got, want = sorted(map(key, q.QUERIES["carried_protein_hits"](spark, DIR).collect())), sorted(map(key, want))
    assert [g[:-1] for g in got] == [w[:-1] for w in want] and [g[-1] for g in got] == pytest.approx([w[-1] for w in want], abs=1e-6) and merged > 20


PROTEIN_HIT = "qseqid string, sseqid string, qlen long, length long, qstart long, qend long, sstart long, send long, nident long, pident double"


def runs_by_loop(rows, compat):
    """Runs of hits in order, each worked through hit by hit."""
    rows = sorted(set(rows), key=lambda r: (int(r[0][1:]), r[6], r[1] is not None, r[1] or "", r[4], r[5], r[7], r[3], r[8]))
    runs = []
    for r in rows:
        h = dict(zip(("qseqid", "sseqid", "qlen", "length", "qstart", "qend", "sstart", "send", "nident", "pident"), r))
        if runs and h["sseqid"] is not None and (runs[-1][0]["qseqid"], runs[-1][0]["sseqid"]) == (h["qseqid"], h["sseqid"]):
            runs[-1].append(h)
        else:
            runs.append([h])

    def goes_on(h, f):
        return h["sstart"] >= f["send"] - 30 and h["send"] > f["send"] and h["qstart"] > (0 if compat else f["qstart"]) and h["qstart"] > f["qend"] - 30

    def merged(h, f, more):
        n, length = h["nident"] + f["nident"], h["length"] + more - (f["send"] - h["sstart"])
        return f | {"length": length, "qend": h["qend"], "send": h["send"], "nident": n, "pident": n / length * 100}

    out = []
    for first, *others in runs:
        if compat:
            met = [h for h in others if goes_on(h, first)]
            first = merged(met[-1], first, rows[0][3]) if met else first
        else:
            for h in others:
                first = merged(h, first, first["length"]) if goes_on(h, first) else first
        out.append(tuple(first.values()))
    return out, runs


@pytest.mark.parametrize("compat", [True, False])
def test_protein_hits_in_runs_of_several_places_equal_a_loop(spark, compat):
    rnd = random.Random(29)
    for queries, subjects, starts in ((3, ["S1"], 60), (3, ["S1", "S2", "S2", None], 40), (12, ["S1", "S2"], 6)):
        rows = []
        for _ in range(400):
            n, q, s = rnd.randint(1, 50), rnd.choice([0, 0, rnd.randint(-5, 90)]), rnd.randint(1, starts)
            rows.append((f"Q{rnd.randint(1, queries)}", rnd.choice(subjects), 90, rnd.randint(500, 900), q, q + n, s, s + rnd.randint(1, 50), n, float(n)))
        want, runs = runs_by_loop(rows + rows[:9], compat)
        got = [tuple(r) for r in regions.merged_protein_hits(spark.createDataFrame(rows + rows[:9], PROTEIN_HIT), compat).collect()]
        place = lambda r: (*r[:2], *r[6:7], *r[2:6], *r[7:])
        text = lambda rows: sorted(repr((*place(r)[:-1], round(r[-1], 6))) for r in rows)
        assert text(got) == text(want) and sum(r[9] != r[8] for r in want) > 2
        assert starts < 10 or any(len({h["sstart"] for h in r}) > 1 for r in runs)


@pytest.mark.parametrize("compat", [True, False])
def test_protein_hits_are_gathered_before_they_are_dealt(spark, compat):
    """One query's hits neither meet in one task nor cross it one by one."""
    rows = spark.range(20_000).select(
        F.lit("Q1").alias("qseqid"), F.concat(F.lit("S"), F.col("id") % 3).alias("sseqid"), F.lit(90).cast("long").alias("qlen"), (F.col("id") % 977 + 500).alias("length"), (F.col("id") % 180).alias("qstart"),
        (F.col("id") % 180 + 9).alias("qend"), (F.col("id") % 7).alias("sstart"), (F.col("id") % 7 + F.col("id") % 11).alias("send"), (F.col("id") % 50).alias("nident"), F.lit(9.0).alias("pident"),
    )
    sc = spark.sparkContext

    def stages():
        found = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), None)
        return [(s.stageId(), s.shuffleReadRecords()) for s in map(found.apply, range(found.size()))]

    before = max((i for i, _ in stages()), default=-1)
    assert len(regions.merged_protein_hits(rows, compat).collect()) == 21
    assert 0 < max(n for i, n in stages() if i > before) < 2000


def test_version_order_is_that_of_sort(spark):
    rnd = random.Random(3)
    names = {"".join(rnd.choice(["chr", "c", "Chr", "_", "-", "0", "7", "10", "007", "123456789012", "a", "Z"]) for _ in range(rnd.randint(1, 6))) for _ in range(300)}
    names |= {"a~", "a", "a~b", "a1~", "a1"} | {f"scaffold{i}_{j}" for i in (1, 2, 10, 11, 100) for j in (0, 3, 20)}
    order = subprocess.run(["sort", "-V"], input="\n".join(names) + "\n", capture_output=True, text=True, env={**os.environ, "LC_ALL": "C"}, check=True).stdout.split("\n")[:-1]
    got = {r["name"]: r["key"] for r in spark.createDataFrame([(n,) for n in names], "name string").select("name", natural_key(F.col("name")).alias("key")).collect()}
    keys = [got[n] for n in order]
    assert keys == sorted(keys)


def test_features_in_natural_order(spark):
    rows = [("chr10", "gene", 5), ("chr2", "mRNA", 100), ("chr2", "gene", 100), ("chr2", "CDS", 20), ("chr2", "CDS", 100)]
    got = features.natural_order(spark.createDataFrame(rows, "seqid string, type string, start long")).collect()
    assert [tuple(r) for r in got] == [("chr2", "CDS", 20), ("chr2", "gene", 100), ("chr2", "CDS", 100), ("chr2", "mRNA", 100), ("chr10", "gene", 5)]


SPANS = "exons array<struct<start:long,end:long>>, cds array<struct<start:long,end:long>>"


@pytest.mark.parametrize(
    ("exons", "cds", "established", "intended"),
    [
        ([(1, 5), (9, 12)], [(1, 5), (9, 12)], True, True),
        ([(1, 5), (9, 12)], [(1, 5)], True, False),  # the marks of the first exon are carried on
        ([(1, 5), (9, 12)], [(9, 12), (1, 4)], False, False),
        ([(1, 5)], [(1, 9), (3, 5)], True, True),  # start and end may be of different CDS
        ([], [(1, 5)], False, False),
        ([(1, 5)], [], False, False),
        (None, [(1, 5)], False, False),
    ],
)
def test_exons_beside_cds(spark, exons, cds, established, intended):
    df = spark.createDataFrame([(exons, cds)], SPANS)
    e, c = F.col("exons"), F.col("cds")
    assert tuple(df.select(features.exons_match(e, c), features.exons_match(e, c, compat=False)).first()) == (established, intended)


def test_two_cds_become_one(spark):
    df = spark.createDataFrame([([], [(1, 5), (9, 12), (20, 30)])], SPANS)
    at = lambda i, j: [tuple(x) for x in df.select(features.joined_cds(F.col("cds"), F.lit(i), F.lit(j)).alias("x")).first()["x"]]
    assert at(1, 2) == [(1, 12), (20, 30)] and at(2, 3) == [(1, 5), (9, 30)] and at(1, 3) == [(1, 30), (9, 12)]


def test_exons_and_alterations_of_close_cds(spark):
    from syntenia.sources import sinks

    cds = [(1, 10), (30, 40), (39, 60), (90, 95), (125, 130)]
    df = spark.createDataFrame([([], cds), ([], []), ([], [(5, 9)])], SPANS)
    c = F.col("cds")
    got = df.select(sinks.exons_of(c), sinks.alterations_of(c)).collect()
    assert [[list(map(tuple, x)) for x in r] for r in got] == [[[(1, 60), (90, 95), (125, 130)], [(11, 29), (39, 40)]], [[], []], [[(5, 9)], []]]


def test_given_exons_beyond_the_predicted_ones_stay(spark):
    from syntenia.sources import sinks

    rows = [("g", "c", "s", "-", 1, 99, "ID=g;x=1", [(1, 10), (15, 20)], [(2, 20), (50, 60)]), ("h", "c", "s", "+", 1, 9, "ID=h", None, [(1, 9)])]
    df = spark.createDataFrame(rows, "gene string, seqid string, source string, strand string, start long, end long, attributes string, cds array<struct<start:long,end:long>>, exons array<struct<start:long,end:long>>")
    got = [(r["type"], r["start"], r["end"], r["attributes"].split(";")[0]) for r in sinks.formatted_rows(df).orderBy("gene", "rank").collect()]
    assert got == [
        ("gene", 1, 99, "ID=g"), ("mRNA", 1, 99, "ID=g_mrna"), ("exon", 1, 20, "ID=g:exon_2"), ("exon", 50, 60, "ID=g:exon_1"),
        ("CDS", 1, 10, "ID=g:cds_2"), ("CDS", 15, 20, "ID=g:cds_1"), ("sequence_alteration", 11, 14, "ID=g:frameshift_1"),
        ("gene", 1, 9, "ID=h"), ("mRNA", 1, 9, "ID=h_mrna"), ("exon", 1, 9, "ID=h:exon_1"),
    ]


def test_proteins_without_a_gene_fail_the_job(spark):
    hsps = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "prot_id string, n int")
    extents = spark.createDataFrame([("a", 5), ("b", 6), ("c", 7), ("d", 8)], "gene string, longest_gap int")
    assert sorted(tuple(r) for r in features.with_extents(hsps, extents).collect()) == [("a", 1, 5), ("b", 2, 6), ("c", 3, 7)]
    with pytest.raises(Exception, match="no gene for the proteins b, c"):
        features.with_extents(hsps, extents.where("gene = 'a'")).collect()


def test_run_log_is_written(spark, tmp_path):
    from syntenia.options import Workflow
    from syntenia.sources import sinks

    sinks.write_run_log(spark, Workflow(prefix="p"), "abc", "today", str(tmp_path / "log"))
    lines = [r["value"] for r in spark.read.text(str(tmp_path / "log")).collect()]
    assert lines[:2] == ["date\ttoday", "version\tabc"] and "prefix\tp" in lines
