import random

import pytest
from pyspark.sql import functions as F

from syntenia.functions import intervals as iv
from syntenia.operators import intervals as ops


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def path(*pairs):
    return F.array(*[F.struct(F.lit(a).cast("long").alias("start"), F.lit(b).cast("long").alias("end")) for a, b in pairs])


def test_coverage_up_to_ends(spark):
    p = path((10, 20), (30, 40), (50, 60))
    assert [one(spark, iv.covered_up_to(p, F.lit(x))) for x in (10, 20, 30, 60)] == [1, 11, 12, 33]


@pytest.mark.parametrize(
    ("pairs", "start", "end", "want"),
    [
        ([(10, 20), (30, 40)], 10, 40, 22),
        ([(10, 25), (20, 30)], 10, 30, 21),
        ([(10, 20), (21, 30)], 10, 30, 21),
        ([(10, 20)], 20, 10, 0),
    ],
)
def test_coverage_between(spark, pairs, start, end, want):
    assert one(spark, iv.coverage_between(path(*pairs), F.lit(start), F.lit(end))) == want


def test_scalar_functions(spark):
    a = [F.lit(x) for x in (10, 20, 15, 40)]
    assert one(spark, iv.overlap(*a)) == 6
    assert one(spark, iv.distance(F.lit(10), F.lit(20), F.lit(21), F.lit(30))) == 1
    assert one(spark, iv.distance(*a)) == 0
    assert tuple(one(spark, iv.bounds(F.lit(9), F.lit(3)))) == (3, 9)


def test_merged_and_union_length(spark):
    p = path((50, 60), (10, 20), (15, 30), (31, 33))
    assert [tuple(x) for x in one(spark, iv.merged(p))] == [(10, 33), (50, 60)]
    assert one(spark, iv.union_length(p)) == 24 + 11


def rows(spark, data, names):
    return spark.createDataFrame(data, names)


def positions(pairs, k):
    return {x for key, a, b in pairs if key == k for x in range(a, b)}


@pytest.mark.parametrize("name", ["union", "intersection", "difference", "symmetric_difference"])
def test_boolean_sweeps(spark, name):
    rnd = random.Random(3)
    make = lambda: [(rnd.choice("ab"), s, s + rnd.randint(1, 12)) for s in (rnd.randint(0, 80) for _ in range(15))]
    a, b = make(), make()
    names = "k string, start long, end long"
    got = [tuple(r) for r in getattr(ops, name)(rows(spark, a, names), rows(spark, b, names), ["k"]).collect()]
    op = {"union": set.__or__, "intersection": set.__and__, "difference": set.__sub__, "symmetric_difference": set.__xor__}[name]
    for k in "ab":
        assert positions(got, k) == op(positions(a, k), positions(b, k))
    starts = sorted((k, s) for k, s, _ in got)
    assert len(starts) == len(set(starts))


def test_sweep_with_an_empty_side(spark):
    names = "k string, start long, end long"
    a, none = rows(spark, [("a", 1, 5)], names), rows(spark, [], names)
    assert ops.union(a, none, ["k"]).count() == 1
    assert ops.intersection(a, none, ["k"]).count() == 0


def test_overlap_and_nearest_joins(spark):
    rnd = random.Random(4)
    a = [(i, rnd.choice("xy"), s, s + rnd.randint(0, 9)) for i, s in enumerate(rnd.randint(1, 300) for _ in range(60))]
    b = [(i, rnd.choice("xy"), s, s + rnd.randint(0, 9)) for i, s in enumerate(rnd.randint(1, 300) for _ in range(60))]
    x, y = rows(spark, a, "i long, k string, s long, e long"), rows(spark, b, "j long, k string, t long, u long")
    got = {(r["i"], r["j"]) for r in ops.overlap_join(x, y, ["k"], ("s", "e"), ("t", "u"), 7).collect()}
    assert got == {(p[0], q[0]) for p in a for q in b if p[1] == q[1] and p[2] <= q[3] and q[2] <= p[3]}
    gap = lambda p, q: max(0, p[2] - q[3], q[2] - p[3])
    want = set()
    for p in a:
        mine = [q for q in b if q[1] == p[1]]
        best = min(gap(p, q) for q in mine)
        want |= {(p[0], q[0], best) for q in mine if gap(p, q) == best}
    near = ops.nearest_join(x, y, ["k"], ("s", "e"), ("t", "u"), "i")
    assert {(r["i"], r["j"], r["distance"]) for r in near.collect()} == want


def test_coverage_at_ends(spark):
    r = rows(spark, [("a", 10, 25), ("a", 20, 30), ("a", 40, 41)], "k string, start long, end long")
    got = {x["at"]: x["covered"] for x in ops.coverage_at_ends(r, ["k"]).collect()}
    assert got == {10: 1, 20: 11, 25: 16, 30: 21, 40: 22, 41: 23}
