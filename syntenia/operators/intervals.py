"""Interval algebra on tables: unions, boolean sweeps, coverage, overlap and nearest joins.

Where a window runs along all rows of a key, ``stretch`` deals them out by stretches of
so many positions with carries between them (``stretches.running``): the same rows, and
one key that holds most of the table is many tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from syntenia.functions import intervals as iv
from syntenia.operators.alignments import islands
from syntenia.operators.stretches import Before, Behind, Beside, UpTo, running


def merged(rows: DataFrame, keys: Sequence[str], start: str = "start", end: str = "end", touch: int = 1, stretch: int | None = None) -> DataFrame:
    """Disjoint intervals of each key; gaps of up to ``touch`` between positions close."""
    found = islands(rows.where(F.col(start).isNotNull() & F.col(end).isNotNull()), keys, start, end, F.lit(touch), stretch=stretch)
    return found.groupBy(*keys, "island").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("island")


def combined(a: DataFrame, b: DataFrame, keys: Sequence[str], keep: Callable[[Column, Column], Column], start: str = "start", end: str = "end", stretch: int | None = None) -> DataFrame:
    """Half-open stretches of each key where ``keep(in a, in b)`` holds, from a sweep over both sides' ends.

    An empty side covers nothing.
    """

    def events(side: DataFrame, in_a: int, in_b: int) -> DataFrame:
        at = lambda c, sign: F.struct(F.col(c).cast("long").alias("at"), F.lit(in_a * sign).alias("a"), F.lit(in_b * sign).alias("b"))
        return side.where(F.col(start) < F.col(end)).select(*keys, F.explode(F.array(at(start, 1), at(end, -1))).alias("e")).select(*keys, "e.*")

    both = events(a, 1, 0).unionByName(events(b, 0, 1)).groupBy(*keys, "at").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    if stretch is None:
        order = Window.partitionBy(*keys).orderBy("at")
        upto = order.rowsBetween(Window.unboundedPreceding, 0)
        both = both.select(*keys, "at", F.sum("a").over(upto).alias("in_a"), F.sum("b").over(upto).alias("in_b"), F.lead("at").over(order).alias("next"))
    else:
        both = running(both, keys, "at", ["at"], {"in_a": UpTo("sum", F.col("a")), "in_b": UpTo("sum", F.col("b")), "next": Beside(F.col("at"), 1)}, stretch)
    swept = both.select(*keys, "at", keep(F.col("in_a") > 0, F.col("in_b") > 0).alias("on"), "next")
    found = islands(swept.where("on and next is not null"), keys, "at", "next", F.lit(0), stretch=stretch)
    return found.groupBy(*keys, "island").agg(F.min("at").alias(start), F.max("next").alias(end)).drop("island")


def union(a: DataFrame, b: DataFrame, keys: Sequence[str], stretch: int | None = None) -> DataFrame:
    return combined(a, b, keys, lambda x, y: x | y, stretch=stretch)


def intersection(a: DataFrame, b: DataFrame, keys: Sequence[str], stretch: int | None = None) -> DataFrame:
    return combined(a, b, keys, lambda x, y: x & y, stretch=stretch)


def difference(a: DataFrame, b: DataFrame, keys: Sequence[str], stretch: int | None = None) -> DataFrame:
    return combined(a, b, keys, lambda x, y: x & ~y, stretch=stretch)


def symmetric_difference(a: DataFrame, b: DataFrame, keys: Sequence[str], stretch: int | None = None) -> DataFrame:
    return combined(a, b, keys, lambda x, y: x != y, stretch=stretch)


def coverage_at_ends(rows: DataFrame, keys: Sequence[str], start: str = "start", end: str = "end", stretch: int | None = None) -> DataFrame:
    """(keys, at, covered): covered positions up to each end of closed intervals."""
    flat = merged(rows, keys, start, end, stretch=stretch)
    size = F.col(end) - F.col(start) + 1
    if stretch is None:
        sofar = Window.partitionBy(*keys).orderBy(start).rowsBetween(Window.unboundedPreceding, -1)
        flat = flat.withColumn("base", F.coalesce(F.sum(size).over(sofar), F.lit(0)))
    else:
        flat = running(flat, keys, start, [start], {"base": Before("sum", size)}, stretch)
    ends = rows.select(*keys, F.explode(F.array(F.col(start).cast("long"), F.col(end).cast("long"))).alias("at")).distinct()
    # every end lies in the merged interval with the last start that isn't beyond it
    both = flat.select(*keys, F.col(start).cast("long").alias("at"), F.lit(0).alias("kind"), F.col(start).cast("long").alias("s"), "base").unionByName(ends.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    if stretch is None:
        order = Window.partitionBy(*keys).orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, 0)
        filled = both.select(*keys, "at", "kind", F.last("s", True).over(order).alias("s"), F.last("base", True).over(order).alias("base"))
    else:
        filled = running(both.withColumnsRenamed({"s": "s0", "base": "base0"}), keys, "at", ["at", "kind"], {"s": UpTo("last", F.col("s0")), "base": UpTo("last", F.col("base0"))}, stretch)
    return filled.where("kind = 1").select(*keys, "at", (F.col("base") + F.col("at") - F.col("s") + 1).cast("long").alias("covered"))


#: Bins of one level are so many times as wide as those of the level below; the top level's are wider than any sequence.
NEST, LEVELS = 16, 9


def _level(start: str, end: str, width: int) -> Column:
    """The lowest level whose bins are no shorter than an interval, which then lies in one of them or two."""
    size = F.col(end) - F.col(start) + 1
    return F.array_position(F.transform(F.array(*[F.lit(width * NEST**k) for k in range(LEVELS - 1)]), lambda w: w >= size), F.lit(True))


def _binned(rows: DataFrame, start: str, end: str, width: int, other_levels: DataFrame, first: bool, salt: int) -> DataFrame:
    """One row for each bin in which an interval is looked for.

    A pair meets on the level of its longer interval, which is filed there only (role 1 if
    the first side's is the longer or equal, else 2); the shorter one is filed on its own
    level and on those above it that the other side has. Levels count from 1; the top one is 0.
    """
    level = _level(start, end, width)
    level = F.when(level == 0, F.lit(LEVELS)).otherwise(level).cast("int")
    at = rows.where(F.col(start) <= F.col(end)).withColumn("__own", level).crossJoin(F.broadcast(other_levels))  # one row
    above = F.filter("__levels", lambda x: x > F.col("__own"))
    other = F.array_min("__levels"), F.array_contains("__levels", F.col("__own"))
    own, up = (1, 2) if first else (2, 1)
    # filed as the longer one only if the other side has shorter ones (for the first side: or equal ones)
    longer = other[0] <= F.col("__own") if first else other[0] < F.col("__own")
    place = lambda role, when: F.when(when, F.struct(F.col("__own").alias("level"), F.lit(role).alias("role")))
    places = [place(own, longer)]
    shorter = F.transform(above, lambda x: F.struct(x.alias("level"), F.lit(up).alias("role")))
    if not first:  # of equal levels the first side counts as the longer
        places.append(place(up, other[1]))
    at = at.withColumn("__place", F.explode(F.array_compact(F.concat(F.array(*places), shorter)))).drop("__own", "__levels")
    wide = F.element_at(F.array(*[F.lit(width * NEST**k) for k in range(LEVELS)]), F.col("__place.level"))
    at = at.withColumn("__wide", wide).withColumn("__bin", F.explode(F.sequence(F.floor(F.col(start) / F.col("__wide")), F.floor(F.col(end) / F.col("__wide")))))
    at = at.withColumns({"__level": F.col("__place.level"), "__role": F.col("__place.role")}).drop("__place")
    if salt > 1:
        salts = F.explode(F.sequence(F.lit(0), F.lit(salt - 1))) if not first else F.pmod(F.xxhash64(start, end, F.monotonically_increasing_id()), F.lit(salt)).cast("int")
        at = at.withColumn("__salt", salts)
    return at


def overlap_join(a: DataFrame, b: DataFrame, keys: Sequence[str], a_span: tuple[str, str], b_span: tuple[str, str], width: int, how: str = "inner", salt: int = 1) -> DataFrame:
    """Pairs of closed intervals that share a position.

    Intervals are filed in nested bins: ``width`` positions on the lowest level, ``NEST``
    times as many on each further one. An interval is filed on the level of its own length, in two
    bins at most, and in one or two of each higher level that the other side has, so long and
    short intervals together cost a few rows each. A pair is kept in the bin where its
    overlap begins, so no duplicates arise. ``salt`` deals the left rows of every bin to so
    many tasks, for places where very many intervals lie. ``how``: inner, or left_semi
    and left_anti on the left side. Key columns of both sides have the same names; other
    columns must differ. A row without a start or an end overlaps nothing.
    """
    levels = lambda rows, s, e: rows.where(F.col(s) <= F.col(e)).agg(F.collect_set(F.when(_level(s, e, width) == 0, F.lit(LEVELS)).otherwise(_level(s, e, width)).cast("int")).alias("__levels"))
    meet = (F.col(a_span[0]) <= F.col(b_span[1])) & (F.col(b_span[0]) <= F.col(a_span[1]))
    place = [*keys, "__level", "__role", "__bin", *(["__salt"] if salt > 1 else [])]
    left = a if how == "inner" else a.withColumn("__id", F.monotonically_increasing_id())
    x = _binned(left, *a_span, width, levels(b, *b_span), True, salt)
    y = _binned(b, *b_span, width, levels(a, *a_span), False, salt).drop("__wide")
    both = x.join(y, place).where(meet)
    if how == "inner":
        first = F.floor(F.greatest(F.col(a_span[0]), F.col(b_span[0])) / F.col("__wide")) == F.col("__bin")
        return both.where(first).drop(*place[len(keys) :], "__wide")
    return left.join(both.select("__id").distinct(), "__id", how).drop("__id")


def nearest_join(a: DataFrame, b: DataFrame, keys: Sequence[str], a_span: tuple[str, str], b_span: tuple[str, str], a_id: str, stretch: int | None = None) -> DataFrame:
    """Each left row with the right rows at the least distance (0: overlapping); all ties.

    Of the right intervals that begin at or before the left one's end, the nearest
    has the largest end; of the others, the smallest start. Both are carried along
    by windows over the union of the two sides; rows at that distance are then
    found by an equi-join on the end or the start.
    """
    s, e = a_span
    t, u = b_span
    left = a.select(*keys, F.col(e).alias("__at"), F.lit(1).alias("__kind"), F.col(a_id).alias("__id"), F.col(s).alias("__s"), F.col(e).alias("__e"))
    right = b.select(*keys, F.col(t).alias("__at"), F.lit(0).alias("__kind"), F.col(t).alias("__t"), F.col(u).alias("__u"))
    both = left.unionByName(right, allowMissingColumns=True)
    if stretch is None:
        order = Window.partitionBy(*keys).orderBy("__at", "__kind")
        both = both.withColumn("__end", F.max("__u").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        # the rows behind are the rows before in the reverse order, whose minimum runs along
        back = Window.partitionBy(*keys).orderBy(F.col("__at").desc(), F.col("__kind").desc()).rowsBetween(Window.unboundedPreceding, -1)
        both = both.withColumn("__start", F.min("__t").over(back))
    else:
        both = running(both, keys, "__at", ["__at", "__kind"], {"__end": UpTo("max", F.col("__u")), "__start": Behind("min", F.col("__t"))}, stretch)
    both = both.where("__kind = 1")
    gap_before = F.when(F.col("__end").isNotNull(), F.greatest(F.lit(0), F.col("__s") - F.col("__end")))
    gap_after = F.col("__start") - F.col("__e")
    near = both.select(*keys, "__id", "__s", "__e", F.least(gap_before, gap_after).alias("distance")).where("distance is not null")
    r = b.withColumn("__t", F.col(t)).withColumn("__u", F.col(u))
    apart = near.where("distance > 0")
    by_end = apart.withColumn("__u", F.col("__s") - F.col("distance")).join(r.drop("__t"), [*keys, "__u"]).drop("__u")
    by_start = apart.withColumn("__t", F.col("__e") + F.col("distance")).join(r.drop("__u"), [*keys, "__t"]).drop("__t")
    touching = overlap_join(near.where("distance = 0"), b, keys, ("__s", "__e"), b_span, width=4096)
    out = by_end.unionByName(by_start).unionByName(touching.select(*by_end.columns))
    return out.withColumnRenamed("__id", a_id).drop("__s", "__e")


def nearest_ties(a: DataFrame, b: DataFrame, keys: Sequence[str], a_span: tuple[str, str], b_span: tuple[str, str], a_id: str, stretch: int | None = None) -> DataFrame:
    """(id, distance, ties): how many right rows are nearest to each left row, as ``nearest_join`` finds them, without forming pairs.

    Right rows that overlap a left one are those that begin up to its end, less those that end
    before its start: running counts over both sides' positions. Of others, the counts of the furthest end
    before and of the first start behind are carried along. Each position of either side counts once, however
    many rows have it; left rows then look up what stands at their start and end. ``a_id`` is unique.
    """
    s, e = a_span
    t, u = b_span
    left = a.where((F.col(s) <= F.col(e)) & F.col(a_id).isNotNull()).dropna(subset=list(keys))
    left = left.select(*keys, F.col(a_id).alias("__id"), F.col(s).cast("long").alias("__s"), F.col(e).cast("long").alias("__e"))
    right = b.where(F.col(t) <= F.col(u))
    # right starts and ends with their numbers; a start counts up to a left end at it, an end only before a left start
    at = lambda c: F.col(c).cast("long").alias("__at")
    starts = right.groupBy(*keys, at(t)).agg(F.count("*").alias("__n")).withColumns({"__kind": F.lit(0), "__row": F.struct(F.col("__at").alias("at"), F.col("__n").alias("n"))})
    ends = right.groupBy(*keys, at(u)).agg(F.count("*").alias("__n")).withColumns({"__kind": F.lit(1), "__row": F.struct(F.col("__at").alias("at"), F.col("__n").alias("n"))})
    ask = lambda c, kind: left.select(*keys, at(c)).distinct().withColumn("__kind", F.lit(kind))
    begun = starts.unionByName(ask("__e", 1), allowMissingColumns=True)
    ended = ends.unionByName(ask("__s", 0), allowMissingColumns=True)
    order, n = ["__at", "__kind"], F.coalesce(F.col("__n"), F.lit(0))
    if stretch is None:
        line = Window.partitionBy(*keys).orderBy(*order)
        upto = line.rowsBetween(Window.unboundedPreceding, 0)
        rest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order]).rowsBetween(Window.unboundedPreceding, -1)
        begun = begun.withColumns({"__upto": F.sum(n).over(upto), "__near": F.min("__row").over(rest)})
        ended = ended.withColumns({"__upto": F.sum(n).over(upto), "__near": F.max("__row").over(upto)})
    else:
        begun = running(begun, keys, "__at", order, {"__upto": UpTo("sum", n), "__near": Behind("min", F.col("__row"))}, stretch)
        ended = running(ended, keys, "__at", order, {"__upto": UpTo("sum", n), "__near": UpTo("max", F.col("__row"))}, stretch)
    asked = lambda df, c, tag: df.where("__n is null").select(*keys, F.col("__at").alias(c), F.col("__upto").alias(f"__upto{tag}"), F.col("__near").alias(f"__near{tag}"))
    both = left.join(asked(begun, "__e", 1), [*keys, "__e"]).join(asked(ended, "__s", 2), [*keys, "__s"])
    both = both.withColumns({"met": F.col("__upto1") - F.col("__upto2"), "d1": F.col("__near1.at") - F.col("__e"), "d2": F.col("__s") - F.col("__near2.at")}).withColumn("d", F.least("d1", "d2"))
    part = lambda d, n: F.when(F.col(d) == F.col("d"), F.col(n)).otherwise(F.lit(0))
    out = both.where("met > 0 or d is not null").withColumn("ties", F.when(F.col("met") > 0, F.col("met")).otherwise(part("d1", "__near1.n") + part("d2", "__near2.n")))
    return out.select(F.col("__id").alias(a_id), F.when(F.col("met") > 0, F.lit(0)).otherwise(F.col("d")).cast("long").alias("distance"), F.col("ties").cast("long").alias("ties"))


def without_contained(rows: DataFrame, keys: Sequence[str], start: str = "start", end: str = "end", ties: Sequence[str] = (), stretch: int | None = None) -> DataFrame:
    """Drops intervals that end no later than one before them (by start, longest first)."""
    if stretch is None:
        order = Window.partitionBy(*keys).orderBy(F.col(start), F.col(end).desc(), *ties).rowsBetween(Window.unboundedPreceding, -1)
        topped = rows.withColumn("__top", F.max(end).over(order))
    else:
        topped = running(rows, keys, start, [start, -F.col(end), *ties], {"__top": Before("max", F.col(end))}, stretch)
    return topped.where(F.col("__top").isNull() | (F.col(end) > F.col("__top"))).drop("__top")


def covered_length(rows: DataFrame, keys: Sequence[str], start: str = "start", end: str = "end") -> DataFrame:
    """Positions that the closed intervals of each key cover."""
    return merged(rows, keys, start, end).groupBy(*keys).agg(F.sum(iv.length(F.col(start), F.col(end))).alias("covered"))
