"""Windows along one sequence that are not one task.

Rows of a key are dealt out by stretches of positions. What a window needs from other
stretches is a carry: a running maximum, sum or last value of whole stretches, or the
nearest row before or behind. Carries are worked out on one row for each stretch and
joined back; inside a stretch an ordinary window goes on from the carry.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

_TOTAL = {"max": F.max, "min": F.min, "sum": F.sum}


@dataclass(frozen=True)
class UpTo:
    """max, min, sum or last (the last value that isn't null) of the rows up to and with each."""

    how: str
    value: Column


@dataclass(frozen=True)
class Before(UpTo):
    """The same of the rows before each; null (or 0 for sums) before the first."""


@dataclass(frozen=True)
class Behind(UpTo):
    """max or min of the rows behind each."""


@dataclass(frozen=True)
class Beside:
    """A value of the row ``by`` places away: -1 before, 1 behind."""

    value: Column
    by: int


def running(rows: DataFrame, keys: Sequence[str], at: str, order: Sequence[str | Column], what: Mapping[str, UpTo | Beside], stretch: int) -> DataFrame:
    """``rows`` with a column for each of ``what``, along ``order`` within ``keys``; ``order`` begins with ``at``, ascending.

    Rows whose ``at`` is null come first, as in a window. Only as many rows as lie in one stretch meet in a task.
    ``rows`` is read twice, for the carries and for the result: give a written table where it is dear to compute,
    and write what comes out before the next such step.
    """
    # a struct of the order's columns compares as the window sorts; nulls are first in both
    rank = F.struct(*[F.col(c).alias(f"_{i}") if isinstance(c, str) else c.alias(f"_{i}") for i, c in enumerate(order)])
    names = list(what)
    cut = rows.withColumn("__st", F.floor(F.col(at) / stretch))
    for n, w in what.items():
        cut = cut.withColumn(f"__v_{n}", w.value)
    own = [f"__k{i}" for i in range(len(keys))]

    totals = []
    for n, w in what.items():
        v = F.col(f"__v_{n}")
        if isinstance(w, Beside):
            pick = F.max_by if w.by < 0 else F.min_by
            totals.append(pick(F.struct(v.alias("v")), rank).alias(f"__t_{n}"))
        elif w.how == "last":
            totals.append(F.max_by(v, F.when(v.isNotNull(), rank)).alias(f"__t_{n}"))
        else:
            totals.append(_TOTAL[w.how](v).alias(f"__t_{n}"))
    ends = cut.groupBy(*[F.col(k).alias(o) for k, o in zip(keys, own)], F.col("__st").alias("__stretch_of")).agg(*totals)
    line = Window.partitionBy(*own).orderBy("__stretch_of")
    past = line.rowsBetween(Window.unboundedPreceding, -1)
    # the rows behind are the rows before in the reverse order; a frame up to the end would be worked out anew for each row
    rest = Window.partitionBy(*own).orderBy(F.col("__stretch_of").desc()).rowsBetween(Window.unboundedPreceding, -1)
    carries = [_over(w, F.col(f"__t_{n}"), line, past, rest).alias(f"__c_{n}") for n, w in what.items()]
    carried = ends.select(*own, "__stretch_of", *carries)

    same = F.col("__st").eqNullSafe(F.col("__stretch_of"))
    for k, o in zip(keys, own):
        same &= F.col(k).eqNullSafe(F.col(o))
    joined = cut.join(carried, same, "left").drop(*own, "__stretch_of")

    here = Window.partitionBy(*keys, "__st").orderBy(*order)
    past = here.rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.partitionBy(*keys, "__st").orderBy(*[(F.col(c) if isinstance(c, str) else c).desc() for c in order]).rowsBetween(Window.unboundedPreceding, -1)
    upto = here.rowsBetween(Window.unboundedPreceding, 0)
    out = joined
    for n, w in what.items():
        v, c = F.col(f"__v_{n}"), F.col(f"__c_{n}")
        if isinstance(w, Beside):
            near = F.lag(F.struct(v.alias("v"))).over(here) if w.by < 0 else F.lead(F.struct(v.alias("v"))).over(here)
            out = out.withColumn(n, F.coalesce(near, c)["v"])
            continue
        frame = rest if isinstance(w, Behind) else past if isinstance(w, Before) else upto
        if w.how == "last":
            out = out.withColumn(n, F.coalesce(F.last(v, True).over(frame), c))
        elif w.how == "sum":
            out = out.withColumn(n, F.coalesce(F.sum(v).over(frame), F.lit(0)) + F.coalesce(c, F.lit(0)))
        else:
            both = F.greatest if w.how == "max" else F.least
            out = out.withColumn(n, both(_TOTAL[w.how](v).over(frame), c))  # the one that isn't null, if only one is
    return out.drop("__st", *[f"__v_{n}" for n in names], *[f"__c_{n}" for n in names])


def _over(w: UpTo | Beside, total: Column, line, past, rest) -> Column:
    """What whole stretches before, or behind, bring along."""
    if isinstance(w, Beside):
        return F.lag(total).over(line) if w.by < 0 else F.lead(total).over(line)
    if w.how == "last":
        return F.last(total, True).over(past)
    return _TOTAL[w.how](total).over(rest if isinstance(w, Behind) else past)
