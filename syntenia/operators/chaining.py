"""Optimal chaining of the alignments of an island, and its left-overs.

The chain maximises identical residues less skipped covered positions; every two
members must be in the same order on protein and sequence and overlap alike on
both. Left-overs on either side of a chain are chained again. Islands are
independent: sorted rows stream through Arrow batches, and only one island is held
at a time, which is bounded by one protein's alignments near one place.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from syntenia import schema
from syntenia.operators.alignments import KEYS
from syntenia.options import Scoring

#: Covered nucleotides that cost one identical residue when skipped.
SKIP = 12


class _Hits:
    """The alignments of one island, ordered by their end."""

    def __init__(self, rows):
        order = np.lexsort([np.asarray(rows[c]) for c in reversed(ORDER)])
        col = lambda c: np.asarray(rows[c], np.int64)[order]
        self.s, self.e = col("loc_startS"), col("loc_endS")
        self.p, self.q = np.minimum(col("prot_start"), col("prot_end")), np.maximum(col("prot_start"), col("prot_end"))
        self.a, self.b = np.minimum(col("loc_start"), col("loc_end")), np.maximum(col("loc_start"), col("loc_end"))
        self.n = col("nident")

    def __len__(self) -> int:
        return len(self.s)

    def take(self, index) -> _Hits:
        out = object.__new__(_Hits)
        for name, values in vars(self).items():
            setattr(out, name, values[index])
        return out


def _coverage(start: np.ndarray, end: np.ndarray):
    """A function: covered positions up to a point, over the union of closed intervals."""
    order = np.argsort(start, kind="stable")
    lo, hi = [], []
    for s, e in zip(start[order].tolist(), end[order].tolist()):
        if hi and s <= hi[-1]:
            hi[-1] = max(hi[-1], e)
        else:
            lo.append(s)
            hi.append(e)
    lo_, hi_ = np.array(lo), np.array(hi)
    base = np.concatenate([[0], np.cumsum(hi_ - lo_ + 1)])

    def upto(x):
        i = np.searchsorted(lo_, x, "right") - 1
        return np.where(i < 0, 0, base[i] + np.minimum(x, hi_[i]) - lo_[i] + 1)

    return upto


def _union(intervals: list[tuple[int, int]]) -> int:
    total, last = 0, None
    for s, e in sorted(intervals):
        first = s if last is None else max(s, last + 1)
        total += max(0, e - first + 1)
        last = e if last is None else max(last, e)
    return total


def _costs(h: _Hits, i: np.ndarray, j: np.ndarray | int) -> np.ndarray:
    """Residues counted twice if i comes before j in a chain; -1 if they don't go together."""
    shared = lambda s, e: np.maximum(0, np.minimum(e[i], e[j]) - np.maximum(s[i], s[j]) + 1)
    least = np.minimum(np.minimum((h.q - h.p + 1)[i], (h.q - h.p + 1)[j]), np.minimum((h.e - h.s + 1)[i] // 3, (h.e - h.s + 1)[j] // 3))
    on_seq, on_prot = -(-shared(h.s, h.e) // 3), shared(h.p, h.q)
    good = (h.p[i] < h.p[j]) & (h.s[i] < h.s[j]) & (np.abs(on_seq - on_prot) <= 0.5 * least)
    return np.where(good, np.minimum(np.maximum(on_seq, on_prot), np.minimum(h.n[i], h.n[j])), -1)


def pair_costs(h: _Hits) -> np.ndarray:
    """costs[i, j] of all pairs of a few alignments."""
    at = np.arange(len(h))
    return _costs(h, at[:, None], at[None, :])


def best_chain(h: _Hits) -> list[int]:
    """Positions of the best chain's members.

    Of equal predecessors the nearest wins, of equal ends the first.
    """
    return best_path(h)[0]


def best_path(h: _Hits) -> tuple[list[int], int]:
    """Positions of the best chain's members, and its identical residues.

    A chain is kept as its last member and a link to the chain it extends. For each
    alignment the predecessors are tried from the best possible score down - the gain
    less what overlaps the predecessor itself - until none can be better. What earlier
    members overlap is found along the links, back to where neither an end on the
    sequence nor the furthest end on the protein reaches the new alignment.
    """
    m = len(h)
    upto = _coverage(h.s, h.e)
    at_start, at_end = upto(h.s), upto(h.e)
    n, skipped = h.n.copy(), at_start.copy()
    back, reach = np.full(m, -1, np.int64), h.q.copy()
    score = n - skipped // SKIP
    for j in range(1, m):
        # a pair's skipped positions and gain before any overlap is known
        gap = np.where(h.s[j] >= h.e[:j], at_start[j] - at_end[:j] + 1, 0)
        most = n[:j] + h.n[j] - (skipped[:j] + gap) // SKIP
        i = np.flatnonzero((most > score[j]) & (h.p[:j] < h.p[j]) & (h.s[:j] < h.s[j]))
        if not len(i):
            continue
        costs = _costs(h, i, j)
        bound = np.where(costs < 0, score[j], most[i] - costs)
        best, least = -1, int(score[j])
        for k in _from_the_top(bound, least):
            x = int(i[k])
            if int(bound[k]) < least or int(bound[k]) == least and x < best:
                break
            twice = _shared(h, back, reach, x, j, int(costs[k]))
            if twice is None:
                continue
            got = int(n[x] + h.n[j]) - twice - int(skipped[x] + gap[x]) // SKIP
            if got > least or got == least and x > best >= 0:
                best, least, lost = x, got, twice
        if best >= 0:
            n[j], skipped[j], back[j] = n[best] + h.n[j] - lost, skipped[best] + gap[best], best
            reach[j], score[j] = max(reach[j], reach[best]), least
    last = int(score.argmax())
    path, residues = [last], int(n[last])
    while back[path[-1]] >= 0:
        path.append(int(back[path[-1]]))
    return path[::-1], residues


def _from_the_top(bound: np.ndarray, least: int) -> Iterator[int]:
    """Positions whose bound exceeds ``least``, from the highest down; of equal ones the last first."""
    open_ = np.flatnonzero(bound > least)
    size = 8
    while len(open_):
        if len(open_) > 2 * size:  # most often the first few settle it
            cut = np.partition(bound[open_], len(open_) - size)[len(open_) - size]
            now = bound[open_] >= cut
        else:
            now = np.ones(len(open_), bool)
        part = open_[now]
        yield from part[np.lexsort((-part, -bound[part]))].tolist()
        open_, size = open_[~now], 8 * size


def _shared(h: _Hits, back: np.ndarray, reach: np.ndarray, i: int, j: int, cost: int) -> int | None:
    """Residues that j shares with the chain that ends at i, whose own cost is known; None if some member doesn't go with j."""
    total, i = cost, int(back[i])
    s, p = h.s[j], h.p[j]
    while i >= 0 and (h.e[i] >= s or reach[i] >= p):
        cost = int(_cost(h, i, j))
        if cost < 0:
            return None
        total, i = total + cost, int(back[i])
    return total


def _cost(h: _Hits, i: int, j: int) -> int:
    """``_costs`` of one pair that is in order."""
    on_seq = -(-max(0, int(min(h.e[i], h.e[j]) - max(h.s[i], h.s[j])) + 1) // 3)
    on_prot = max(0, int(min(h.q[i], h.q[j]) - max(h.p[i], h.p[j])) + 1)
    least = min(int(h.q[i] - h.p[i]) + 1, int(h.q[j] - h.p[j]) + 1, (int(h.e[i] - h.s[i]) + 1) // 3, (int(h.e[j] - h.s[j]) + 1) // 3)
    return min(max(on_seq, on_prot), int(h.n[i]), int(h.n[j])) if abs(on_seq - on_prot) <= 0.5 * least else -1


def chains_of(h: _Hits, shrink: int) -> list[tuple]:
    """(path on the sequence, path on the protein, identical residues, covered sequence, covered protein) of every chain."""
    out: list[tuple] = []
    todo = [h]
    while todo:
        h = todo.pop()
        path, n = ([0], int(h.n[0])) if len(h) == 1 else best_path(h)
        seq = sorted(zip(h.a[path].tolist(), h.b[path].tolist()))
        prot = sorted(zip(h.p[path].tolist(), h.q[path].tolist()))
        out.append((seq, prot, n, _union(seq), _union(prot)))
        lo, hi = int(h.s[path].min()), int(h.e[path].max())
        size, rest = h.e - h.s + 1, np.ones(len(h), bool)
        rest[path] = False
        long_ = size > 10 * shrink
        before = rest & ((h.e < lo) | (h.e - lo < shrink) & long_)
        after = rest & ~before & ((h.s > hi) | (hi - h.s < shrink) & long_)
        todo += [h.take(np.flatnonzero(m)) for m in (before, after) if m.any()]
    return out


#: Islands of up to so many alignments are chained on plain numbers: arrays cost more than they save there.
FEW = 24


def _path_of_few(h: list[tuple]) -> tuple[list[int], int]:
    """``best_path`` of a few alignments (s, e, p, q, a, b, n), ordered by their end: all predecessors, nearest first."""
    lo: list[int] = []
    hi: list[int] = []
    base = [0]
    for s, e in sorted(x[:2] for x in h):
        if hi and s <= hi[-1]:
            hi[-1] = max(hi[-1], e)
        else:
            if hi:
                base.append(base[-1] + hi[-1] - lo[-1] + 1)
            lo.append(s)
            hi.append(e)

    def upto(x: int) -> int:
        k = bisect_right(lo, x) - 1
        return base[k] + min(x, hi[k]) - lo[k] + 1 if k >= 0 else 0

    ends = [upto(x[1]) for x in h]
    n, skipped, back, score = [], [], [], []
    for j, (s, e, p, q, _, _, own) in enumerate(h):
        at = upto(s)
        best, mine = -1, (own, at)
        top = own - at // SKIP
        for i in range(j - 1, -1, -1):
            x = h[i]
            if x[2] >= p or x[0] >= s:
                continue
            gap = at - ends[i] + 1 if s >= x[1] else 0
            past = skipped[i] + gap
            got = n[i] + own - past // SKIP
            k = i
            while got > top and k >= 0:
                y = h[k]
                on_seq = -(-max(0, min(e, y[1]) - max(s, y[0]) + 1) // 3)
                on_prot = max(0, min(q, y[3]) - max(p, y[2]) + 1)
                if on_seq or on_prot:
                    least = min(q - p + 1, y[3] - y[2] + 1, (e - s + 1) // 3, (y[1] - y[0] + 1) // 3)
                    if abs(on_seq - on_prot) > 0.5 * least:
                        break
                    got -= min(max(on_seq, on_prot), own, y[6])
                k = back[k]
            else:
                if k < 0 and got > top:
                    best, top, mine = i, got, (got + past // SKIP, past)
        n.append(mine[0])
        skipped.append(mine[1])
        back.append(best)
        score.append(top)
    last = score.index(max(score))
    path = [last]
    while back[path[-1]] >= 0:
        path.append(back[path[-1]])
    return path[::-1], n[last]


def _chains_of_few(h: list[tuple], shrink: int) -> list[tuple]:
    """``chains_of`` for a few alignments (s, e, p, q, a, b, n), ordered by their end."""
    out: list[tuple] = []
    todo = [h]
    while todo:
        h = todo.pop()
        path, n = _path_of_few(h) if len(h) > 1 else ([0], h[0][6])
        seq = sorted((h[i][4], h[i][5]) for i in path)
        prot = sorted((h[i][2], h[i][3]) for i in path)
        out.append((seq, prot, n, _union(seq), _union(prot)))
        if len(path) == len(h):
            continue
        lo, hi = min(h[i][0] for i in path), max(h[i][1] for i in path)
        before, after = [], []
        for i, x in enumerate(h):
            if i in path:
                continue
            s, e = x[:2]
            long_ = e - s + 1 > 10 * shrink
            if e < lo or e - lo < shrink and long_:
                before.append(x)
            elif s > hi or hi - s < shrink and long_:
                after.append(x)
        todo += [x for x in (before, after) if x]
    return out


ORDER = ("loc_endS", "loc_startS", "prot_start", "prot_end")
NUMBERS = (*ORDER, "loc_start", "loc_end", "nident")


def _chained(batches: Iterable[pa.RecordBatch], shrink: int) -> Iterator[pa.RecordBatch]:
    """Chains of islands from rows sorted by island and end; an island that goes on is held for the next batch."""
    held: pa.RecordBatch | None = None
    for b in batches:
        b = pa.concat_batches([held, b]) if held is not None and held.num_rows else b
        if not b.num_rows:
            continue
        starts = _starts(b)
        yield from _chains_of_batch(b.slice(0, starts[-1]), starts[:-1], shrink)
        held = b.slice(starts[-1])
    if held is not None and held.num_rows:
        yield from _chains_of_batch(held, _starts(held), shrink)


def _starts(b: pa.RecordBatch) -> np.ndarray:
    """Rows at which an island begins; they are counted from 1 in each."""
    length = b.column(4).fill_null(-1).to_numpy(zero_copy_only=False)
    new = b.column(b.num_columns - 1).to_numpy(zero_copy_only=False) == 1
    new[1:] |= length[1:] != length[:-1]
    new[0] = True
    return np.flatnonzero(new)


def _spans(starts: np.ndarray, ends: np.ndarray, offsets: np.ndarray) -> pa.Array:
    span = pa.StructArray.from_arrays([pa.array(starts, pa.int64()), pa.array(ends, pa.int64())], ["start", "end"])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), span)


def _chains_of_batch(b: pa.RecordBatch, starts: np.ndarray, shrink: int) -> Iterator[pa.RecordBatch]:
    """Islands of one alignment are their chains, all at once; others are chained one by one."""
    if not len(starts):
        return
    v = {name: np.asarray(b.column(5 + i).to_numpy(zero_copy_only=False)) for i, name in enumerate(NUMBERS)}
    p, q = np.minimum(v["prot_start"], v["prot_end"]), np.maximum(v["prot_start"], v["prot_end"])
    a, e = np.minimum(v["loc_start"], v["loc_end"]), np.maximum(v["loc_start"], v["loc_end"])
    n = v["nident"]
    sizes = np.diff(np.append(starts, b.num_rows))
    one = starts[sizes == 1]
    if len(one):
        at = np.arange(len(one) + 1)
        first = np.zeros(len(one), np.int64)
        yield _batch(b, one, first, _spans(a[one], e[one], at), _spans(p[one], q[one], at), [a[one], e[one], p[one], q[one], n[one], e[one] - a[one] + 1, q[one] - p[one] + 1])
    heads, places, on_seq, on_prot, cut, hulls = [], [], [], [], [0], []
    plain = [x.tolist() for x in (v["loc_startS"], v["loc_endS"], p, q, a, e, n)] if len(one) < len(starts) else []
    for i, m in zip(starts[sizes > 1].tolist(), sizes[sizes > 1].tolist()):
        if m <= FEW:
            got = _chains_of_few(list(zip(*(x[i : i + m] for x in plain))), shrink)
        else:
            got = chains_of(_Hits({c: x[i : i + m] for c, x in v.items()}), shrink)
        for k, (seq, prot, total, covered, residues) in enumerate(got):
            heads.append(i)
            places.append(k)
            on_seq += seq
            on_prot += prot
            cut.append(len(on_seq))
            hulls.append((seq[0][0], max(x for _, x in seq), prot[0][0], max(x for _, x in prot), total, covered, residues))
    if heads:
        paths = [_spans(*np.array(x, np.int64).T, np.array(cut)) for x in (on_seq, on_prot)]
        yield _batch(b, np.array(heads), np.array(places), *paths, list(np.array(hulls, np.int64).T))


def _batch(b: pa.RecordBatch, rows: np.ndarray, places: np.ndarray, seq: pa.Array, prot: pa.Array, numbers: list[np.ndarray]) -> pa.RecordBatch:
    keys = [b.column(i).take(pa.array(rows)) for i in (0, 1, 2, 4, 3)]
    return pa.RecordBatch.from_arrays([*keys, pa.array(places, pa.int32()), seq, prot, *(pa.array(x, pa.int64()) for x in numbers)], _COLUMNS)


def chain_islands(hsps: DataFrame, scoring: Scoring = Scoring()) -> DataFrame:
    """One row for each chain of each island (``hsp_islands`` gives the islands).

    The window that counts an island's rows also brings them together and in order; they then stream through.
    """
    shrink = scoring.shrink
    rows = hsps.select("chr_id", F.col("strand").cast("int").alias("strand"), "prot_id", F.col("island").cast("long").alias("island"), F.col("prot_len").cast("long").alias("prot_len"), *(F.col(c).cast("long").alias(c) for c in NUMBERS))
    along = Window.partitionBy(*KEYS, "island").orderBy(*ORDER)
    return rows.withColumn("__k", F.row_number().over(along)).mapInArrow(lambda b: _chained(b, shrink), schema.CHAINS)


_COLUMNS = [
    "chr_id", "strand", "prot_id", "prot_len", "island", "chain", "chr_path", "prot_path",
    "chr_start", "chr_end", "prot_start", "prot_end", "nident", "nhomol_loc", "nhomol_prot",
]
