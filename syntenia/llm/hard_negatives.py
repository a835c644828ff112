"""Hard-negative mining by one-dimensional distance keys.

Inner products become distances by one more component: a row x of norm at most M
gets sqrt(M^2 - |x|^2), so all rows lie on a sphere of radius M, and an anchor scaled
to norm M (and 0 in that component) has the larger inner product with the nearer row:
d^2 = 2 M^2 - 2 (M / |a|) <a, x>. Each row is filed under its nearest pivot and
stored sorted by (pivot, distance to the pivot), cut into blocks of bounded size.
A row within w of an anchor lies, under every pivot, in the key interval of w on
either side of the anchor's own distance (triangle inequality). The search scans
growing intervals, each block once, and an anchor is done when what it
has found is nearer than the width scanned: nothing unscanned can be better.

Scores are exact integers; distances only choose blocks, with a margin for rounding.
Anchors travel in packs and meet blocks by an equi-join on (pivot, distance bin), one
matrix product for each pair. Of identical vectors with one label only those with the
smallest ids can appear in a result, so only these are stored: a vector that
fills a third of the table is a handful of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from syntenia.llm import common
from syntenia.llm.centroid_clusters import finite, quantised

SCALE, EVERY, POSITIVES, NEGATIVES = 256, 50, 5, 3
#: Negatives score from LOW to HIGH hundredths of the positive.
LOW, HIGH = 50, 95
#: Pivots, rows of a block, anchors of a pack, distance bins up to the largest distance 2 M.
PIVOTS, BLOCK, PACK, BINS = 16, 4096, 1024, 64
#: Widths of the first intervals in units of M; the last scan is as wide as the bound found so far.
WIDTHS = (0.15, 0.5)
#: Scores handled at a time, and the margin of distances in units of M.
TILE, MARGIN = 1 << 19, 1e-6


class Sphere:
    """Distances between rows, anchors and pivots after augmentation to norm M."""

    def __init__(self, square: int, pivots: np.ndarray):
        self.square, self.radius = float(square), float(np.sqrt(square))
        self.pivots = pivots.astype(np.float64)
        self.raised = np.sqrt(np.maximum(self.square - (self.pivots**2).sum(1), 0))

    def rows(self, x: np.ndarray) -> np.ndarray:
        """Distance of each row to each pivot."""
        x = x.astype(np.float64)
        up = np.sqrt(np.maximum(self.square - (x**2).sum(1), 0))
        return np.sqrt(np.maximum(2 * self.square - 2 * (x @ self.pivots.T + np.outer(up, self.raised)), 0))

    def anchors(self, a: np.ndarray) -> np.ndarray:
        a = a.astype(np.float64)
        return self.of_scores(a @ self.pivots.T, np.sqrt((a**2).sum(1))[:, None])

    def of_scores(self, score: np.ndarray, norm: np.ndarray) -> np.ndarray:
        """Distance of rows with this inner product; an anchor of norm 0 is the centre of the sphere."""
        with np.errstate(divide="ignore", invalid="ignore"):
            d = np.sqrt(np.maximum(2 * self.square - 2 * self.radius / norm * score, 0))
        return np.where(norm > 0, d, self.radius)


def _padded(column: pa.Array, dim: int) -> np.ndarray:
    """Vectors as rows of int32; shorter ones are filled with 0."""
    at = column.offsets.to_numpy()
    out = np.zeros((len(column), dim), np.int32)
    size = np.diff(at)
    row = np.repeat(np.arange(len(column)), size)
    out[row, np.arange(len(row)) - np.repeat(at[:-1] - at[0], size)] = column.values.slice(at[0], at[-1] - at[0]).to_numpy()
    return out


def _candidates(rows: DataFrame, keep: int) -> DataFrame:
    """Of identical vectors with one label the ``keep`` smallest ids."""
    w = Window.partitionBy("q", "label").orderBy("vec_id")
    return rows.withColumn("n", F.row_number().over(w)).where(F.col("n") <= keep).drop("n")


def _keyed(rows: DataFrame, sphere: Sphere, dim: int) -> DataFrame:
    """Rows with their pivot, the distance to it and the padded vector as bytes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _padded(b.column(2), dim)
            d = sphere.rows(x)
            p = d.argmin(1)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([r.tobytes() for r in x], pa.binary()), pa.array(p.astype(np.int32)), pa.array(d[np.arange(len(x)), p])], ["vec_id", "label", "bytes", "pivot", "d"])

    return rows.select("vec_id", "label", "q").mapInArrow(run, "vec_id long, label long, bytes binary, pivot int, d double")


def _packed(rows: DataFrame, size: int, by_pivot: bool) -> DataFrame:
    """Sorted rows cut into runs of at most ``size``, of one pivot each if ``by_pivot``: (run, pivot, low, high, ids, labels, bytes)."""
    schema = pa.schema([("run", pa.int64()), ("pivot", pa.int32()), ("low", pa.float64()), ("high", pa.float64()), ("ids", pa.list_(pa.int64())), ("labels", pa.list_(pa.int64())), ("bytes", pa.binary())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, held = TaskContext.get().partitionId() << 32, None
        for b in _and_last(batches):
            held = b if held is None else held if b is None else pa.concat_batches([held, b])
            while held is not None and len(held) and (b is None or len(held) > size):
                n = min(size, len(held))
                if by_pivot:
                    p = held.column("pivot").slice(0, n).to_numpy()
                    n = int(np.searchsorted(p, p[0], "right"))
                part, held = held.slice(0, n), held.slice(n)
                d = part.column("d").to_numpy()
                row = {"run": made, "pivot": part.column("pivot")[0].as_py(), "low": float(d.min()), "high": float(d.max()), "ids": part.column("vec_id").to_pylist(), "labels": part.column("label").to_pylist(), "bytes": b"".join(part.column("bytes").to_pylist())}
                yield pa.RecordBatch.from_pylist([row], schema)
                made += 1

    return rows.mapInArrow(run, "run long, pivot int, low double, high double, ids array<long>, labels array<long>, bytes binary")


def _and_last(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def _wanted(packs: DataFrame, open_: DataFrame, sphere: Sphere, dim: int) -> DataFrame:
    """(pack, pivot, low, high): the key intervals that the open anchors of each pack want; ``open_`` has their widths."""
    each = open_.groupBy("pack").agg(F.collect_list(F.struct("at", "width")).alias("open"))  # at most PACK for a pack

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for pack, raw, opened in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist()):
                a = np.frombuffer(raw.as_buffer(), np.int32).reshape(-1, dim)
                at = np.array([o["at"] for o in opened])
                w = np.array([o["width"] for o in opened])[:, None] + MARGIN * sphere.radius
                d = sphere.anchors(a[at])
                n = d.shape[1]
                yield pa.RecordBatch.from_arrays([pa.array([pack] * n, pa.int64()), pa.array(range(n), pa.int32()), pa.array((d - w).min(0)), pa.array((d + w).max(0))], ["pack", "pivot", "low", "high"])

    return packs.select(F.col("run").alias("pack"), "bytes").join(each, "pack").mapInArrow(run, "pack long, pivot int, low double, high double")


def _binned(df: DataFrame, sphere: Sphere) -> DataFrame:
    """One row for each distance bin of an interval; ``first`` is the lowest."""
    width = max(2 * sphere.radius, 1.0) / BINS
    bin_of = lambda c: F.least(F.greatest(F.floor(F.col(c) / width), F.lit(0)), F.lit(BINS)).cast("int")
    return df.withColumn("first", bin_of("low")).withColumn("bin", F.explode(F.sequence("first", bin_of("high"))))


def _pairs(want: DataFrame, blocks: DataFrame, sphere: Sphere) -> DataFrame:
    """(pack, block) of the blocks that an interval touches now and that the earlier one didn't."""
    here = _binned(blocks.select(F.col("run").alias("block"), "pivot", "low", "high"), sphere)
    there = _binned(want, sphere).select("pack", "pivot", "bin", F.col("first").alias("first_wanted"), F.col("low").alias("from"), F.col("high").alias("to"), "had_from", "had_to")
    both = here.join(there, ["pivot", "bin"]).where(F.col("bin") == F.greatest("first", "first_wanted"))
    new = (F.col("high") >= F.col("from")) & (F.col("low") <= F.col("to")) & ~F.coalesce((F.col("high") >= F.col("had_from")) & (F.col("low") <= F.col("had_to")), F.lit(False))
    return both.where(new).select("pack", "block")


class Tile:
    """Scores of a pack's anchors with a block's rows as ordered integer keys: score first, then the smaller id."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels = ids[order], labels[order]
        self.rows = rows[order].astype(np.float64)
        self.n = len(ids)
        self.tie = self.n - 1 - np.arange(self.n)

    def keys(self, anchors: np.ndarray, labels: np.ndarray, same: bool, none: int) -> np.ndarray:
        """A row of ascending keys for each anchor; ``none`` where the label isn't wanted."""
        k = (anchors.astype(np.float64) @ self.rows.T).astype(np.int64) * self.n + self.tie
        k[(labels[:, None] == self.labels) != same] = none
        return k

    def read(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(id, score) of keys."""
        return self.ids[self.n - 1 - key % self.n], key // self.n


def _scanned(pairs: DataFrame, packs: DataFrame, blocks: DataFrame, asked: DataFrame | None, dim: int, k: int, square: int) -> DataFrame:
    """(pack, at, positive_score, vec_id, score): the first k of each pair of pack and block.

    Without ``asked`` rows of the anchor's label; with it (pack, at, positive_score, low, high) rows of
    other labels whose score lies between.
    """
    left = pairs.join(packs.select(F.col("run").alias("pack"), F.col("labels").alias("own"), F.col("bytes").alias("anchors")), "pack")
    if asked is not None:
        each = asked.groupBy("pack").agg(F.sort_array(F.collect_list(F.struct("at", "positive_score", "low", "high"))).alias("asked"))
        left = left.join(each, "pack")
    both = left.join(blocks.select(F.col("run").alias("block"), "ids", "labels", "bytes"), "block")
    cols = ["pack", "own", "anchors", "ids", "labels", "bytes", *(["asked"] if asked is not None else [])]
    none, plain = -(square + 1) * BLOCK, asked is None

    def like(tile: Tile, a: np.ndarray, own: np.ndarray) -> Iterator[tuple]:
        step = max(1, TILE // tile.n)
        for i in range(0, len(a), step):
            keys = tile.keys(a[i : i + step], own[i : i + step], True, none)
            if tile.n > k:
                keys = np.partition(keys, tile.n - k, axis=1)[:, tile.n - k :]
            at, col = np.nonzero(keys > none)
            yield at + i, np.full(len(at), -1), *tile.read(keys[at, col])

    def unlike(tile: Tile, a: np.ndarray, own: np.ndarray, asked: np.ndarray) -> Iterator[tuple]:
        span = 2 * (square + 2) * BLOCK
        step = max(1, min(TILE // tile.n, (1 << 62) // span - 1))
        for i in range(0, len(a), step):
            q = asked[(asked[:, 0] >= i) & (asked[:, 0] < i + step)]
            if not len(q):
                continue
            keys = tile.keys(a[i : i + step], own[i : i + step], False, none)
            keys.sort(axis=1)
            base = (q[:, 0] - i) * span
            flat = (keys + np.arange(len(keys))[:, None] * span).ravel()
            end = np.searchsorted(flat, q[:, 3] * tile.n + tile.n - 1 + base, "right")
            for back in range(1, k + 1):
                pos = end - back
                ok = pos >= (q[:, 0] - i) * tile.n
                key = flat[np.maximum(pos, 0)] - base
                ok &= key >= q[:, 2] * tile.n
                yield q[ok, 0], q[ok, 1], *tile.read(key[ok])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                vec = lambda c: np.frombuffer(b.column(c)[r].as_buffer(), np.int32).reshape(-1, dim)  # noqa: B023, E731
                tile = Tile(b.column("ids")[r].values.to_numpy(), b.column("labels")[r].values.to_numpy(), vec("bytes"))
                a, own = vec("anchors"), b.column("own")[r].values.to_numpy()
                found = like(tile, a, own) if plain else unlike(tile, a, own, np.stack([f.to_numpy() for f in b.column("asked")[r].values.flatten()], 1).astype(np.int64))
                for at, score, ids, scores in found:
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), b.column("pack")[r].as_py(), np.int64)), pa.array(at.astype(np.int32)), pa.array(score.astype(np.int64)), pa.array(ids), pa.array(scores)], ["pack", "at", "positive_score", "vec_id", "score"])

    return both.select(*cols).mapInArrow(run, "pack long, at int, positive_score long, vec_id long, score long")


def _first(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("pack", "at", "positive_score").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _search(scratch: common.Scratch, packs: DataFrame, blocks: DataFrame, goals: DataFrame, asked: DataFrame | None, sphere: Sphere, dim: int, k: int, square: int) -> DataFrame:
    """The first k rows for each goal (pack, at, positive_score, norm, least), by expanding intervals.

    ``least`` is the lowest score that a goal can use (null: any). A goal is done when the width
    scanned reaches its k-th row found, or ``least``; the last scan is as wide as that bound.
    """
    goal = ["pack", "at", "positive_score"]
    best, had, reached = None, None, 0.0
    for width in (*WIDTHS, None):
        bound = goals if best is None else goals.join(best.groupBy(*goal).agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("kth")), goal, "left")
        score = F.greatest(F.lit(None).cast("long") if best is None else F.col("kth"), F.col("least"))  # greatest skips null
        apart = F.sqrt(F.greatest(F.lit(2.0 * square) - F.lit(2 * sphere.radius) / F.nullif("norm", F.lit(0.0)) * score, F.lit(0.0)))
        far = F.when(F.col("norm") <= 0, F.lit(sphere.radius)).when(score.isNull(), F.lit(2 * sphere.radius)).otherwise(apart)
        need = bound.select(*goal, far.alias("far"))
        wide = need.where(F.col("far") > reached * sphere.radius).groupBy("pack", "at").agg(F.max(F.col("far") if width is None else F.least("far", F.lit(width * sphere.radius))).alias("width"))
        new = _wanted(packs, wide, sphere, dim)
        if had is not None:
            new = new.join(had.select("pack", "pivot", F.col("low").alias("had_from"), F.col("high").alias("had_to")), ["pack", "pivot"], "left")
            new = new.withColumns({"low": F.least("low", "had_from"), "high": F.greatest("high", "had_to")})
        else:
            new = new.withColumns({"had_from": F.lit(None).cast("double"), "had_to": F.lit(None).cast("double")})
        want = scratch.write(new, "want")
        reached = width
        if want.isEmpty():
            scratch.drop(want)
            break
        found = _scanned(_pairs(want, blocks, sphere), packs, blocks, asked, dim, k, square)
        merged = scratch.write(_first(found if best is None else found.unionByName(best.drop("rank")), k), "best")
        for old in (best, had):
            if old is not None:
                scratch.drop(old)
        best, had = merged, want
    return best


def _empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")


def mined(vectors: DataFrame, every: int = EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: int = SCALE) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of ``vectors`` (vec_id, embedding, label).

    Anchors are rows whose vec_id is divisible by ``every``. Rows with a null label or
    vector, or a null or non-finite component, take no part, nor do rows without an
    id, which no result could name. Rows equal in id, label and vector count once; "other"
    rows are those with another id. Of vectors of different lengths the shorter count as
    filled with 0. Equal scores go by the smaller id. An empty table, or one without anchors, gives
    no rows. Other columns aren't read, so names can't clash. Vectors whose keys
    (squared norm times block size) pass 2^60 fail the job.
    """
    spark = vectors.sparkSession
    scratch = common.Scratch(spark)
    v = F.col("embedding")
    src = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite(v))
    rows = src.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), quantised(v, scale).alias("q"))
    anchors = rows.where(F.col("vec_id") % every == 0).distinct()
    square_of: Callable[[], Column] = lambda: F.aggregate("q", F.lit(0).cast("long"), lambda s, x: s + x.cast("long") * x.cast("long"))
    bounds = rows.agg(F.max(square_of()).alias("square"), F.max(F.size("q")).alias("dim"), F.count(F.lit(1)).alias("n")).first()
    if not bounds["n"]:
        return _empty(spark)
    square, dim = max(1, int(bounds["square"])), max(1, int(bounds["dim"]))
    if square * BLOCK * 4 >= 1 << 62:
        raise ValueError("vectors are too long for exact integer keys")
    known = scratch.write(_candidates(rows.distinct(), positives + 1), "candidates")
    first = known.groupBy("q").agg(F.min(F.xxhash64("q")).alias("h")).orderBy("h", "q").limit(PIVOTS).collect()
    pivots = np.zeros((len(first), dim), np.int64)
    for i, r in enumerate(first):
        pivots[i, : len(r["q"])] = r["q"]
    sphere = Sphere(square, pivots)
    sorted_ = lambda df: df.repartitionByRange(common.shuffle_width(spark), "pivot", "d", "vec_id").sortWithinPartitions("pivot", "d", "vec_id")
    blocks = scratch.write(_packed(sorted_(_keyed(known, sphere, dim)), BLOCK, True), "blocks")
    scratch.drop(known)
    kinds = scratch.write(anchors.groupBy("q", "label").agg(F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("weight")).withColumn("kind", F.monotonically_increasing_id()), "kinds")
    packs = scratch.write(_packed(sorted_(_keyed(kinds.select(F.col("kind").alias("vec_id"), "label", "q"), sphere, dim)), PACK, False), "packs")
    place = packs.select(F.col("run").alias("pack"), F.posexplode("ids").alias("at", "kind"))
    goals = place.join(kinds.select("kind", F.sqrt(square_of().cast("double")).alias("norm")), "kind").select("pack", "at", F.lit(-1).cast("long").alias("positive_score"), "norm", F.lit(None).cast("long").alias("least"))
    goals = scratch.write(goals, "goals")
    tops = _search(scratch, packs, blocks, goals, None, sphere, dim, positives + 1, square)
    if tops is None:
        scratch.keep()
        return _empty(spark)
    asked = tops.where("score >= 0").select("pack", "at", F.col("score").alias("positive_score")).distinct()
    # low <= 100 * score and 100 * score <= high, in whole numbers
    asked = asked.withColumn("low", F.expr(f"(positive_score * {low} + 99) div 100")).withColumn("high", F.expr(f"(positive_score * {high}) div 100"))
    asked = scratch.write(asked, "asked")
    further = goals.select("pack", "at", "norm").join(asked, ["pack", "at"]).select("pack", "at", "positive_score", "norm", F.col("low").alias("least"))
    worse = _search(scratch, packs, blocks, further, asked, sphere, dim, negatives, square)
    if worse is None:
        scratch.keep()
        return _empty(spark)
    lists = worse.groupBy("pack", "at", "positive_score").agg(F.sort_array(F.collect_list(F.struct("rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")))).alias("negatives"))
    per = lists.groupBy("pack", "at").agg(F.map_from_entries(F.collect_list(F.struct("positive_score", "negatives"))).alias("negatives"))
    near = tops.groupBy("pack", "at").agg(F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("tops"))
    whole = scratch.write(place.join(kinds, "kind").join(near, ["pack", "at"]).join(per, ["pack", "at"]).select("q", "label", "weight", "tops", "negatives"), "whole")
    scratch.keep(whole)
    total = whole.agg(F.coalesce(F.sum("weight"), F.lit(0))).first()[0]
    each = common.join_table(anchors, whole, ["q", "label"], total)
    others = F.slice(F.filter("tops", lambda t: t["vec_id"] != F.col("vec_id")), 1, positives)
    each = each.select(F.col("vec_id").alias("anchor_id"), "negatives", F.explode(others).alias("p"))
    each = each.select("anchor_id", "p", F.explode(F.col("negatives")[F.col("p.score")]).alias("n"))
    return each.select("anchor_id", F.col("p.vec_id").alias("positive_id"), F.col("n.rank").cast("int").alias("rank"), "n.negative_id", F.col("p.score").alias("positive_score"), "n.negative_score")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of ``embeddings``; every seventh vec_id has the next label. Edge cases as in ``mined``."""
    vectors = common.table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mined(vectors.select("vec_id", "embedding", label.alias("label")))


OP12_SQL = """
WITH r AS MATERIALIZED (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)::BIGINT) AS q
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id, b.label, list_inner_product(a.q::DOUBLE[], b.q::DOUBLE[])::BIGINT AS score
  FROM r a JOIN r b ON a.vec_id % 50 = 0 AND b.vec_id <> a.vec_id),
p AS (SELECT anchor_id, own, vec_id AS positive_id, score AS positive_score FROM s WHERE label = own
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT p.anchor_id, p.positive_id, row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS rank,
  s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND s.label <> p.own AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""
