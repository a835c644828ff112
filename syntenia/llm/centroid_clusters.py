"""Centroid clustering with weighted deduplication.

Vectors are quantised to integers and identical ones become one row with a
weight. Lloyd's rounds run over the distinct vectors only: each task returns one
weighted integer sum for each centroid, Spark adds them up, and the new centroids
(a few integer vectors) go back with the next round. The assignment of the
distinct vectors is joined back to the rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from syntenia.llm import common

DIM, SCALE, CLUSTERS, ROUNDS, SEED = 64, 1024, 8, 10, 3
#: Integer components stay below this, so that squared distances of 64 of them fit in a long.
LARGEST = 1 << 27


def finite(vector: Column) -> Column:
    """Whether a vector is there and none of its components is null, NaN or infinite."""
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def quantised(vector: Column, scale: int, largest: int = LARGEST) -> Column:
    """floor(scale * x) of each component as an int; fails beyond ``largest``, where exact scores would overflow."""

    def one(x: Column) -> Column:
        y = F.floor(x.cast("double") * scale)
        return F.when(F.abs(y) < largest, y.cast("int")).otherwise(F.raise_error(F.lit("a component is too large for exact integer distances")).cast("int"))

    return F.transform(vector, one)


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """The vectors of an Arrow list column as rows of int64."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dim)


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid (ties: the smaller) and the squared distance, exactly."""
    apart = np.stack([((x - c) ** 2).sum(axis=1) for c in centroids], axis=1)
    at = apart.argmin(axis=1)
    return at, apart[np.arange(len(x)), at]


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """(q, weight): each vector once, counted before the shuffle."""
    return rows.groupBy("q").agg(F.count(F.lit(1)).alias("weight"))


def seeds(rows: DataFrame, k: int, seed: int) -> np.ndarray:
    """The first k vectors by the hash of seed and id; equal hashes (repeated ids) by the vector. Rows without an id are no seeds."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = rows.where("vec_id IS NOT NULL").select(key.alias("h"), "q").orderBy("h", "q").limit(k).collect()
    return np.array([r["q"] for r in first], np.int64)


def _moved(distinct: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """One round: assign the distinct vectors, replace each centroid by floor(weighted sum / weight)."""
    dim = centroids.shape[1]

    def sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, total = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64)
        for b in batches:
            x, w = matrix(b.column(0), dim), b.column(1).to_numpy()
            at, _ = nearest(x, centroids)
            np.add.at(weight, at, w)
            np.add.at(total, at, x * w[:, None])
        yield pa.RecordBatch.from_arrays([pa.array(range(len(centroids)), pa.int32()), pa.array(weight), pa.array(total.tolist(), pa.list_(pa.int64()))], ["cluster", "weight", "total"])

    parts = distinct.mapInArrow(sums, "cluster int, weight long, total array<long>")
    exact = [F.sum(F.col("total")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(dim)]
    new = centroids.copy()
    for r in parts.groupBy("cluster").agg(F.sum(F.col("weight").cast("decimal(38,0)")).alias("weight"), *exact).collect():
        if n := int(r["weight"]):
            new[r["cluster"]] = [int(r[f"s{i}"]) // n for i in range(dim)]
    return new


def _assigned(distinct: DataFrame, centroids: np.ndarray) -> DataFrame:
    dim = centroids.shape[1]

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, apart = nearest(matrix(b.column(0), dim), centroids)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(at.astype(np.int32)), pa.array(apart)], ["q", "weight", "cluster", "distance"])

    return distinct.mapInArrow(assign, "q array<int>, weight long, cluster int, distance long")


def clusters(vectors: DataFrame, dim: int = DIM, scale: int = SCALE, k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every kept row of ``vectors`` (vec_id, embedding).

    Kept are vectors of exactly ``dim`` components, none null or non-finite. With
    fewer than k kept rows there are as many centroids; an empty table, or one that
    keeps nothing, gives no rows. Repeated rows and ids give a row each and may both
    be seeds; the later of two equal centroids stays empty and where it is. A row
    without an id is clustered but never a seed; if no row has an id there are no
    centroids and no rows. Other columns of ``vectors`` aren't read, so names can't
    clash. A component of 2^27 / scale or more fails the job: its distances aren't longs.
    """
    spark = vectors.sparkSession
    v = F.col("embedding")
    rows = vectors.where((F.size(v) == dim) & finite(v)).select(F.col("vec_id").cast("long").alias("vec_id"), quantised(v, scale).alias("q"))
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    scratch = common.Scratch(spark)
    distinct = scratch.write(distinct_vectors(rows), "distinct")
    centroids = seeds(rows, k, seed)
    if not len(centroids):
        scratch.keep()
        return spark.createDataFrame([], schema)
    for _ in range(rounds):
        centroids = _moved(distinct, centroids)
    assigned = scratch.write(_assigned(distinct, centroids), "assigned")
    scratch.drop(distinct)
    per = {r["cluster"]: r for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)") * F.col("weight")).alias("inertia"), F.sum("weight").alias("rows")).collect()}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    every = sum(int(r["inertia"]) for r in per.values())
    found = common.join_table(rows, assigned, ["q"], sum(r["rows"] for r in per.values()))
    of = spark.createDataFrame([(c, int(r["inertia"]), every, digest[c]) for c, r in per.items()], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(of), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op13_weighted_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of ``embeddings`` in 8 centroids and 10 rounds; edge cases as in ``clusters``."""
    return clusters(common.table(spark, sf_dir, "embeddings"))


def op13_sql(dim: int = DIM, scale: int = SCALE, k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED) -> str:
    """DuckDB SQL of the same rows, one pair of steps for each round."""
    steps, last = [], "c0"
    for i in range(1, rounds + 1):
        steps.append(f"""
a{i} AS MATERIALIZED (SELECT r, arg_min(cluster, (d, cluster)) AS cluster FROM
  (SELECT v.r, c.cluster, sum((v.x - c.x) * (v.x - c.x)) AS d FROM v JOIN {last} c ON v.j = c.j GROUP BY v.r, c.cluster) GROUP BY r),
m{i} AS MATERIALIZED (SELECT a.cluster, v.j, sum(v.x)::HUGEINT AS s, count(*)::HUGEINT AS n FROM a{i} a JOIN v ON a.r = v.r GROUP BY a.cluster, v.j),
c{i} AS MATERIALIZED (SELECT c.cluster, c.j, coalesce(((m.s - ((m.s % m.n) + m.n) % m.n) // m.n)::BIGINT, c.x) AS x FROM {last} c LEFT JOIN m{i} m ON c.cluster = m.cluster AND c.j = m.j)""")
        last = f"c{i}"
    return f"""WITH kept AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * {scale})::BIGINT) AS q FROM embeddings
  WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dim}),
v AS MATERIALIZED (SELECT r, unnest(q) AS x, unnest(range(1, {dim} + 1)) AS j FROM kept),
c0 AS MATERIALIZED (SELECT cluster::INTEGER AS cluster, unnest(q) AS x, unnest(range(1, {dim} + 1)) AS j FROM
  (SELECT q, row_number() OVER (ORDER BY sha256('{seed}:' || vec_id), q) - 1 AS cluster FROM kept WHERE vec_id IS NOT NULL) WHERE cluster < {k}),{",".join(steps)},
f AS (SELECT r, arg_min(cluster, (d, cluster)) AS cluster, min(d)::BIGINT AS distance FROM
  (SELECT v.r, c.cluster, sum((v.x - c.x) * (v.x - c.x)) AS d FROM v JOIN {last} c ON v.j = c.j GROUP BY v.r, c.cluster) GROUP BY r),
h AS (SELECT cluster, sha256(string_agg(x::VARCHAR, ',' ORDER BY j)) AS centroid_sha256 FROM {last} GROUP BY cluster)
SELECT kept.vec_id, f.cluster, f.distance, (sum(f.distance) OVER (PARTITION BY f.cluster))::BIGINT AS cluster_inertia, (sum(f.distance) OVER ())::BIGINT AS inertia, h.centroid_sha256
FROM kept JOIN f USING (r) JOIN h ON f.cluster = h.cluster"""
