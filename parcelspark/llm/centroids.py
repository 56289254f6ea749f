"""Centroid clustering in whole numbers: the threshold algorithm finds each vector's nearest centroid.

In each dimension the centroids stand sorted. From a vector's value the lists are walked outward in all dimensions, one centroid a step;
a centroid met for the first time gets its exact distance. What was not met yet is, in each dimension, at least as
far as the next one there, so once the sum of those squares strictly exceeds the best distance, no other centroid can be
nearer or as near.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelspark.sources.tables import written

#: Values up to this keep every sum of squares of 64 dimensions within a 64-bit integer.
MOST = 1 << 26
#: Vectors worked on at a time.
ROWS = 4096


@dataclass(frozen=True)
class Settings:
    clusters: int = 8  # centroids pass through the driver, so this times the dimensions bounds it
    dimensions: int = 64
    scale: int = 1024
    rounds: int = 10
    seed: int = 3


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each vector: the number of its nearest centroid (ties: the smaller), the squared distance, and the steps walked."""
    k, dims = centroids.shape
    n = len(vectors)
    order = np.argsort(centroids, axis=0, kind="stable")  # [place, dimension] -> centroid
    value = np.take_along_axis(centroids, order, 0)
    x = np.ascontiguousarray(vectors.T)  # [dimension, vector]
    # places 0 and k + 1 are fences, farther off than any centroid
    far = 4 * MOST
    fenced = np.concatenate([np.full((1, dims), -far), value, np.full((1, dims), far)]).T.copy()
    number = np.concatenate([np.zeros((1, dims), np.int64), order, np.zeros((1, dims), np.int64)]).T.copy()
    right = np.stack([np.searchsorted(value[:, d], x[d], "right") for d in range(dims)]) + 1
    base = np.arange(dims)[:, None] * (k + 2)
    left, right = base + right - 1, base + right
    fenced, number = fenced.reshape(-1), number.reshape(-1)
    to_left, to_right = x - fenced[left], fenced[right] - x

    best = np.full(n, np.iinfo(np.int64).max)
    who = np.full(n, k)
    steps = np.zeros(n, np.int64)
    seen = np.zeros((k, n), bool)
    live = np.arange(n)
    step = 0
    while len(live):
        step += 1
        # one centroid in each dimension: the nearer of the next on both sides
        go_left = to_left <= to_right
        met = number[np.where(go_left, left, right)]
        left, right = left - go_left, right + ~go_left
        to_left, to_right = x - fenced[left], fenced[right] - x
        for j in range(k):
            new = np.flatnonzero((met == j).any(0) & ~seen[j, live])
            if len(new):
                at = live[new]
                seen[j, at] = True
                off = x[:, new] - centroids[j][:, None]
                distance = np.einsum("dn,dn->n", off, off)
                better = (distance < best[at]) | ((distance == best[at]) & (j < who[at]))
                best[at[better]], who[at[better]] = distance[better], j
        steps[live] = step
        if step == k:
            break
        frontier = np.minimum(to_left, to_right)
        on = np.einsum("dn,dn->n", frontier, frontier) <= best[live]
        if not on.all():
            live, x, left, right = live[on], x[:, on], left[:, on], right[:, on]
            to_left, to_right = to_left[:, on], to_right[:, on]
    return who, best, steps


def whole_vectors(vectors: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """vec_id, vector: each component x as floor(scale * x), of vectors with all ``dimensions`` components, none null or not finite.

    Other rows are left out; rows that repeat an id or a vector stay as often as they come. A component beyond
    2^26 / scale fails, as exact 64-bit distances would.
    """
    x = F.col("embedding")
    sound = (F.size(x) == settings.dimensions) & F.forall(
        x, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v.cast("double")) < float("inf")), F.lit(False)))
    scaled = F.transform(x, lambda v: F.floor(F.lit(float(settings.scale)) * v.cast("double")))
    fits = F.forall(F.col("vector"), lambda v: F.abs(v) <= MOST)
    return vectors.filter(sound).select("vec_id", scaled.alias("vector")) \
        .select("vec_id", F.when(fits, F.col("vector").cast("array<int>"))
                .otherwise(F.raise_error(F.lit(f"a component is beyond {MOST} / {settings.scale}")).cast("array<int>")).alias("vector"))


def _blocks(batch: pa.RecordBatch, column: int, dims: int) -> Iterator[tuple[int, np.ndarray]]:
    values = batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
    for start in range(0, len(values), ROWS):
        yield start, values[start:start + ROWS].astype(np.int64)


def cluster_sums(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """cluster, dimension, total, n over the vectors nearest to each centroid; a task adds its own vectors up first."""
    k, dims = centroids.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            for _, block in _blocks(batch, 0, dims):
                who, _, _ = nearest(block, centroids)
                n += np.bincount(who, minlength=k)
                np.add.at(total, who, block)
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(used, dims)), pa.array(np.tile(np.arange(dims), len(used))), pa.array(total[used].reshape(-1)),
             pa.array(np.repeat(n[used], dims))], ["cluster", "dimension", "total", "n"])

    rows = vectors.select("vector").mapInArrow(add, "cluster bigint, dimension bigint, total bigint, n bigint")
    return rows.groupBy("cluster", "dimension").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))


def assign(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster, distance (squared) of each vector."""
    dims = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, block in _blocks(batch, 1, dims):
                who, distance, _ = nearest(block, centroids)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(block)), pa.array(who.astype(np.int32)), pa.array(distance)],
                    ["vec_id", "cluster", "distance"])

    kind = vectors.schema["vec_id"].dataType.simpleString()
    return vectors.select("vec_id", "vector").mapInArrow(run, f"vec_id {kind}, cluster int, distance bigint")


def first_centroids(vectors: DataFrame, settings: Settings) -> np.ndarray:
    """The vectors whose ``<seed>:<vec_id>`` has the smallest sha256; of rows that repeat an id, the smaller vector first."""
    mark = F.sha2(F.concat(F.lit(f"{settings.seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.filter(F.col("vec_id").isNotNull()).orderBy(mark, "vector").limit(settings.clusters).select("vector").collect()
    return np.array([r.vector for r in rows], np.int64).reshape(len(rows), settings.dimensions)


def cluster(vectors: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per sound row of ``vectors`` (vec_id, embedding): vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    ``rounds`` times every vector goes to its nearest centroid and every centroid with vectors to the floored mean of them; then all are
    assigned once more. Fewer vectors than ``clusters`` give as many centroids; rows without an id are assigned but start no
    centroid, and alone they give no rows; an empty table gives an empty one. Centroids and their sums go through the driver,
    ``clusters`` times ``dimensions`` numbers a round whatever the input.
    """
    whole = written(whole_vectors(vectors, settings))
    centroids = first_centroids(whole, settings)
    if not len(centroids):
        return whole.limit(0).select("vec_id", F.lit(0).alias("cluster"), *[
            F.lit(0).cast("long").alias(c) for c in ("distance", "cluster_inertia", "inertia")], F.lit("").alias("centroid_sha256"))
    for _ in range(settings.rounds):
        moved = centroids.copy()
        for r in cluster_sums(whole, centroids).collect():
            moved[r.cluster, r.dimension] = r.total // r.n
        if (moved == centroids).all():
            break  # further rounds would change nothing
        centroids = moved
    rows = written(assign(whole, centroids))
    sums = rows.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).collect()
    marks = {r.cluster: hashlib.sha256(",".join(map(str, centroids[r.cluster].tolist())).encode()).hexdigest() for r in sums}
    of = rows.sparkSession.createDataFrame(
        [(r.cluster, r.cluster_inertia, sum(x.cluster_inertia for x in sums), marks[r.cluster]) for r in sums],
        "of int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    # at most ``clusters`` rows: the one side that is broadcast
    return rows.join(F.broadcast(of), F.col("cluster") == F.col("of")).drop("of")


def op12_centroid_clustering(spark, sf_dir: str) -> DataFrame:
    return cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
