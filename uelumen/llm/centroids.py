"""Centroid clustering with adaptive bounds: exact k-means on whole numbers, by bounds that spare most distances.

A vector of ``dim`` components becomes the whole numbers floor(scale * x). Besides its centroid, each vector keeps an upper bound of the distance to it, lower
bounds of the distances to its ``kept`` next nearest centroids, in order, and one *remainder* bound for all others. When the centroids have moved, the upper bound grows by
the move of its centroid, each lower bound shrinks by the move of its own, the remainder by the greatest move. Then for each vector:

* the upper bound lies below all others: the centroid stays, no distance is computed;
* it lies below all bounds after the i-th: the nearest is the vector's own centroid or one of those i. These distances are computed exactly, and the i + 1 put in order anew;
* it doesn't even lie below the remainder: every distance is computed.

Bounds are floats that are rounded away from what they bound, and certify only by a strict inequality, so ties (which the smaller number wins) are always decided by exact
whole-number distances and the result is that of full scans.

Each round reads and writes the table of vectors and bounds once; sums of clusters are kept up by the vectors that have changed cluster, added up in each task first. Only the
centroids and their sums (k times dim numbers) come to the driver and go to the tasks.

Defined results: vectors that are null, of another length, or hold a null or non-finite component are left out; a component beyond 2 ** 27 in size raises an error, because distances wouldn't fit a long;
rows with equal vec_id are vectors of their own, among which the bytes of the vectors decide which is taken first as a centroid; a null vec_id is kept and comes last there; with
fewer than k vectors each is a centroid; an empty table gives an empty result; only vec_id and embedding are read, whatever others there are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uelumen.llm.common import bound_batches, map_texts, scope, stage_table, trimmed

MOST = 1 << 27
#: A vector's nearest centroid, then the floors of the means; ``{c}`` are the centroids before.
_NEAREST = """n{i} AS (SELECT rid, v.c, k, list_sum(list_transform(list_zip(v.c, {c}.c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d FROM v, {c}),
a{i} AS (SELECT rid, c, k, d FROM n{i} QUALIFY row_number() OVER (PARTITION BY rid ORDER BY d, k) = 1)"""
_MEANS = """s{i} AS (SELECT k, j, sum(c[j]) AS s, count(*) AS n FROM a{i}, range(1, 65) r(j) GROUP BY k, j),
m{i} AS (SELECT k, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS c FROM s{i} GROUP BY k),
c{i} AS (SELECT k, coalesce(m{i}.c, {c}.c) AS c FROM {c} LEFT JOIN m{i} USING (k))"""
ORACLE_SQL = """WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS c
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS k, c FROM v ORDER BY sha256('1:' || vec_id) LIMIT 16),
""" + ",\n".join(f"{_NEAREST.format(i=i, c=f'c{i - 1}')},\n{_MEANS.format(i=i, c=f'c{i - 1}')}" for i in (1, 2, 3)) + """,
""" + _NEAREST.format(i=4, c="c3") + """
SELECT vec_id, CAST(a4.k AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY a4.k) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c3.c, ',')) AS centroid_sha256
FROM a4 JOIN v USING (rid) JOIN c3 ON c3.k = a4.k"""
UP, DOWN = 1 + 2.0**-50, 1 - 2.0**-50


def whole_numbers(column: pa.Array, dim: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of the vectors that are kept, and their components."""
    at = np.flatnonzero(pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False) == dim)
    flat = pc.list_flatten(column.take(pa.array(at))).cast(pa.float64())
    x = flat.fill_null(np.nan).to_numpy(zero_copy_only=False).reshape(-1, dim)
    sound = np.isfinite(x).all(axis=1)
    x = np.floor(scale * x[sound])
    if x.size and not np.abs(x).max() <= MOST:
        raise ValueError(f"a component is beyond {MOST} / {scale}: squared distances don't fit a long")
    return at[sound], x.astype(np.int64)


def distances(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """All squared distances, exactly: as products of matrices of floats while every sum stays below 2 ** 53."""
    reach = max(1, *(int(np.abs(m).max()) if m.size else 0 for m in (vectors, centroids)))
    if vectors.shape[1] * (2 * reach) ** 2 < 1 << 53:
        v, c = vectors.astype(np.float64), centroids.astype(np.float64)
        return ((v * v).sum(axis=1)[:, None] - 2 * (v @ c.T) + (c * c).sum(axis=1)[None]).astype(np.int64)
    return np.stack([((vectors - c) ** 2).sum(axis=1) for c in centroids], axis=1)


class Bounds:
    """What is known of some vectors: the cluster, the upper bound, the ``kept`` next centroids and the bounds of these and of all others."""

    def __init__(self, cluster: np.ndarray, upper: np.ndarray, near: np.ndarray, lower: np.ndarray):
        self.cluster, self.upper, self.near, self.lower = cluster, upper, near, lower

    @staticmethod
    def scan(vectors: np.ndarray, centroids: np.ndarray, kept: int) -> Bounds:
        d = distances(vectors, centroids)
        order = np.argsort(d, axis=1, kind="stable")  # of equal distances the smaller number comes first
        root = np.sqrt(np.take_along_axis(d, order, 1))
        rest = root[:, kept + 1] * DOWN if len(centroids) > kept + 1 else np.full(len(d), np.inf)
        return Bounds(order[:, 0], root[:, 0] * UP, order[:, 1 : kept + 1], np.column_stack([root[:, 1 : kept + 1] * DOWN, rest]))

    def follow(self, vectors: np.ndarray, centroids: np.ndarray, moves: np.ndarray) -> int:
        """Assign anew after the centroids have moved; returns how many distances it took."""
        kept = self.near.shape[1]
        self.upper = (self.upper + moves[self.cluster]) * UP
        # a vector may rest on bounds of centroids that have moved up to ``moves`` each
        self.lower[:, :kept] = np.maximum(self.lower[:, :kept] - moves[self.near], 0) * DOWN
        self.lower[:, kept] = np.maximum(self.lower[:, kept] - moves.max(initial=0), 0) * DOWN
        tail = np.minimum.accumulate(self.lower[:, ::-1], axis=1)[:, ::-1]  # the least bound from the i-th on
        unsure = np.flatnonzero(self.upper >= tail[:, 0])
        own = np.sqrt(((vectors[unsure] - centroids[self.cluster[unsure]]) ** 2).sum(axis=1)) * UP
        self.upper[unsure] = own
        took = len(unsure)
        certain = self.upper[unsure, None] < tail[unsure]
        first = np.where(certain.any(axis=1), certain.argmax(axis=1), kept + 1)
        for i in range(1, kept + 1):
            at = unsure[first == i]
            if len(at):
                some = np.column_stack([self.cluster[at], self.near[at, :i]])
                d = ((vectors[at, None, :] - centroids[some]) ** 2).sum(axis=2)
                took += d.size - len(at)
                order = np.lexsort((some, d), axis=1)
                some, root = np.take_along_axis(some, order, 1), np.sqrt(np.take_along_axis(d, order, 1))
                self.cluster[at], self.upper[at] = some[:, 0], root[:, 0] * UP
                self.near[at, :i], self.lower[at, :i] = some[:, 1:], root[:, 1:] * DOWN
        at = unsure[first == kept + 1]
        if len(at):
            fresh = Bounds.scan(vectors[at], centroids, kept)
            took += len(at) * (len(centroids) - 1)
            self.cluster[at], self.upper[at], self.near[at], self.lower[at] = fresh.cluster, fresh.upper, fresh.near, fresh.lower
        return took


def cluster(vectors: DataFrame, *, k: int = 16, rounds: int = 3, dim: int = 64, scale: int = 64, kept: int | None = None) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 and the components of the centroid of each vector; ``kept`` bounds a vector (a quarter of k)."""
    spark = vectors.sparkSession
    kind = vectors.schema["vec_id"].dataType.simpleString()

    def numbers(batch: pa.RecordBatch) -> dict:
        at, x = whole_numbers(batch.column("embedding"), dim, scale)
        return {"vec_id": batch.column("vec_id").take(pa.array(at)), "vector": _binary(x.astype("<i4"))}

    with scope("centroids 1", spark):
        state = stage_table(map_texts(vectors.select("vec_id", "embedding"), numbers, f"vec_id {kind}, vector binary"), "vectors")
        first = state.orderBy(F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256).asc_nulls_last(), "vector").limit(k)
        centroids = np.array([np.frombuffer(r.vector, "<i4") for r in first.select("vector").collect()], np.int64).reshape(-1, dim)
    k = len(centroids)
    kept = max(1, k // 4) if kept is None else kept
    kept = min(kept, max(k - 1, 0))
    sums, counts = [[0] * dim for _ in range(k)], [0] * k
    before = centroids
    for turn in range(rounds):
        with scope(f"centroids {turn % 2}", spark):  # what the round before the last has written is deleted
            state = stage_table(_assign(state, kind, dim, kept, centroids, before), "state")
            for c, place, total in _changes(state, dim):
                if place < 0:
                    counts[c] += int(total)
                else:
                    sums[c][place] += int(total)
        before = centroids
        centroids = np.array([[s // n for s in own] if n else old for own, n, old in zip(sums, counts, before.tolist())], np.int64).reshape(-1, dim)
    final = _assign(state, kind, dim, kept, centroids, before)

    def measure(batch: pa.RecordBatch) -> dict:
        v, own = _matrix(batch.column("vector"), dim), batch.column("cluster").to_numpy()
        return {"vec_id": batch.column("vec_id"), "cluster": batch.column("cluster"), "distance": pa.array(((v - centroids[own]) ** 2).sum(axis=1), pa.int64())}

    found = stage_table(map_texts(final, measure, f"vec_id {kind}, cluster int, distance long"), "clusters")
    inertia = {c: int(d) for c, d in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect()}  # k rows
    told = [(c, d, sum(inertia.values()), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest(), centroids[c].tolist()) for c, d in inertia.items()]
    told = spark.createDataFrame(told, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string, centroid array<long>")
    return found.join(F.broadcast(told), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "centroid")


def _binary(x: np.ndarray) -> pa.Array:
    """A row of a matrix as one value each."""
    data = np.ascontiguousarray(x)
    return pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer((np.arange(len(x) + 1) * data.itemsize * data.shape[1]).astype(np.int32)), pa.py_buffer(data)])


def _matrix(column: pa.Array, width: int, kind: str = "<i4") -> np.ndarray:
    x = np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)
    return x.astype(np.int64) if kind == "<i4" else x.copy()


def _assign(state: DataFrame, kind: str, dim: int, kept: int, centroids: np.ndarray, before: np.ndarray) -> DataFrame:
    """The table of vectors and bounds after one more assignment; ``was`` is the cluster before it, ``scanned`` how many distances all vectors of a batch took."""
    known = "cluster" in state.columns
    moves = np.sqrt(((centroids - before) ** 2).sum(axis=1)) * UP if len(centroids) else np.zeros(0)

    def kernel(batch: pa.RecordBatch) -> dict:
        v = _matrix(batch.column("vector"), dim)
        if known:
            was = batch.column("cluster").to_numpy()
            bounds = _matrix(batch.column("bounds"), kept + 2, "<f8")
            own = Bounds(was.astype(np.int64), bounds[:, 0], _matrix(batch.column("near"), kept), bounds[:, 1:])
            took = own.follow(v, centroids, moves)
        else:
            was, took = np.full(len(v), -1), v.shape[0] * len(centroids)
            own = Bounds.scan(v, centroids, kept)
        return {
            "vec_id": batch.column("vec_id"), "vector": batch.column("vector"), "cluster": pa.array(own.cluster, pa.int32()), "was": pa.array(was, pa.int32()),
            "bounds": _binary(np.column_stack([own.upper, own.lower]).astype("<f8")), "near": _binary(own.near.astype("<i4")), "scanned": pa.array([took] + [0] * (len(v) - 1), pa.int64()),
        }

    return map_texts(state, kernel, f"vec_id {kind}, vector binary, cluster int, was int, bounds binary, near binary, scanned long")


def _changes(state: DataFrame, dim: int) -> list:
    """(cluster, place, total): what the vectors that changed cluster add to its sums; place -1 is their number. At most k times dim + 1 rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            v = np.column_stack([np.ones(batch.num_rows, np.int64), _matrix(batch.column("vector"), dim)])
            for sign, name in ((1, "cluster"), (-1, "was")):
                own = batch.column(name).to_numpy()
                for c in np.unique(own[own >= 0]).tolist():
                    total[c] = total.get(c, 0) + sign * v[own == c].sum(axis=0)
        for c, sums in total.items():
            yield pa.RecordBatch.from_pydict({"cluster": pa.array([c] * (dim + 1), pa.int32()), "place": pa.array(range(-1, dim), pa.int32()), "total": pa.array(sums)})

    bound_batches(state.sparkSession)
    moved = state.filter("cluster <> was").select("vector", "cluster", "was").mapInArrow(trimmed(run), "cluster int, place int, total long")
    return moved.groupBy("cluster", "place").agg(F.sum(F.col("total").cast("decimal(38,0)"))).collect()
