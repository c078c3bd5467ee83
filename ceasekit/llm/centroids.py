"""Operator 13: centroid clustering on integer vectors, with centroids filtered by N-simplex projection.

Distances of each vector to a few pivots (some of the first centroids) are taken once and become the
vector's apex coordinates: its place in the hull of the pivots, and its altitude over that hull. They are
written once and serve every round, as the pivots do not move. For two points with the base coordinates
a, b and the altitudes g, h the squared distance lies between |a - b|^2 + (g - h)^2 and
|a - b|^2 + (g + h)^2; centroids whose lower bound exceeds the least upper bound, or the exact distance
of the centroid with the least lower bound, are left out, and the others are compared by exact integer
distances. A margin far above the rounding of the bounds keeps the result exact.

A round is one pass over the written vectors. Tasks hand on sums per cluster, so copies of one vector or
a cluster with a third of all rows cost nothing more; the driver gets the sums of k clusters, never rows.

Defined cases: vectors that are null, of another length, or with null, NaN or infinite components are
left out; rows with a null id are hashed as an empty id; repeated rows count each; first centroids with
equal hashes are taken in the order of their components; with fewer vectors than clusters there are
fewer clusters; components of any size are exact, a squared distance or sum beyond a long is null;
other columns are not used; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ceasekit.llm.common import landed, table

CLUSTERS, ROUNDS, DIMS, SCALE, SEED = 40, 5, 64, 256, 2
PIVOTS = 12                 # at most; those that add no altitude are left out
SLICE = 4096                # vectors assigned at once
SMALL = 1 << 20             # components up to this have exact squared distances in double precision
HUGE = float(1 << 40)       # beyond this no bounds are taken
MARGIN = 1e-5               # of the squared distances to the first pivot
FLAT = 1e-3                 # a pivot's altitude, relative to the first edge, below which it is left out
LONG = (1 << 63) - 1
LIMB = 40                   # bits of the parts of sums beyond a long


def integer(x: float, scale: int = SCALE) -> int:
    """floor(scale * x) of a finite number, also where the product is beyond a double."""
    y = x * scale
    return math.floor(y) if math.isfinite(y) else int(x) * scale


class Simplex(NamedTuple):
    """Pivots and the triangular coordinates of all but the first, with the first at the origin."""
    pivots: np.ndarray
    lower: np.ndarray

    def apex(self, x: np.ndarray) -> np.ndarray:
        """Rows x pivots: base coordinates and the altitude, from the distances to the pivots."""
        d2 = np.maximum((x ** 2).sum(axis=1)[:, None] + (self.pivots ** 2).sum(axis=1)[None, :] - 2 * x @ self.pivots.T, 0)
        edge2 = (self.lower ** 2).sum(axis=1)
        base = np.linalg.solve(self.lower, ((d2[:, :1] + edge2 - d2[:, 1:]) / 2).T).T if len(self.lower) else np.empty((len(x), 0))
        altitude = np.sqrt(np.maximum(d2[:, 0] - (base ** 2).sum(axis=1), 0))
        return np.column_stack([base, altitude])


def simplex(points: np.ndarray, n: int) -> Simplex:
    """Up to ``n`` of the points as pivots: the first, then always the one of greatest altitude."""
    chosen, lower, found = [0], np.empty((0, 0)), None
    while True:
        found = Simplex(points[chosen], lower)
        apex = found.apex(points)
        far = int(np.argmax(apex[:, -1]))
        first_edge = lower[0, 0] if len(lower) else apex[far, -1]
        if len(chosen) == min(n, len(points)) or apex[far, -1] <= FLAT * first_edge:
            return found
        chosen.append(far)
        grown = np.zeros((len(lower) + 1, len(lower) + 1))
        grown[:-1, :-1] = lower
        grown[-1] = apex[far]
        lower = grown


def bounds(apex: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows x centroids: lower bounds of the squared distances; per row the least upper bound. Without finite
    coordinates the lower bound is 0 and the upper one infinite."""
    with np.errstate(invalid="ignore", over="ignore"):
        sizes = (apex[:, :-1] ** 2).sum(axis=1)[:, None] + (centres[:, :-1] ** 2).sum(axis=1)[None, :]
        base = np.maximum(sizes - 2 * apex[:, :-1] @ centres[:, :-1].T, 0)
        g, h = apex[:, -1:], centres[None, :, -1]
        slack = MARGIN * ((apex ** 2).sum(axis=1)[:, None] + (centres ** 2).sum(axis=1)[None, :]) + 1
        lower, upper = base + (g - h) ** 2 - slack, base + (g + h) ** 2 + slack
        return np.where(np.isfinite(lower), lower, 0), np.where(np.isfinite(upper), upper, np.inf).min(axis=1)


class Centres:
    """Centroids as exact integers, with the coordinates of those that bounds can be taken for."""

    def __init__(self, rows: list[list[int]], pivots: Simplex):
        self.rows = rows
        size = np.array([max(abs(x) for x in r) for r in rows], dtype=object)
        self.small = (size <= SMALL).astype(bool)
        bounded = (size <= int(HUGE)).astype(bool)
        self.x = np.array([[float(v) if ok else np.nan for v in r] for r, ok in zip(rows, bounded, strict=True)])
        self.apex = pivots.apex(self.x)

    def assign(self, x: np.ndarray, apex: np.ndarray, scale: int) -> tuple[np.ndarray, list[int], int]:
        """Nearest centroid and exact squared distance of each vector, and the pairs compared exactly."""
        with np.errstate(over="ignore"):
            v = np.floor(x * scale)
        own_small = np.abs(v).max(axis=1) <= SMALL
        lower, least = bounds(apex, self.apex)
        guess = lower.argmin(axis=1)                # its exact distance is an upper bound too
        sure = np.nonzero(own_small & self.small[guess])[0]
        least[sure] = np.minimum(least[sure], ((v[sure] - self.x[guess[sure]]) ** 2).sum(axis=1))
        mask = lower <= least[:, None]
        fast = own_small & ~(mask & ~self.small).any(axis=1)
        d2 = np.full(mask.shape, np.inf)
        own = (np.where(own_small[:, None], v, 0) ** 2).sum(axis=1)
        for j in np.nonzero((mask & fast[:, None]).any(axis=0))[0].tolist():         # whole numbers below 2^53 throughout
            rows = np.nonzero(mask[:, j] & fast)[0]
            near = v[rows] @ self.x[j] if 4 * len(rows) < len(v) else (v @ self.x[j])[rows]
            d2[rows, j] = own[rows] + (self.x[j] ** 2).sum() - 2 * near
        cluster = d2.argmin(axis=1)
        distance = np.where(fast, d2[np.arange(len(x)), cluster], 0).astype(np.int64).tolist()
        for r in np.nonzero(~fast)[0].tolist():
            own = [integer(y, scale) for y in x[r].tolist()]
            distance[r], cluster[r] = min((sum((a - b) ** 2 for a, b in zip(own, self.rows[c], strict=True)), c)
                                          for c in np.nonzero(mask[r])[0].tolist())
        return cluster, distance, int(mask.sum())


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A column of arrays of one length as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), width)


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for s in range(0, len(b), SLICE):
            yield b.slice(s, SLICE)


def projector(pivots: Simplex, scale: int, dims: int):
    """Adds the apex coordinates; NaN where a component is too large for bounds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            with np.errstate(over="ignore"):
                v = np.floor(matrix(b.column("_vec"), dims) * scale)
            v[np.abs(v).max(axis=1) > HUGE] = np.nan
            apex = pivots.apex(v)
            ends = pa.array(np.arange(0, apex.size + 1, apex.shape[1], dtype=np.int32))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.ListArray.from_arrays(ends, pa.array(apex.ravel()))],
                                             names=[*b.schema.names, "_apex"])
    return run


def limbs(total: int) -> Iterator[tuple[int, int]]:
    """A sum as (limb, part) with total = sum of part * 2^(LIMB * limb), each part a long."""
    at = 0
    while not -(1 << 62) < total < 1 << 62:
        yield at, total & ((1 << LIMB) - 1)
        total, at = total >> LIMB, at + 1
    yield at, total


def summer(centres: Centres, scale: int, dims: int):
    """Per task: (cluster, component, limb, part) of the sums of its vectors; component -1 is their number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(centres.rows)
        counts, sums, large = np.zeros(k, np.int64), np.zeros((k, dims), np.int64), {}
        for b in slices(batches):
            x = matrix(b.column("_vec"), dims)
            cluster, _, _ = centres.assign(x, matrix(b.column("_apex"), len(centres.apex[0])), scale)
            counts += np.bincount(cluster, minlength=k)
            with np.errstate(over="ignore"):
                v = np.floor(x * scale)
            small = np.abs(v).max(axis=1) <= SMALL
            one_hot = np.zeros((k, len(x)))
            one_hot[cluster[small], np.nonzero(small)[0]] = 1
            sums += (one_hot @ np.where(small[:, None], v, 0)).astype(np.int64)
            for r in np.nonzero(~small)[0].tolist():
                old = large.get(int(cluster[r]), [0] * dims)
                large[int(cluster[r])] = [a + integer(y, scale) for a, y in zip(old, x[r].tolist(), strict=True)]
        rows = [(c, -1, 0, int(counts[c])) for c in range(k) if counts[c]]
        for c in range(k):
            for at in range(dims if counts[c] else 0):
                total = int(sums[c, at]) + (large[c][at] if c in large else 0)
                rows += [(c, at, limb, part) for limb, part in limbs(total)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(col, t) for col, t in zip(zip(*rows, strict=True), (
                pa.int32(), pa.int32(), pa.int32(), pa.int64()), strict=True)], names=["cluster", "at", "limb", "part"])
    return run


def assigner(centres: Centres, scale: int, dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            cluster, distance, _ = centres.assign(matrix(b.column("_vec"), dims), matrix(b.column("_apex"), len(centres.apex[0])), scale)
            yield pa.RecordBatch.from_arrays([b.column("_id"), pa.array(cluster, pa.int32()),
                                              pa.array([d if d <= LONG else None for d in distance], pa.int64())], names=["_id", "cluster", "distance"])
    return run


def moved(rows: DataFrame, centres: Centres, scale: int, dims: int) -> list[list[int]]:
    """The centroids after one round: exact floor of each mean; those without a vector stay."""
    parts = rows.mapInArrow(summer(centres, scale, dims), "cluster int, at int, limb int, part long")
    totals = parts.groupBy("cluster", "at", "limb").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("part"))
    sums: dict = {}
    for r in totals.collect():              # k x (dims + 1) rows, more only for components beyond 2^62
        sums[r.cluster, r["at"]] = sums.get((r.cluster, r["at"]), 0) + (int(r.part) << (LIMB * r.limb))
    return [[sums[c, at] // sums[c, -1] for at in range(dims)] if (c, -1) in sums else old for c, old in enumerate(centres.rows)]


def integer_kmeans(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", k: int = CLUSTERS, rounds: int = ROUNDS,
                   dims: int = DIMS, scale: int = SCALE, seed: int = SEED, pivots: int = PIVOTS) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of each vector of ``dims`` components."""
    vec = F.col(f"`{vector}`").cast("array<double>")
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = vectors.where(F.coalesce((F.size(vec) == dims) & ~bad, F.lit(False))).select(F.col(f"`{id_col}`").alias("_id"), vec.alias("_vec"))
    kind = kept.schema["_id"].dataType.simpleString()
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("_id").cast("string"), F.lit(""))).cast("binary"), 256)
    first = [[integer(x, scale) for x in r["_vec"]] for r in kept.orderBy(hashed, "_vec").limit(k).select("_vec").collect()]
    shape = "cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    if not first:
        return vectors.sparkSession.createDataFrame([], f"_id {kind}, {shape}").withColumnRenamed("_id", id_col)
    bounded = [r for r in first if max(map(abs, r)) <= int(HUGE)] or [[0] * dims]
    base = simplex(np.array(bounded, dtype=np.float64), pivots)
    rows = landed(kept.mapInArrow(projector(base, scale, dims), f"_id {kind}, _vec array<double>, _apex array<double>"), "apex")
    centres = Centres(first, base)
    for _ in range(rounds):
        following = moved(rows, centres, scale, dims)
        if following == centres.rows:       # further rounds would change nothing
            break
        centres = Centres(following, base)
    out = landed(rows.mapInArrow(assigner(centres, scale, dims), f"_id {kind}, cluster int, distance bigint"), "clusters")
    total = F.sum(F.col("distance").cast("decimal(38,0)"))
    got = out.groupBy("cluster").agg(F.when(F.count("distance") == F.count("*"), total).alias("total")).collect()      # k rows at most
    sums = {r.cluster: None if r.total is None else int(r.total) for r in got}
    overall = None if None in sums.values() else sum(sums.values())

    def as_long(x: int | None):
        return F.lit(None if x is None or x > LONG else x).cast("bigint")

    digests = [hashlib.sha256(",".join(map(str, r)).encode()).hexdigest() for r in centres.rows]
    return out.select(F.col("_id").alias(id_col), "cluster", "distance",
                      F.get(F.array(*[as_long(sums.get(c, 0)) for c in range(len(digests))]), F.col("cluster")).alias("cluster_inertia"),
                      as_long(overall).alias("inertia"), F.get(F.array(*map(F.lit, digests)), F.col("cluster")).alias("centroid_sha256"))


def op13_centroids(spark, sf_dir: str) -> DataFrame:
    return integer_kmeans(table(spark, sf_dir, "embeddings"))


def _sql_round(n: int) -> str:
    """One round in SQL: assignment a{n} to the centroids c{n}, then the centroids c{n+1}."""
    return f"""
a{n} AS (
  SELECT r, any_value(k.v) AS v, min({{'d': list_sum(list_transform(list_zip(k.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), 'c': c.c}}) AS best
  FROM kept k CROSS JOIN c{n} c GROUP BY r
), s{n} AS (
  SELECT c, pos, sum(x) AS s, count(*) AS n
  FROM (SELECT best.c AS c, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM a{n}) GROUP BY c, pos
), m{n} AS (
  SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY pos) AS v FROM s{n} GROUP BY c
), c{n + 1} AS (
  SELECT o.c, coalesce(m.v, o.v) AS v FROM c{n} o LEFT JOIN m{n} m ON o.c = m.c
)"""


OP13_SQL = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v
  FROM (SELECT sha256('2:' || coalesce(vec_id::VARCHAR, '')) AS h, v FROM kept ORDER BY h, v LIMIT 40)
),{','.join(_sql_round(n) for n in range(ROUNDS + 1))}
SELECT k.vec_id, a.best.c::INTEGER AS cluster, a.best.d::BIGINT AS distance,
       sum(a.best.d) OVER (PARTITION BY a.best.c)::BIGINT AS cluster_inertia, sum(a.best.d) OVER ()::BIGINT AS inertia,
       sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{ROUNDS} a JOIN kept k ON k.r = a.r JOIN c{ROUNDS} c ON c.c = a.best.c
"""
