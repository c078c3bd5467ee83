"""Operator 12: nearest neighbours by a block matrix join.

Distinct query vectors and distinct candidate vectors are dealt into blocks by hash; each cell of the
block grid is one shuffle partition with its queries first and its candidates streamed after them.
Vectors of length 1 are coded as int8 with a scale of their own, and integer product tiles (float32
matrix products of integers below 2^24 are exact) give every cosine with a bound of its quantisation
error: |u.v - u'.v'| <= |u'| |v - v'| + |u - u'|. Pairs whose upper bound reaches the query's current
k-th best are recomputed in double precision from the original vectors and pushed on the query's heap.
The heaps of a query's cells are merged at the end, so the result is exact.

A task holds one block of queries (``QUERY_COMPONENTS``) and a slice of candidates, whatever the size of
the table. Queries travel once per candidate block and candidates once per query block; the work grows
with queries x candidates. Nothing is broadcast or collected.

Equal vectors are one candidate: only the k + 1 least ids of a vector can be among the nearest, so a
partial limit keeps those before the shuffle, exactly, whatever the number of copies; equal queries are
searched once.

Defined cases: vectors that are null, empty, zero or hold null, NaN or infinite components, and rows
with a null id, take no part; vectors of different length are not compared; rows equal in id and
vector are one row; an id with several vectors is a row and a query per vector; ties go to the smaller
id; with fewer than k candidates all are returned; -0.0 equals 0.0; other columns are not used; ids
must be whole numbers, any other type is refused; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ceasekit.llm.common import table

K = 5
EVERY = 50                          # ids divisible by this are the queries
QUERY_COMPONENTS = 8 << 20          # of a block of queries, held by one task (131,072 vectors of 64)
CANDIDATE_COMPONENTS = 64 << 20     # of a block of candidates, streamed through one task
TILE = 2048                         # candidates, and queries, of one product tile
PAIRS = 1 << 22                     # components recomputed in float at once
EXACT_DIMS = 1024                   # 127^2 * 1024 < 2^24: such sums are exact in float32
SLACK = 1e-6                        # above the rounding of the scaled float32 tile


def usable(vector: Column) -> Column:
    """Whether a vector has a direction: not null or empty, all components finite, one not zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vector) > 0) & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def prepared(df: DataFrame, id_col: str, vector: str) -> DataFrame:
    """(_id, _vec): usable rows, components as float or double, without negative zeros."""
    kind = df.schema[vector].dataType.elementType.simpleString()
    kind = kind if kind in ("float", "double") else "double"
    vec = F.transform(F.col(f"`{vector}`").cast(f"array<{kind}>"), lambda x: x + F.lit(0).cast(kind))
    return df.select(F.col(f"`{id_col}`").alias("_id"), vec.alias("_vec")).where(F.col("_id").isNotNull() & usable(F.col("_vec")))


def key_of(vector: Column) -> Column:
    """Digest of a vector: equal vectors have equal keys."""
    return F.unhex(F.sha2(F.array_join(F.transform(vector, lambda x: x.cast("string")), ",").cast("binary"), 256))


def least_ids(rows: DataFrame, n: int) -> DataFrame:
    """(_vec, _ids): of each distinct vector the ``n`` least distinct ids. The rank limit is applied in each
    map task before the shuffle, so copies of one vector do not meet in one task."""
    same = Window.partitionBy(F.xxhash64("_vec"), "_vec").orderBy("_id")
    few = rows.withColumn("_rank", F.dense_rank().over(same)).where(F.col("_rank") <= n)
    return few.groupBy(F.xxhash64("_vec").alias("_hash"), "_vec").agg(F.sort_array(F.collect_set("_id")).alias("_ids"))


class Coded:
    """Vectors of one length with their int8 codes, scales and error bounds."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        n = len(vectors)
        self.codes = np.empty(vectors.shape, np.int8)
        self.scale, self.error, self.length = np.empty(n, np.float32), np.empty(n), np.empty(n)
        for s in range(0, n, TILE):
            unit = scaled(vectors[s:s + TILE])
            unit /= np.sqrt((unit * unit).sum(axis=1))[:, None]
            scale = np.abs(unit).max(axis=1) / 127
            scale32 = scale.astype(np.float32)
            codes = np.clip(np.rint(unit / scale32[:, None]), -127, 127)
            back = codes * scale32.astype(np.float64)[:, None]
            self.codes[s:s + TILE] = codes
            self.scale[s:s + TILE] = scale32
            self.error[s:s + TILE] = np.sqrt(((unit - back) ** 2).sum(axis=1))
            self.length[s:s + TILE] = np.sqrt((back ** 2).sum(axis=1))


def scaled(vectors: np.ndarray) -> np.ndarray:
    """In double precision, each vector times a power of two, so that no square over- or underflows."""
    x = vectors.astype(np.float64)
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``a`` with the same row of ``b``, in double precision."""
    a, b = scaled(a), scaled(b)
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def tile(q: Coded, at: slice, c: Coded) -> tuple[np.ndarray, np.ndarray]:
    """Approximate cosines of some queries with a slice of candidates, and the bounds of their errors."""
    dims = q.codes.shape[1]
    products = sum(q.codes[at, s:s + EXACT_DIMS].astype(np.float32) @ c.codes[:, s:s + EXACT_DIMS].astype(np.float32).T
                   for s in range(0, dims, EXACT_DIMS))
    products *= q.scale[at, None]
    products *= c.scale[None, :]
    error = q.length[at, None].astype(np.float32) * c.error[None, :].astype(np.float32)
    error += (q.error[at, None] + SLACK).astype(np.float32)
    return products, error


class Block:
    """A block of queries of one length: their codes, and a heap of the best (score, -id) of each."""

    def __init__(self, keys: list[bytes], vectors: np.ndarray, keep: int):
        self.keys, self.keep, self.q = keys, keep, Coded(vectors)
        self.heaps: list[list] = [[] for _ in keys]
        self.least = np.full(len(keys), -np.inf)        # a score below this cannot be among the best

    def meet(self, ids: list[list[int]], vectors: np.ndarray) -> None:
        c = Coded(vectors)
        for s in range(0, len(self.keys), TILE):
            at = slice(s, min(s + TILE, len(self.keys)))
            near, error = tile(self.q, at, c)
            if len(vectors) >= self.keep and np.isneginf(self.least[at]).any():
                lower = np.partition(near - error, -self.keep, axis=1)[:, -self.keep]       # by distinct vectors
                self.least[at] = np.maximum(self.least[at], lower)
            near += error
            rows, cols = np.nonzero(near >= self.least[at, None])
            step = max(1, PAIRS // vectors.shape[1])
            for p in range(0, len(rows), step):
                i, j = rows[p:p + step] + s, cols[p:p + step]
                self.push(i, j, cosines(self.q.vectors[i], vectors[j]), ids)

    def push(self, i: np.ndarray, j: np.ndarray, scores: np.ndarray, ids: list[list[int]]) -> None:
        for query, candidate, score in zip(i.tolist(), j.tolist(), scores.tolist(), strict=True):
            heap = self.heaps[query]
            if len(heap) == self.keep and score < heap[0][0]:
                continue
            for vec_id in ids[candidate]:
                if len(heap) < self.keep:
                    heapq.heappush(heap, (score, -vec_id))
                else:
                    heapq.heappushpop(heap, (score, -vec_id))
            if len(heap) == self.keep:
                self.least[query] = max(self.least[query], heap[0][0])

    def results(self) -> Iterator[tuple[bytes, list[float], list[int]]]:
        for key, heap in zip(self.keys, self.heaps, strict=True):
            best = sorted(heap, reverse=True)
            yield key, [s for s, _ in best], [-i for _, i in best]


def by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix) for each vector length of a batch."""
    starts = column.offsets.to_numpy().astype(np.int64)
    sizes, values = np.diff(starts), column.values.to_numpy(zero_copy_only=False)
    for d in np.unique(sizes):
        rows = np.nonzero(sizes == d)[0]
        yield rows, values[starts[rows][:, None] + np.arange(d)]


RESULT = pa.schema([("_key", pa.binary()), ("_scores", pa.list_(pa.float64())), ("_ids", pa.list_(pa.int64()))])


def as_batches(results: Iterator[tuple], rows: int = 5000) -> Iterator[pa.RecordBatch]:
    results = iter(results)
    while part := list(itertools.islice(results, rows)):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part, strict=True), RESULT.types, strict=True)], schema=RESULT)


def cells(keep: int):
    """Rows sorted by cell, queries before candidates -> per cell and query its best candidates."""
    def closed(blocks: dict) -> Iterator[pa.RecordBatch]:
        for block in blocks.values():
            yield from as_batches(r for r in block.results() if r[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, waiting, blocks = None, {}, {}
        for b in batches:
            number = b.column("_cell").to_numpy()
            query = b.column("_key").is_valid().to_numpy(zero_copy_only=False)
            cuts = np.nonzero((np.diff(number) != 0) | (np.diff(query.astype(np.int8)) != 0))[0] + 1
            for lo, hi in itertools.pairwise([0, *cuts.tolist(), len(b)]):
                if lo == hi:
                    continue
                if number[lo] != cell:
                    yield from closed(blocks)
                    cell, waiting, blocks = number[lo], {}, {}
                part = b.slice(lo, hi - lo)
                if query[lo]:
                    for rows, x in by_length(part.column("_vec")):
                        waiting.setdefault(x.shape[1], []).append(([part.column("_key")[r].as_py() for r in rows.tolist()], x))
                    continue
                while waiting:
                    d, parts = waiting.popitem()
                    blocks[d] = Block([k for keys, _ in parts for k in keys], np.concatenate([x for _, x in parts]), keep)
                for rows, x in by_length(part.column("_vec")):
                    if x.shape[1] in blocks:
                        ids = part.column("_ids").take(pa.array(rows)).to_pylist()
                        for s in range(0, len(x), TILE):
                            blocks[x.shape[1]].meet(ids[s:s + TILE], x[s:s + TILE])
        yield from closed(blocks)
    return run


def merged(keep: int):
    """Rows sorted by query -> the best of each query over all its cells."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for b in batches:
            yield from zip(*(c.to_pylist() for c in b.columns), strict=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def best() -> Iterator[tuple]:
            for key, group in itertools.groupby(rows(batches), key=lambda r: r[0]):
                lists = [[(-s, i) for s, i in zip(scores, ids, strict=True)] for _, scores, ids in group]
                top = list(itertools.islice(heapq.merge(*lists), keep))
                yield key, [-s for s, _ in top], [i for _, i in top]
        yield from as_batches(best())
    return run


def nearest(queries: DataFrame, candidates: DataFrame, k: int = K, id_col: str = "vec_id", vector: str = "embedding",
            query_components: int = QUERY_COMPONENTS, candidate_components: int = CANDIDATE_COMPONENTS) -> DataFrame:
    """(query_id, rank, vec_id, score): of each query its ``k`` nearest candidates by cosine, its own id left out."""
    for df in (queries, candidates):
        if not isinstance(df.schema[id_col].dataType, T.IntegralType):
            raise TypeError(f"{id_col} must be a whole number")
    spark = queries.sparkSession
    asked, given = prepared(queries, id_col, vector), prepared(candidates, id_col, vector)
    size = [df.agg(F.sum(F.size("_vec").cast("long"))).first()[0] or 0 for df in (asked, given)]
    n_q = max(1, -(-size[0] // query_components))
    n_c = max(1, -(-size[1] // candidate_components), -(-2 * spark.sparkContext.defaultParallelism // n_q))
    asked = asked.withColumn("_key", key_of(F.col("_vec")))
    asking = asked.select(F.col("_id").cast("bigint").alias("query_id"), "_key").distinct()

    def numbers(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    q = asked.groupBy("_key").agg(F.any_value("_vec").alias("_vec"))        # equal keys, equal vectors
    q = q.select("_key", "_vec", F.lit(None).cast("array<bigint>").alias("_ids"), F.pmod(F.xxhash64("_key"), F.lit(n_q)).alias("_q"),
                 numbers(n_c).alias("_c"))
    c = least_ids(given.withColumn("_id", F.col("_id").cast("bigint")), k + 1)
    c = c.select(F.lit(None).cast("binary").alias("_key"), "_vec", "_ids", numbers(n_q).alias("_q"), F.pmod("_hash", F.lit(n_c)).alias("_c"))
    both = q.unionByName(c).select((F.col("_q") * n_c + F.col("_c")).cast("int").alias("_cell"), "_key", "_vec", "_ids")
    dealt = both.repartitionById(n_q * n_c, F.col("_cell")).sortWithinPartitions("_cell", F.col("_key").isNull())
    shape = "_key binary, _scores array<double>, _ids array<bigint>"
    found = dealt.mapInArrow(cells(k + 1), shape).repartition("_key").sortWithinPartitions("_key").mapInArrow(merged(k + 1), shape)
    pairs = F.arrays_zip(F.col("_ids").alias("vec_id"), F.col("_scores").alias("score"))
    best = asking.join(found.select("_key", pairs.alias("_best")), "_key")
    own = F.array_position(F.transform("_best", lambda b: b["vec_id"]), F.col("query_id"))      # its own row comes first of its id
    others = F.slice(F.filter("_best", lambda b, i: i + 1 != own), 1, k)
    ranked = best.select("query_id", F.posexplode(others).alias("_at", "_pair"))
    return ranked.select("query_id", (F.col("_at") + 1).alias("rank"), F.col("_pair.vec_id").alias("vec_id"), F.col("_pair.score").alias("score"))


def op12_nearest_neighbours(spark, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors.where(F.col("vec_id") % EVERY == 0), vectors)


OP12_SQL = """
WITH usable AS (
  SELECT DISTINCT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), sized AS (
  SELECT *, sqrt(list_dot_product(v, v)) AS norm FROM usable
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v) / (q.norm * c.norm) AS score
  FROM sized q JOIN sized c ON len(q.v) = len(c.v) AND (q.vec_id <> c.vec_id OR q.v <> c.v)
  WHERE q.vec_id % 50 = 0
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM pairs
QUALIFY rank <= 5
"""
