"""Second-order boosted trees on binned features, grown level by level from histograms on Spark.

The rows are binned once (quantile cuts, bin 0 for a missing value) and written with a margin per
model. Each level of a tree is one job: every task adds up gradients and hessians per (model, node,
feature, bin) of the left children, and only these sums are reduced, on the executors, their number fixed by
the depth and the bins; a right child is its parent less the left one. The driver is sent one reduced copy and
picks the split of each node from it; no row reaches it. Where the rows fill one task only,
that task grows a block of trees by itself, from the same sums. Several models (one per
cross-validation fold) share a pass, as a further key of the same histogram.

After a block of trees the margins are advanced and written again, so lineage stays short, training
goes on from the written column, and nothing is trained twice. The iterations run on cached blocks of
rows (an RDD): a plan per level would cost more than the level.

Gradients are summed as integers (fixed point), so the trees do not depend on partitioning or on
the order of tasks.
"""

from __future__ import annotations

import itertools
import sys
import zlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ceasekit.sources.io import scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])      # executors need not have the package

MAX_BINS = 255                  # of values, per feature; bin 0 is the missing value
EXACT_VALUES = 200              # features with about this many values at most are cut at each of them
BLOCK = 30                      # trees between two writings of the margins, at most
ROWS_PER_TASK = 65_536
REDUCERS = 4                    # tasks that reduce the sums of a level
LAMBDA = 1.0                    # L2 on leaf weights
LEAST_GAIN = 1e-6
STATE = "key long, part string, fold int, y int, bins binary, margins array<double>"


@dataclass(frozen=True)
class TreeParams:
    depth: int = 5
    learning_rate: float = 0.05
    row_sample: float = 0.8
    column_sample: float = 0.8          # per tree
    min_child_weight: float = 5.0       # hessian of a child
    l1: float = 0.1                     # on leaf weights
    positive_weight: float = 1.0
    seed: int = 42


@dataclass
class Tree:
    """Nodes in heap order: children of n are 2n + 1 and 2n + 2; feature -1 is a leaf."""
    feature: np.ndarray
    cut: np.ndarray                     # bins up to this go left
    missing_left: np.ndarray
    value: np.ndarray                   # the leaf's margin, learning rate included
    gain: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        n = 2 ** (depth + 1) - 1
        return cls(np.full(n, -1, np.int32), np.zeros(n, np.int32), np.zeros(n, bool), np.zeros(n), np.zeros(n))

    def arrays(self) -> tuple:
        return self.feature, self.cut, self.missing_left, self.value

    @property
    def nodes(self) -> int:
        return 1 + 2 * int((self.feature >= 0).sum())


def route(bins: np.ndarray, tree: tuple, levels: int) -> np.ndarray:
    """Node of each row after ``levels`` levels."""
    feature, cut, missing_left, _ = tree
    node, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
    for _ in range(levels):
        f = feature[node]
        b = bins[rows, np.maximum(f, 0)]
        left = np.where(b == 0, missing_left[node], b <= cut[node])
        node = np.where(f >= 0, 2 * node + 2 - left, node)
    return node


def quantile_cuts(df: DataFrame, features: Sequence[str]) -> list[np.ndarray]:
    """Cut points of each feature: each value but the least where there are few, else quantiles. The columns
    are turned into (feature, value) rows, so one aggregate serves any number of features."""
    long = df.select(F.posexplode(F.array(*[F.col(f"`{f}`").cast("double") for f in features])).alias("f", "v")).where("NOT isnan(v)")
    shares = F.array(*[F.lit(i / (MAX_BINS - 1)) for i in range(MAX_BINS)])
    first = {r.f: r for r in long.groupBy("f").agg(F.approx_count_distinct("v", 0.02).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"),
                                                   F.percentile_approx("v", shares, 10_000).alias("q")).collect()}
    few = [f for f, r in first.items() if 2 < r.n <= EXACT_VALUES]
    exact = {r.f: r.v for r in long.where(F.col("f").isin(few)).groupBy("f").agg(F.collect_set("v").alias("v")).collect()} if few else {}

    def values(f: int) -> list[float]:
        r = first.get(f)
        return [] if r is None else exact[f] if f in exact else [r.low, r.high] if r.n <= 2 else r.q

    return [np.unique(np.array(values(f), dtype=np.float64))[1:][:MAX_BINS - 1] for f in range(len(features))]


def binned(x: np.ndarray, cuts: Sequence[np.ndarray]) -> np.ndarray:
    """Rows x features of bin numbers: 0 missing, 1 below the first cut."""
    out = np.zeros(x.shape, np.uint8)
    for f, c in enumerate(cuts):
        known = ~np.isnan(x[:, f])
        out[known, f] = 1 + np.searchsorted(c, x[known, f], side="right")
    return out


def values_of(df: DataFrame, features: Sequence[str]) -> Column:
    return F.array(*[F.col(f"`{f}`").cast("double") for f in features]).alias("_x")


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """An array column as rows, nulls as NaN."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), width)


def byte_matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), width)


def first_state(rows: DataFrame, features: Sequence[str], cuts: Sequence[np.ndarray], models: int) -> DataFrame:
    """The written training table: one row per row of ``rows`` (key, part, fold, y and the features)."""
    width = len(features)

    def bin_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bins = binned(matrix(b.column("_x"), width), cuts)
            raw = pa.array([r.tobytes() for r in bins], pa.binary())
            margins = pa.ListArray.from_arrays(pa.array(np.arange(0, models * len(b) + 1, models, dtype=np.int32)), pa.array(np.zeros(models * len(b))))
            yield pa.RecordBatch.from_arrays([b.column(c) for c in ("key", "part", "fold", "y")] + [raw, margins],
                                             names=["key", "part", "fold", "y", "bins", "margins"])

    return written(rows.select("key", "part", "fold", "y", values_of(rows, features)).mapInArrow(bin_rows, STATE), "boosting")


def written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


Members = Callable[[np.ndarray, np.ndarray], np.ndarray]        # (part, fold) -> models x rows: in the model's training rows


def blocks_of(state: DataFrame, width: int, models: int, members: Members, n_rows: int, offsets: np.ndarray, common: np.ndarray) -> RDD:
    """The written rows as blocks of arrays, one per Arrow batch: bins, and the cells that are not the most common
    one of their feature."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, b.schema) as w:
                w.write_batch(b)
            yield pa.RecordBatch.from_arrays([pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["block"])

    def unpack(row) -> dict:
        b = pa.ipc.open_stream(bytes(row.block)).read_all().combine_chunks().to_batches()[0]
        bins = byte_matrix(b.column("bins"), width)
        part, fold = b.column("part").to_numpy(zero_copy_only=False), b.column("fold").to_numpy(zero_copy_only=False)
        at, f = np.nonzero(bins != common)
        return {"at": at.astype(np.int32), "cell": (offsets[f] + bins[at, f]).astype(np.int32), "key": b.column("key").to_numpy().astype(np.uint64), "y": b.column("y").to_numpy().astype(np.float64), "bins": bins,
                "margins": matrix(b.column("margins"), models).T.copy(), "members": members(part, fold)}

    tasks = max(1, -(-n_rows // ROWS_PER_TASK))
    return state.mapInArrow(pack, "block binary").coalesce(tasks).rdd.map(unpack)


def sampled(key: np.ndarray, seed: int, tree: int, share: float) -> np.ndarray:
    """Rows in the tree's sample: a 64-bit mix of the row's key, the seed and the tree."""
    with np.errstate(over="ignore"):
        z = key + np.uint64((seed * 1_000_003 + tree + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z ^= z >> np.uint64(31)
    return (z >> np.uint64(11)).astype(np.float64) / 2.0 ** 53 < share


def gradients(margin: np.ndarray, y: np.ndarray, p: TreeParams, unit: float) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivative of the weighted logistic loss, in whole multiples of 1 / unit."""
    prob = 1.0 / (1.0 + np.exp(-margin))
    w = np.where(y == 1, p.positive_weight, 1.0)
    return np.rint((prob - y) * w * unit), np.rint(np.maximum(prob * (1 - prob), 1e-16) * w * unit)


def with_tree(block: dict, trees: list[tuple], depth: int) -> dict:
    """The block with its margins after one more tree of each model."""
    added = np.stack([t[3][route(block["bins"], t, depth)] for t in trees])
    return block | {"margins": block["margins"] + added}


def counted(level: int) -> int:
    """Nodes of a level whose sums are added up."""
    return max(1, 2 ** level // 2)


def with_siblings(left: np.ndarray, above: np.ndarray | None, growing: list[tuple], level: int) -> np.ndarray:
    """The sums of all nodes of a level from those of the left children and of the level above, in whole numbers. A
    node that was not split has no children: both stay 0."""
    if not level:
        return left
    first = 2 ** (level - 1) - 1
    split = np.stack([t[0][first:first + left.shape[1]] >= 0 for t in growing])[:, :, None, None]
    return np.stack([left, np.where(split, above - left, 0)], axis=2).reshape(len(growing), 2 ** level, *left.shape[2:])


def level_sums(block: dict, growing: list[tuple], tree: int, level: int, cells: int, p: TreeParams, unit: float) -> np.ndarray:
    """models x left children of the level (the root on level 0) x (cells + 1) x 2: sums of gradient and hessian;
    the last cell is the node's total. Each feature's most common bin is left out: it is the total less the others."""
    bins, at, cell, nodes = block["bins"], block["at"], block["cell"], counted(level)
    out = np.zeros((len(growing), nodes, cells + 1, 2), np.int64)
    chosen = sampled(block["key"], p.seed, tree, p.row_sample)
    for m, partial in enumerate(growing):
        node = route(bins, partial, level) - (2 ** level - 1)
        use = chosen & block["members"][m] & (node >= 0) & (node % 2 == 0)
        node = node // 2
        keep = use[at]
        rows = at[keep]
        where = node[rows] * (cells + 1) + cell[keep]
        for k, d in enumerate(gradients(block["margins"][m], block["y"], p, unit)):
            flat = np.bincount(where, weights=d[rows], minlength=nodes * (cells + 1))
            out[m, :, :, k] = flat.reshape(nodes, cells + 1).astype(np.int64)
            out[m, :, cells, k] = np.bincount(node[use], weights=d[use], minlength=nodes).astype(np.int64)
    return out


def shrunk(g: np.ndarray, l1: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0)


def leaf_score(g: np.ndarray, h: np.ndarray, l1: float) -> np.ndarray:
    return shrunk(g, l1) ** 2 / (h + LAMBDA)


def split_nodes(tree: Tree, sums: np.ndarray, level: int, offsets: np.ndarray, common: np.ndarray, columns: Sequence[int],
                p: TreeParams, unit: float) -> bool:
    """Set the best split of every node of a level (the first feature, then the least cut, then missing
    values to the right on equal gains) and the leaf values of its children."""
    nodes, first = 2 ** level, 2 ** level - 1
    total = sums[:, -1, :]
    live = np.nonzero((tree.feature[(first + np.arange(nodes) - 1) // 2] >= 0) if level else total[:, 1] > 0)[0]
    parent = leaf_score(total[:, 0] / unit, total[:, 1] / unit, p.l1)
    best = np.full(nodes, LEAST_GAIN)
    children = np.zeros((nodes, 2, 2))
    for f in columns:
        s = sums[:, offsets[f]:offsets[f + 1], :].copy()
        s[:, common[f], :] = total - s.sum(axis=1)
        up_to = np.cumsum(s[:, 1:, :], axis=1)
        for missing in (0, 1):
            left = (up_to + missing * s[:, :1, :]) / unit
            right = total[:, None, :] / unit - left
            gain = leaf_score(left[..., 0], left[..., 1], p.l1) + leaf_score(right[..., 0], right[..., 1], p.l1) - parent[:, None]
            gain[(left[..., 1] < p.min_child_weight) | (right[..., 1] < p.min_child_weight)] = -np.inf
            cut = gain.argmax(axis=1)
            for n in live[gain[live, cut[live]] > best[live]].tolist():
                best[n] = gain[n, cut[n]]
                i = first + n
                tree.feature[i], tree.cut[i], tree.missing_left[i], tree.gain[i] = f, cut[n] + 1, bool(missing), best[n]
                children[n] = left[n, cut[n]], right[n, cut[n]]
    for n in live.tolist():
        i = first + n
        if level == 0:
            tree.value[i] = -p.learning_rate * shrunk(total[n, 0] / unit, p.l1) / (total[n, 1] / unit + LAMBDA)
        if tree.feature[i] >= 0:
            for side in (0, 1):
                g, h = children[n, side]
                tree.value[2 * i + 1 + side] = -p.learning_rate * shrunk(g, p.l1) / (h + LAMBDA)
    return bool((tree.feature[first:first + nodes] >= 0).any())


def added(parts: list[np.ndarray], models: int, level: int, cells: int) -> np.ndarray:
    return sum(parts[1:], parts[0]) if parts else np.zeros((models, counted(level), cells + 1, 2), np.int64)


def summed(blocks: RDD, growing: list[tuple], tree: int, level: int, cells: int, p: TreeParams, unit: float) -> np.ndarray:
    """The sums of one level over all tasks. Each task cuts its sums into ranges of cells, a range is reduced in one
    task, and the driver gets each range once, packed."""
    models, ranges = len(growing), min(blocks.getNumPartitions(), REDUCERS)

    def add(part: Iterator[dict]) -> Iterator[tuple[int, np.ndarray]]:
        total = None
        for block in part:
            s = level_sums(block, growing, tree, level, cells, p, unit)
            total = s if total is None else total + s
        if total is not None:
            yield from enumerate(np.array_split(total, ranges, axis=2))

    def pack(sums: np.ndarray) -> tuple:
        return sums.shape, zlib.compress(sums.tobytes(), 1)

    found = dict(blocks.mapPartitions(add).reduceByKey(np.add, ranges).mapValues(pack).collect())       # ``ranges`` rows
    if not found:
        return added([], models, level, cells)
    return np.concatenate([np.frombuffer(zlib.decompress(raw), np.int64).reshape(shape) for _, (shape, raw) in sorted(found.items())], axis=2)


def grown(n: int, number: int, models: int, width: int, p: TreeParams, unit: float, offsets: np.ndarray, common: np.ndarray,
          sums: Callable, advance: Callable) -> list[list[Tree]]:
    """``n`` trees of each model from tree ``number`` on. ``sums`` gives those of a level, ``advance`` puts the last
    trees into the margins. The columns of a tree are drawn by the seed."""
    out: list[list[Tree]] = [[] for _ in range(models)]
    for tree in range(number, number + n):
        if tree > number:
            advance([trees[-1].arrays() for trees in out])
        new = [Tree.empty(p.depth) for _ in range(models)]
        columns = sorted(np.random.default_rng([p.seed, tree]).choice(width, max(1, int(p.column_sample * width)), replace=False).tolist())
        found = None
        for level in range(p.depth):
            growing = [t.arrays() for t in new]
            found = with_siblings(sums(growing, tree, level), found, growing, level)
            if not [m for m in range(models) if split_nodes(new[m], found[m], level, offsets, common, columns, p, unit)]:
                break
        for m in range(models):
            out[m].append(new[m])
    return out


class Training:
    """Models that grow together, one tree at a time each, over one written table. ``members`` tells from
    (part, fold) which rows each model is trained on; the cuts are given or taken from ``cuts_from``."""

    def __init__(self, rows: DataFrame, features: Sequence[str], models: int, members: Members, p: TreeParams,
                 cuts: list[np.ndarray] | None = None, cuts_from: DataFrame | None = None):
        self.features, self.models, self.members, self.p = list(features), models, members, p
        self.cuts = quantile_cuts(rows if cuts_from is None else cuts_from, features) if cuts is None else cuts
        self.state = first_state(rows, features, self.cuts, models)
        self.offsets = np.concatenate([[0], np.cumsum([len(c) + 2 for c in self.cuts])]).astype(np.int64)
        self.n_rows, self.common = self._shape()
        bound = max(1.0, self.n_rows * max(1.0, p.positive_weight))
        self.unit = 2.0 ** min(30, 60 - int(np.ceil(np.log2(bound))))
        self.trees: list[list[Tree]] = [[] for _ in range(models)]
        self.earlier: list[tuple[DataFrame, list[list[Tree]]]] = []        # the table before each block, the trees of the block

    def _shape(self) -> tuple[int, np.ndarray]:
        """Rows, and the most common bin of each feature, from counts per task."""
        width, offsets = len(self.features), self.offsets

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, n = np.zeros(int(offsets[-1]), np.int64), 0
            for b in batches:
                n += len(b)
                total += np.bincount((byte_matrix(b.column("bins"), width) + offsets[:-1]).ravel(), minlength=len(total))
            cell = np.nonzero(total)[0]
            yield pa.RecordBatch.from_arrays([pa.array(np.append(cell, -1)), pa.array(np.append(total[cell], n))], names=["cell", "n"])

        found = self.state.select("bins").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
        total = np.zeros(int(offsets[-1]) + 1, np.int64)
        for r in found:
            total[r.cell] = r.n
        return int(total[-1]), np.array([int(total[a:b].argmax()) for a, b in itertools.pairwise(offsets)], np.uint8)

    def grow(self, n: int) -> None:
        """``n`` more trees of each model; then the margins are advanced and written. Rows that one task holds
        anyway (``ROWS_PER_TASK``) grow all of them in that task; the sums and so the trees are the same."""
        p, models, width, number = self.p, self.models, len(self.features), len(self.trees[0])
        offsets, common, unit, cells = self.offsets, self.common, self.unit, int(self.offsets[-1])
        blocks = blocks_of(self.state, width, models, self.members, self.n_rows, offsets, common)
        if blocks.getNumPartitions() == 1:
            def here(part: Iterator[dict]) -> Iterator[list[list[Tree]]]:
                held = list(part)

                def sums(growing: list[tuple], tree: int, level: int) -> np.ndarray:
                    return added([level_sums(b, growing, tree, level, cells, p, unit) for b in held], models, level, cells)

                def advance(last: list[tuple]) -> None:
                    held[:] = [with_tree(b, last, p.depth) for b in held]
                yield grown(n, number, models, width, p, unit, offsets, common, sums, advance)

            new = blocks.mapPartitions(here).collect()[0]
        else:
            kept = [blocks.persist(StorageLevel.MEMORY_AND_DISK)]

            def sums(growing: list[tuple], tree: int, level: int) -> np.ndarray:
                found = summed(kept[-1], growing, tree, level, cells, p, unit)
                while len(kept) > 1:
                    kept.pop(0).unpersist()
                return found

            def advance(last: list[tuple]) -> None:
                kept.append(kept[-1].map(lambda b: with_tree(b, last, p.depth)).persist(StorageLevel.MEMORY_AND_DISK))
            new = grown(n, number, models, width, p, unit, offsets, common, sums, advance)
            for b in kept:
                b.unpersist()
        for m in range(models):
            self.trees[m] += new[m]
        self.earlier.append((self.state, new))
        self._advance([[t.arrays() for t in trees] for trees in new])

    def _advance(self, done: list[list[tuple]]) -> None:
        """Write the margins after the new trees."""
        width, models, p = len(self.features), self.models, self.p

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                bins, margins = byte_matrix(b.column("bins"), width), matrix(b.column("margins"), models).T.copy()
                for m in range(models):
                    for after in prefixes(bins, margins[m], done[m], p.depth):
                        margins[m] = after
                yield pa.RecordBatch.from_arrays([b.column(c) for c in ("key", "part", "fold", "y", "bins")] + [rows_of_lists(margins.T)],
                                                 names=["key", "part", "fold", "y", "bins", "margins"])

        self.state = written(self.state.mapInArrow(run, STATE), "boosting")


def prefixes(bins: np.ndarray, margin: np.ndarray, trees: Sequence[tuple], depth: int) -> Iterator[np.ndarray]:
    """The margins of a block's rows after each of its trees."""
    start, step = margin.copy(), np.zeros(len(margin))
    for t in trees:
        step = step + t[3][route(bins, t, depth)]
        yield start + step


def rows_of_lists(values: np.ndarray) -> pa.ListArray:
    """A matrix as one list per row."""
    n, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, n * width + 1, width, dtype=np.int32)), pa.array(values.ravel()))


def prefix_scores(before: DataFrame, trees: Sequence[Tree], width: int, depth: int) -> DataFrame:
    """(y, _at, score): of every row of ``before`` (a training table ahead of a block of trees) the margin after each
    tree of the block, numbered from 0. Nothing of it is written with the table."""
    arrays = [t.arrays() for t in trees]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bins, margin = byte_matrix(b.column("bins"), width), matrix(b.column("margins"), 1)[:, 0]
            trail = np.stack(list(prefixes(bins, margin, arrays, depth)), axis=1)
            yield pa.RecordBatch.from_arrays([b.column("y"), rows_of_lists(trail)], names=["y", "trail"])

    rows = before.select("y", "bins", "margins").mapInArrow(run, "y int, trail array<double>")
    return rows.select("y", F.posexplode("trail").alias("_at", "score"))


def scorer(trees: Sequence[Tree], cuts: Sequence[np.ndarray], width: int, depth: int):
    """Arrow batches with a column ``_x`` of feature values -> the same without it, plus the margin."""
    arrays = [t.arrays() for t in trees]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bins = binned(matrix(b.column("_x"), width), cuts)
            margin = sum((t[3][route(bins, t, depth)] for t in arrays), np.zeros(len(b)))
            kept = [c for c in b.schema.names if c != "_x"]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in kept], pa.array(margin)], names=[*kept, "_margin"])
    return run


def sampler(seed: int, tree: int, share: float):
    """Arrow batches with a column ``_key`` -> the same without it, plus whether the row is in the tree's sample."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept = [c for c in b.schema.names if c != "_key"]
            drawn = sampled(b.column("_key").to_numpy().astype(np.uint64), seed, tree, share)
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in kept], pa.array(drawn)], names=[*kept, "_sampled"])
    return run
