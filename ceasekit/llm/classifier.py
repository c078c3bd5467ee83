"""Operator 6: quality classifier by a factorisation machine.

Features of a text: hashed words, structure statistics of the whole text, and the row's
metadata column (its length). The score is
sigmoid(w0 + sum w_i x_i + 1/2 sum_f ((sum v_if x_i)^2 - sum v_if^2 x_i^2)), so pairwise
interactions cost as much as the linear part. It is fitted by Adam on the logistic loss over a
bounded, hash-drawn sample of labelled rows (``TRAIN_ROWS``); scoring covers every row.

Defined cases: a null text is scored like an empty one, by its constant features; labels other
than 0 and 1, null labels and labels of unknown ids are left out; an id labelled twice is one row with its greatest
label, and a labelled id of several documents is one row, that of the least text hash; with no labelled row every score is 0.5; repeated rows get equal scores; other columns are
not used; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ceasekit.llm.common import split_words, table

BUCKETS = 2048          # of hashed words
FACTORS = 8
TRAIN_ROWS = 12_000     # labelled rows that the model is fitted on, at most
EPOCHS = 30
FOLDS = 5
THRESHOLD = 0.3
SEED = 11
STATS = 10


def held_out(id_col: Column) -> Column:
    """Whether the id's checksum has remainder 0 (a null id is never held out)."""
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(FOLDS)) == 0, F.lit(False))


def byte_classes() -> np.ndarray:
    """Class of each byte: 0 other, 1 lower, 2 upper, 3 digit, 4 space, 5 punctuation, 6 symbol, 7 line end, 8 beyond ASCII."""
    kind = np.zeros(256, dtype=np.int64)
    for c, chars in enumerate(("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t\x0b\x0c\r",
                               ".,;:!?'\"()-", "#*$%&|<>", "\n"), start=1):
        kind[[ord(x) for x in chars]] = c
    kind[128:] = 8
    return kind


def features(words: pa.Array, text: pa.Array, n_chars: pa.Array) -> np.ndarray:
    """Rows x (BUCKETS + STATS): relative word frequencies (root scaled, unit length), then statistics in 0 to 1."""
    rows = len(words)
    ids = words.values.to_numpy(zero_copy_only=False).astype(np.int64)
    lengths = np.diff(words.offsets.to_numpy())
    ids = ids[words.offsets[0].as_py():words.offsets[rows].as_py()]
    at = np.repeat(np.arange(rows), lengths)
    counts = np.bincount(at * BUCKETS + ids, minlength=rows * BUCKETS).reshape(rows, BUCKETS).astype(np.float32)
    share = np.sqrt(counts / np.maximum(lengths, 1)[:, None])       # of unit length, as the shares sum to 1
    distinct = (counts > 0).sum(axis=1)
    kind = byte_classes()
    by_class = np.zeros((rows, 9))
    for i, t in enumerate(text):
        raw = np.frombuffer(t.as_buffer(), dtype=np.uint8) if t.is_valid else np.empty(0, np.uint8)
        for s in range(0, len(raw), 1 << 20):
            by_class[i] += np.bincount(kind[raw[s:s + (1 << 20)]], minlength=9)
    size = np.maximum(by_class.sum(axis=1), 1)
    stats = np.zeros((rows, STATS), dtype=np.float32)
    stats[:, 0] = by_class[:, 2] / size
    stats[:, 1] = by_class[:, 3] / size
    stats[:, 2] = by_class[:, 5] / size
    stats[:, 3] = np.minimum(by_class[:, 6] / size * 4, 1)
    stats[:, 4] = np.minimum(by_class[:, 7] / size * 20, 1)
    stats[:, 5] = np.minimum((size / np.maximum(lengths, 1)) / 20, 1)
    stats[:, 6] = distinct / np.minimum(np.maximum(lengths, 1), BUCKETS)
    stats[:, 7] = np.minimum(np.log1p(lengths) / 12, 1)
    given = np.nan_to_num(n_chars.to_numpy(zero_copy_only=False).astype(np.float64))
    stats[:, 8] = np.minimum(np.log1p(np.maximum(given, 0)) / 14, 1)
    stats[:, 9] = 1 - np.maximum(by_class[:, 1], by_class[:, 2]) / size
    return np.hstack([share, stats])


def raw_score(x: np.ndarray, model: dict) -> np.ndarray:
    """w0 + x.w + half the sum over factors of (x.v)^2 - x^2.v^2: linear in the features."""
    pairs = (x @ model["v"]) ** 2 - (x ** 2) @ (model["v"] ** 2)
    return model["w0"] + x @ model["w"] + 0.5 * pairs.sum(axis=1)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, seed: int = SEED, epochs: int = EPOCHS) -> dict:
    rng = np.random.default_rng(seed)
    width = x.shape[1]
    model = {"w0": np.zeros(1, np.float32), "w": np.zeros(width, np.float32),
             "v": rng.normal(0, 0.02, (width, FACTORS)).astype(np.float32)}
    if len(y) == 0:
        return model | {"v": np.zeros((width, FACTORS), np.float32)}
    first = {k: np.zeros_like(p) for k, p in model.items()}
    second = {k: np.zeros_like(p) for k, p in model.items()}
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(y))
        for s in range(0, len(order), 256):
            b = order[s:s + 256]
            xb, g = x[b], (sigmoid(raw_score(x[b], model)) - y[b]).astype(np.float32) / len(b)
            xv, gx2 = xb @ model["v"], (xb ** 2).T @ g
            grads = {"w0": g.sum(keepdims=True), "w": xb.T @ g + 1e-5 * model["w"],
                     "v": xb.T @ (g[:, None] * xv) - gx2[:, None] * model["v"] + 1e-4 * model["v"]}
            step += 1
            rate = 0.02 * (1 - epoch / epochs) + 0.001
            for k, d in grads.items():
                first[k] = 0.9 * first[k] + 0.1 * d
                second[k] = 0.999 * second[k] + 0.001 * d * d
                model[k] = model[k] - rate * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
    return model


def inputs(docs: DataFrame, text: str = "text", n_chars: str = "n_chars") -> list[Column]:
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    meta = F.col(f"`{n_chars}`").cast("double") if n_chars in docs.columns else F.lit(None).cast("double")
    return [F.transform(split_words(F.lower(body)), lambda w: F.pmod(F.xxhash64(w), F.lit(BUCKETS)).cast("int")).alias("_words"),
            body.alias("_text"), meta.alias("_meta")]


def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for s in range(0, len(b), 256):
            part = b.slice(s, 256)
            x = features(part.column("_words"), part.column("_text"), part.column("_meta"))
            at, where = np.nonzero(x)
            ends = np.concatenate(([0], np.cumsum(np.bincount(at, minlength=len(part))))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [part.column("_order"), part.column("_label"), pa.ListArray.from_arrays(pa.array(ends), pa.array(where.astype(np.int32))),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(x[at, where].astype(np.float32)))], names=["k", "y", "at", "x"])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", label: str = "quality", train_rows: int = TRAIN_ROWS,
          **cols) -> dict:
    """Fit on at most ``train_rows`` labelled rows that are not held out, drawn by the hash of the id.
    The drawn labels are few by this bound, so they are broadcast to the documents."""
    ids = labels.where(F.col(label).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(F.col(id_col))) \
        .groupBy(F.col(id_col).alias("_id")).agg(F.max(label).cast("int").alias("_label"))
    drawn = ids.orderBy(F.xxhash64("_id"), "_id").limit(train_rows)
    known = docs.join(F.broadcast(drawn), F.col(f"`{id_col}`") == F.col("_id"))
    # one row of each id: that of the least text hash
    chosen = known.select("_id", "_label", *inputs(docs, **cols)[1:]).groupBy("_id", "_label").agg(
        F.min_by(F.struct("_text", "_meta"), F.struct(F.xxhash64("_text"), F.col("_meta"))).alias("_row"))
    rows = chosen.select(F.xxhash64("_id").alias("_order"), "_label", F.col("_row._text").alias("text"), F.col("_row._meta").alias("n_chars"))
    got = rows.select("_order", "_label", *inputs(rows)).mapInArrow(vectors, "k long, y int, at array<int>, x array<float>").toArrow()
    x = np.zeros((len(got), BUCKETS + STATS), dtype=np.float32)
    y = np.asarray(got["y"].to_numpy(), dtype=np.float32)
    for i, (at, v) in enumerate(zip(got["at"], got["x"], strict=True)):
        x[i, at.values.to_numpy()] = v.values.to_numpy()
    order = np.argsort(got["k"].to_numpy(), kind="stable")       # the rows arrive in any order
    return fit(x[order], y[order])


def scorer(model: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in range(0, len(b), 256):
                part = b.slice(s, 256)
                x = features(part.column("_words"), part.column("_text"), part.column("_meta"))
                yield pa.RecordBatch.from_arrays([part.column("_id"), pa.array(sigmoid(raw_score(x, model)).astype(np.float64))],
                                                 names=["_id", "score"])
    return run


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", **cols) -> DataFrame:
    """(id, score) for every row."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), *inputs(docs, **cols))
    return rows.mapInArrow(scorer(model), f"_id {kind}, score double").withColumnRenamed("_id", id_col)


def op6_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = score(docs, train(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
