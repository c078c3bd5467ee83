"""Operator 7: near-duplicate detection by Order MinHash.

A text is the sequence of its lower-cased words. Its k-mers are 5-word windows, labelled with
their occurrence. Each of ``SKETCHES`` hash functions picks the two smallest labelled k-mers
and the sketch keeps them in text order, so that it is sensitive to edit similarity and not
only to the set of k-mers. Texts that share a sketch are candidates. They are verified by
banded alignment: an edit distance over words, within a band of ``1 - threshold`` of the longer
text. Verified links are closed into classes.

Exact copies are one node each (a hash of the text), so that a group of copies of any size
costs one row per task. In a bucket every text is first linked to the least one. Buckets that then
still hold several classes are searched for every further pair, in cells of at most two times ``CELL``
texts and ``CELL_WORDS`` words: length and counts of words and word pairs bound the edit distance from
below (an edit changes two word counts and four pair counts at most), and what may be near is aligned,
the likeliest pairs first, unless its classes have been joined by then. A cell hands on only links that
join classes, fewer than it has texts, and a pair is aligned in one of its buckets only. So texts near to
each other that share a bucket are of one class, and no bucket is cut off. New links are closed over the
heads of the classes found before.

The search is complete within buckets; that near texts share one is likely, not sure (README has the
recall by edit similarity).

Tasks work on at most ``SLICE`` words at once; of a longer text only the hashes of its windows are held.

Defined cases: ids may be of any type that can be ordered; a null text counts as empty, and equal texts are of one class; a text of fewer
than five words is near only to its copies; a class is named by its least id (null if it has
none); rows without an id keep their class; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ceasekit.llm.common import landed, packed, split_words, table, unpacked

K = 5
SKETCHES = 16
THRESHOLD = 0.8
SEED = 7
SLICE = 250_000        # words that a task works on at once
WORDS_BAG, PAIRS_BAG = 256, 1024        # counters of the words and of the word pairs of a text
CELL, CELL_WORDS = 1000, 1 << 20        # texts and words of a chunk of a bucket; a cell is two chunks


def mixed(x: np.ndarray) -> np.ndarray:
    """A fixed invertible scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def window_hashes(h: np.ndarray, k: int = K) -> np.ndarray:
    """Hashes of the k-word windows of a sequence of word hashes."""
    out = np.zeros(max(len(h) - k + 1, 0), dtype=np.uint64)
    for i in range(k):
        out = mixed(out + h[i:i + len(out)])
    return out


def order_sketches(h: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """One row of sketches for each text of at least K words. ``h`` holds the word hashes of all
    texts one after the other; everything runs over all of them at once."""
    windows = lengths - K + 1
    first = np.concatenate(([0], np.cumsum(windows)[:-1])).astype(np.int64)
    all_windows = window_hashes(h)
    text = np.repeat(np.arange(len(windows)), windows)
    base = all_windows[np.arange(int(windows.sum())) - first[text] + starts[text]]
    # label k-mers with their occurrence in the text
    order = np.lexsort((base, text))
    run = np.concatenate(([False], (base[order][1:] == base[order][:-1]) & (text[order][1:] == text[order][:-1])))
    base[order] = labelled(base[order], run)
    out = np.empty((len(windows), SKETCHES), dtype=np.uint64)
    for j in range(SKETCHES):
        x = mixed(base ^ mixed(np.uint64(SEED + j) * np.uint64(0xA0761D6478BD642F) + np.uint64(1)))
        one, at_one = least(x, first, text)
        x[at_one] = np.iinfo(np.uint64).max
        two, at_two = least(x, first, text)
        two = np.where(windows > 1, two, np.uint64(0))
        ahead = (at_one < at_two) | (windows == 1)
        out[:, j] = mixed(mixed(np.where(ahead, one, two)) + np.where(ahead, two, one) + np.uint64(j))
    return out


def labelled(base: np.ndarray, run: np.ndarray) -> np.ndarray:
    """Hashes in order, mixed with the number of equal ones before them (``run``: equal to the one before)."""
    at = np.arange(len(run))
    occurrence = (at - np.maximum.accumulate(np.where(run, 0, at))).astype(np.uint64)
    return mixed(base + occurrence * np.uint64(0xD1B54A32D192ED03))


def least(x: np.ndarray, first: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least value of each text and its first position."""
    value = np.minimum.reduceat(x, first)
    hit = np.flatnonzero(x == value[text])
    _, at = np.unique(text[hit], return_index=True)
    return value, hit[at]


def long_sketch(h: np.ndarray) -> np.ndarray:
    """The row of :func:`order_sketches` for one long text, a slice of it at a time."""
    n = len(h) - K + 1
    base = np.empty(n, dtype=np.uint64)
    for s in range(0, n, SLICE):
        part = window_hashes(h[s:s + SLICE + K - 1])
        base[s:s + len(part)] = part
    parts = np.uint64(-(-n // SLICE))
    group = ((base >> np.uint64(32)) % parts).astype(np.uint32)          # equal windows are in one group
    for p in range(int(parts)):
        at = np.flatnonzero(group == p)
        at = at[np.argsort(base[at], kind="stable")]
        if len(at):
            base[at] = labelled(base[at], np.concatenate(([False], base[at][1:] == base[at][:-1])))
    out = np.empty(SKETCHES, dtype=np.uint64)
    for j in range(SKETCHES):
        best: list = []
        for s in range(0, n, SLICE):
            x = mixed(base[s:s + SLICE] ^ mixed(np.uint64(SEED + j) * np.uint64(0xA0761D6478BD642F) + np.uint64(1)))
            best = sorted(best + [(x[i], s + i) for i in np.argpartition(x, min(1, len(x) - 1))[:2].tolist()])[:2]
        (one, at_one), (two, at_two) = best
        first, second = (one, two) if at_one < at_two else (two, one)
        out[j] = mixed(mixed(np.array([first])) + second + np.uint64(j))[0]
    return out


def word_points(values: np.ndarray) -> np.ndarray:
    return (values % np.uint64(0x10F7FF - 0x100)).astype(np.uint32)


def sliced(lengths: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of texts of at most ``SLICE`` words together; a longer text is a range of its own."""
    out, start, held = [], 0, 0
    for i, n in enumerate(lengths.tolist()):
        if i > start and held + n > SLICE:
            out.append((start, i))
            start, held = i, 0
        held += n
    return [*out, (start, len(lengths))] if len(lengths) else out


def sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, id, n, words) -> (node, id, n, sketches); no sketches for short texts."""
    with np.errstate(over="ignore"):
        for b in batches:
            words = b.column("words")
            offsets = words.offsets.to_numpy()
            for s, e in sliced(np.diff(offsets)):
                lengths = np.diff(offsets[s:e + 1])
                values = words.values.slice(offsets[s], offsets[e] - offsets[s]).to_numpy(zero_copy_only=False).view(np.uint64)
                able = lengths >= K
                flat = np.empty(0, dtype=np.int64)
                if e - s == 1 and lengths[0] > SLICE:
                    flat = long_sketch(values).view(np.int64)
                elif able.any():
                    flat = order_sketches(values, (offsets[s:e] - offsets[s])[able].astype(np.int64), lengths[able].astype(np.int64)).view(np.int64).ravel()
                ends = np.concatenate(([0], np.cumsum(able * SKETCHES)))
                part = b.slice(s, e - s)
                yield pa.RecordBatch.from_arrays([part.column("node"), part.column("id"), part.column("n"),
                                                  pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))], names=["node", "id", "n", "sketches"])


def bags(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """texts x (WORDS_BAG + PAIRS_BAG): how many words, and pairs of neighbouring words, fall into each counter."""
    rows = len(lengths)
    text = np.repeat(np.arange(rows), lengths)
    words = np.bincount(text * WORDS_BAG + (values % np.uint64(WORDS_BAG)).astype(np.int64), minlength=rows * WORDS_BAG).reshape(rows, WORDS_BAG)
    inner = text[1:] == text[:-1]
    pair = (mixed(mixed(values[:-1][inner]) + values[1:][inner]) % np.uint64(PAIRS_BAG)).astype(np.int64)
    pairs = np.bincount(text[1:][inner] * PAIRS_BAG + pair, minlength=rows * PAIRS_BAG).reshape(rows, PAIRS_BAG)
    return np.minimum(np.hstack([words, pairs]), 255).astype(np.uint8)


def letter_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, words) -> (node, n, letters, bag): each word becomes one code point, so that an edit distance of
    strings is an edit distance of words. Words share a code point once in a million."""
    with np.errstate(over="ignore"):
        for b in batches:
            words = b.column("words")
            offsets = words.offsets.to_numpy()
            for s, e in sliced(np.diff(offsets)):
                values = words.values.slice(offsets[s], offsets[e] - offsets[s]).to_numpy(zero_copy_only=False).view(np.uint64)
                at, lengths = offsets[s:e] - offsets[s], np.diff(offsets[s:e + 1])
                points = word_points(values) + np.uint32(0x100)
                points = np.where(points >= 0xD800, points + np.uint32(0x800), points)
                letters = [points[i:i + n].astype("<u4").tobytes().decode("utf-32-le") for i, n in zip(at, lengths, strict=True)]
                counts = bags(values, at, lengths)
                yield pa.RecordBatch.from_arrays([b.column("node").slice(s, e - s), pa.array(lengths, pa.int32()), pa.array(letters, pa.string()),
                                                  pa.array([x.tobytes() for x in counts], pa.binary())], names=["node", "n", "letters", "bag"])


def node_of(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")))


def word_hashes(text: Column) -> Column:
    return F.transform(split_words(F.lower(text)), lambda w: F.xxhash64(w))


def sketched(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """One row per distinct text: node, id (its least id), n (words), sketches."""
    body = F.col(f"`{text}`")
    words = docs.select(node_of(body).alias("node"), F.col(f"`{id_col}`").alias("id"), word_hashes(F.coalesce(body, F.lit(""))).alias("words"))
    words = words.withColumn("n", F.size("words")).select("node", "id", "n", "words")
    kind = docs.schema[id_col].dataType.simpleString()
    rows = words.mapInArrow(sketch_batches, f"node string, id {kind}, n int, sketches array<bigint>")
    return rows.groupBy("node").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("sketches").alias("sketches"))


def star_links(members: DataFrame) -> DataFrame:
    """(bucket, node) -> (a, b): every member with the least of its bucket."""
    heads = members.groupBy("bucket").agg(F.min("node").alias("head"), F.count(F.lit(1)).alias("size")).where("size > 1")
    return members.join(heads, "bucket").where("node > head").select(F.col("head").alias("a"), F.col("node").alias("b")).distinct()


def celled(members: DataFrame, texts: DataFrame, labels: DataFrame, threshold: float) -> DataFrame:
    """(cell, bucket, side, node, n, bag, letters, class, buckets) of the buckets that hold several classes; of
    buckets with the same texts one is kept. A large bucket is split by length into bands, of which only
    neighbours can have near texts, and by hash into chunks; a cell is a pair of chunks, so that any two texts
    that may be near meet in one."""
    classed = members.join(labels, "node", "left").join(texts.select("node", "n"), "node") \
        .select("bucket", "node", "n", F.xxhash64(F.coalesce("head", "node")).alias("class"))
    mixed_up = classed.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("words"), F.min("class").alias("low"),
                                             F.max("class").alias("high"), F.bit_xor(F.xxhash64("node")).alias("who"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("who2")) \
        .where("low <> high").groupBy("size", "words", "who", "who2").agg(F.min("bucket").alias("bucket")).select("bucket", "size", "words")
    kept = landed(classed.join(mixed_up, "bucket"), "dedup-contested")
    own = kept.groupBy("node").agg(F.sort_array(F.collect_set("bucket")).alias("buckets"))         # at most SKETCHES
    rows = kept.drop("n").join(texts, "node").join(own, "node")
    ratio = 1.01 / max(threshold, 0.01)
    rows = rows.withColumn("k", F.ceil(F.greatest(F.col("size") / CELL, F.col("words") / CELL_WORDS)).cast("int")) \
        .withColumn("band", F.floor(F.log(F.greatest("n", F.lit(1))) / F.log(F.lit(ratio))).cast("int")) \
        .withColumn("i", F.pmod(F.xxhash64("node"), F.col("k")).cast("int"))
    one, i = F.lit(1), F.col("i")
    key = lambda lo, a, hi, b: F.xxhash64("bucket", lo, a, hi, b).alias("cell")
    side = lambda x: x.cast("int").alias("side")
    chunks, band = F.sequence(F.lit(0), F.col("k") - 1), F.col("band")
    same = F.transform(chunks, lambda j: F.struct(key(band, F.least(i, j), band, F.greatest(i, j)), side(
        F.when(i == j, 2).when(i < j, 0).otherwise(1))))
    above = F.transform(chunks, lambda j: F.struct(key(band, i, band + one, j), side(F.lit(0))))
    below = F.transform(chunks, lambda j: F.struct(key(band - one, j, band, i), side(F.lit(1))))
    whole = F.array(F.struct(F.col("bucket").alias("cell"), side(F.lit(2))))
    return rows.select(F.explode(F.when(F.col("k") == 1, whole).otherwise(F.concat(same, above, below))).alias("at"),
                       "bucket", "node", "n", "bag", "letters", "class", "buckets") \
        .select("at.cell", "bucket", "at.side", "node", "n", "bag", "letters", "class", "buckets")


def places(letters: np.ndarray) -> dict[int, int]:
    """Per letter the bits of its places."""
    out: dict[int, int] = {}
    for i, x in enumerate(letters.tolist()):
        out[x] = out.get(x, 0) | (1 << i)
    return out


def within(a: np.ndarray, b: np.ndarray, most: int) -> bool:
    """Whether the edit distance is at most ``most``: what both begin and end with is left out, the rest is
    aligned with a column of the table as the bits of two whole numbers."""
    short = min(len(a), len(b))
    differ = a[:short] != b[:short]
    head = int(differ.argmax()) if differ.any() else short
    a, b = a[head:], b[head:]
    short = min(len(a), len(b))
    if short:
        differ = a[::-1][:short] != b[::-1][:short]
        tail = int(differ.argmax()) if differ.any() else short
        a, b = a[:len(a) - tail], b[:len(b) - tail]
    if len(a) == 0 or len(b) == 0 or max(len(a), len(b)) <= most:
        return max(len(a), len(b)) <= most
    at, m = places(a), len(a)
    every, high = (1 << m) - 1, 1 << (m - 1)
    up, down, score, left = every, 0, m, len(b)
    for x in b.tolist():
        equal = at.get(x, 0)
        vertical = equal | down
        horizontal = (((equal & up) + up) ^ up) | equal
        more, less = down | (every & ~(horizontal | up)), up & horizontal
        if more & high:
            score += 1
        elif less & high:
            score -= 1
        left -= 1
        if score - left > most:
            return False
        more, less = (more << 1) | 1, less << 1
        up = (less | ~(vertical | more)) & every
        down = more & vertical & every
    return score <= most


def cell_links(rows: dict, threshold: float) -> Iterator[tuple[int, int]]:
    """Pairs of a cell that are near and join classes. Of each text the pairs of different classes that length
    and counts let be near, and whose least common bucket this is, are aligned, the likeliest first."""
    side, n, bag, label, letters, buckets, bucket = (rows[k] for k in ("side", "n", "bag", "class", "letters", "buckets", "bucket"))
    names, label = np.unique(label, return_inverse=True)
    share = float(f"{1 - threshold:.6f}")
    for i in range(len(n) - 1):
        most = np.floor(share * np.maximum(n[i + 1:], n[i]) + 1e-9)
        gap = np.abs(n[i + 1:] - n[i])
        found = np.flatnonzero((label[i + 1:] != label[i]) & ((side[i] == 2) | (side[i + 1:] != side[i])) & (gap <= most))
        if len(found) == 0:
            continue
        words = (gap[found] + np.abs(bag[i + 1 + found, :WORDS_BAG] - bag[i, :WORDS_BAG]).sum(axis=1)) / 2
        found, words = found[words <= most[found]], words[words <= most[found]]
        least_edits = np.maximum(words, np.abs(bag[i + 1 + found, WORDS_BAG:] - bag[i, WORDS_BAG:]).sum(axis=1) / 4)
        likely = least_edits <= most[found]
        found, least_edits = found[likely], least_edits[likely]
        for j in (i + 1 + found[np.argsort(least_edits, kind="stable")]).tolist():
            if label[i] != label[j] and min(buckets[i] & buckets[j]) == bucket and within(letters[i], letters[j], int(share * max(n[i], n[j]) + 1e-9)):
                label[label == label[j]] = label[i]
                yield i, j


def links_of_cells(cells: DataFrame, threshold: float) -> DataFrame:
    """(a, b): see :func:`cell_links`; rows of a cell are read one after the other."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            t = pa.Table.from_batches(held).combine_chunks()
            width = WORDS_BAG + PAIRS_BAG
            rows = {k: t[k].to_numpy() for k in ("side", "class")} | {
                "n": t["n"].to_numpy().astype(np.int64), "bucket": t["bucket"][0].as_py(),
                "bag": np.frombuffer(b"".join(t["bag"].to_pylist()), np.uint8).reshape(len(t), width).astype(np.int16),
                "letters": [np.frombuffer(x.encode("utf-32-le"), np.uint32) for x in t["letters"].to_pylist()],
                "buckets": [set(x) for x in t["buckets"].to_pylist()]}
            got = list(cell_links(rows, threshold))
            if got:
                ends = [t["node"].take(pa.array(list(side))).combine_chunks() for side in zip(*got, strict=True)]
                yield pa.RecordBatch.from_arrays(ends, names=["a", "b"])

        held: list[pa.RecordBatch] = []
        for b in batches:
            if not len(b):
                continue
            cell = b.column("cell").to_numpy()
            cuts = [0, *(np.flatnonzero(cell[1:] != cell[:-1]) + 1).tolist(), len(b)]
            for s, e in zip(cuts[:-1], cuts[1:], strict=True):
                if held and held[-1].column("cell")[0].as_py() != cell[s]:
                    yield from links(held)
                    held = []
                held.append(b.slice(s, e - s))
        if held:
            yield from links(held)
    return cells.repartition("cell").sortWithinPartitions("cell", "node").mapInArrow(run, "a string, b string").distinct()


def lettered(docs: DataFrame, nodes: DataFrame, id_col: str, text: str) -> DataFrame:
    """(node, n, letters, bag) of the texts that are in a link, one row of each."""
    body = F.col(f"`{text}`")
    rows = docs.select(node_of(body).alias("node"), F.col(f"`{id_col}`").alias("id"), body.alias("text"))
    wanted = nodes.select(F.col("node").alias("_node"), F.col("id").alias("_id"))
    one = rows.join(wanted, (F.col("node") == F.col("_node")) & F.col("id").eqNullSafe(F.col("_id")), "left_semi")
    shape = "node string, n int, letters string, bag binary"
    out = one.select("node", word_hashes(F.coalesce("text", F.lit(""))).alias("words")).mapInArrow(letter_batches, shape)
    return landed(out.dropDuplicates(["node"]), "dedup-letters")


def verified(links: DataFrame, letters: DataFrame, threshold: float) -> DataFrame:
    """(a, b, near): a banded alignment, first in a narrow band that most true links pass."""
    pairs = links.join(letters.select(F.col("node").alias("a"), F.col("letters").alias("x")), "a") \
        .join(letters.select(F.col("node").alias("b"), F.col("letters").alias("y")), "b")
    band = f"cast(floor({1 - threshold:.6f} * greatest(length(x), length(y)) + 1e-9) as int)"
    near = F.expr(f"""CASE WHEN abs(length(x) - length(y)) > {band} THEN false
        WHEN levenshtein(x, y, least({band}, 8 + greatest(length(x), length(y)) div 24)) >= 0 THEN true
        ELSE levenshtein(x, y, {band}) >= 0 END""")
    return pairs.select("a", "b", near.alias("near"))


def classes(links: DataFrame) -> DataFrame:
    """(node, head): connected components by contraction. Each place points to its least neighbour if that is
    less; pointers are shortened to the places they lead to, and the links between these, of which there are
    far fewer, make the next round. Rounds are written; only whether any link is left reaches the driver."""
    edges = landed(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), "dedup-links")
    labels = None
    while True:
        both = edges.union(edges.select("b", "a"))
        parent = shortened(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("head")))
        if labels is None:
            labels = parent
        else:
            later = parent.select(F.col("node").alias("head"), F.col("head").alias("_later"))
            labels = landed(labels.join(later, "head", "left").select("node", F.coalesce("_later", "head").alias("head")), "dedup-labels")
        ends = [parent.select(F.col("node").alias(e), F.col("head").alias(f"head_{e}")) for e in ("a", "b")]
        heads = edges.join(ends[0], "a").join(ends[1], "b").select(F.least("head_a", "head_b").alias("a"), F.greatest("head_a", "head_b").alias("b"))
        edges = landed(heads.where("a <> b").distinct(), "dedup-links")
        if edges.isEmpty():
            return labels


def shortened(parent: DataFrame) -> DataFrame:
    """Pointers (node, head) led on to the places that point to themselves: each round doubles the steps."""
    parent = landed(parent, "dedup-pointers")
    while True:
        on = parent.select(F.col("node").alias("head"), F.col("head").alias("far"))
        step = landed(parent.join(on, "head").select("node", "head", "far"), "dedup-pointers")
        parent = step.select("node", F.col("far").alias("head"))
        if step.where("head <> far").isEmpty():
            return parent


def merged(heads: DataFrame, links: DataFrame) -> DataFrame:
    """(node, head) after further links: only the heads of the texts they join are put into components."""
    def head(end: str) -> DataFrame:
        return heads.select(F.col("node").alias(end), F.col("head").alias(f"head_{end}"))

    between = links.select("a", "b").join(head("a"), "a", "left").join(head("b"), "b", "left").select(
        F.coalesce("head_a", "a").alias("a"), F.coalesce("head_b", "b").alias("b")).where("a <> b").distinct()
    between = landed(between, "dedup-between")
    if between.isEmpty():
        return heads
    further = classes(between)
    known = heads.unionByName(further.join(heads, "node", "left_anti").select("node", F.col("node").alias("head")))      # texts that were alone
    later = further.select(F.col("node").alias("head"), F.col("head").alias("_later"))
    return landed(known.join(later, "head", "left").select("node", F.coalesce("_later", "head").alias("head")), "dedup-heads")


def near_classes(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(node, id, class_id) for every distinct text: its least id and the least id of its class."""
    nodes = landed(sketched(docs, id_col, text), "dedup-sketches")
    members = nodes.select("node", F.posexplode("sketches").alias("j", "sketch")).select("node", F.xxhash64("j", "sketch").alias("bucket"))
    star = landed(star_links(members), "dedup-star")
    # texts to align: those with any company in a bucket, which holds for every later link as well
    company = star.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    letters = lettered(docs, nodes.join(company, "node", "left_semi"), id_col, text)
    tried = landed(verified(star, letters, threshold), "dedup-verified")
    # a bucket of two texts is settled by their link
    large = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 2").select("bucket")
    members = landed(members.join(large, "bucket", "left_semi"), "dedup-members")
    heads = classes(landed(tried.where("near"), "dedup-near"))
    heads = merged(heads, landed(links_of_cells(celled(members, letters, heads, threshold), threshold), "dedup-found"))
    named = nodes.join(heads, "node", "left").withColumn("head", F.coalesce("head", "node"))
    ids = named.groupBy("head").agg(F.min("id").alias("class_id"))
    return landed(named.select("node", "id", "head").join(ids, "head").select("node", "id", "class_id", "head"), "dedup-classes")


def with_classes(docs: DataFrame, id_col: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` plus class_id (the least id of its class) and first (whether the class keeps this id)."""
    found = near_classes(docs, id_col=id_col, text=text, **options)
    rows = docs.select(node_of(F.col(f"`{text}`")).alias("node"), packed(docs))
    joined = rows.join(found.select("node", "class_id"), "node")
    return unpacked(joined.withColumn("first", F.col("_row").getField(id_col).eqNullSafe(F.col("class_id"))),
                    docs.columns, ["class_id", "first"])


def one_per_class(docs: DataFrame, id_col: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row of each class, with the columns of ``docs``: that of the least id (of rows with
    equal id and text, or of a class without ids, any one)."""
    found = near_classes(docs, id_col=id_col, text=text, **options)
    keep = found.where(F.col("id").eqNullSafe(F.col("class_id"))).groupBy("head").agg(F.min("node").alias("_node"), F.first("id").alias("_id"))
    rows = docs.select(node_of(F.col(f"`{text}`")).alias("node"), packed(docs))
    kept = rows.join(keep, (F.col("node") == F.col("_node")) & F.col("_row").getField(id_col).eqNullSafe(F.col("_id")), "left_semi")
    return unpacked(kept.dropDuplicates(["node"]), docs.columns)


def op7_near_dedup(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = near_classes(docs).select("node", "class_id")
    return docs.select("doc_id", node_of(F.col("text")).alias("node")).join(found, "node").select("doc_id", "class_id")
