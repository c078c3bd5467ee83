"""Operator 9: removal of repeated byte strings by threshold-bounded interval expansion.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts in a document with a
smaller id. A suffix array over the whole corpus would not fit any task, so equal strings are
first brought together and each block then gets its own Burrows-Wheeler transform:

1. Of every string of LENGTH bytes the GRAM-byte substring of least hash is its anchor (a
   minimizer): equal strings have equal anchors at equal places. Anchors that two different
   texts have are candidates; they are found by one sort, in a stream.
2. The strings of a candidate anchor form one fragment of its text. Fragments meet on the anchor.
   Equal fragments are settled at once: only the least id keeps them. Different fragments of one
   anchor go, many anchors at a time, into a block.
3. In a block, breadth-first backward extension on the Burrows-Wheeler transform sets common
   prefixes in order of increasing value and stops at LENGTH: suffixes with no boundary between
   them share LENGTH bytes. The least id of each such group keeps the string.

An anchor with more different fragments than a block holds leaves the block: its strings are
grouped by an ordinary aggregate instead, so no task gathers an unbounded group. Exact copies
of a text are settled by the text's hash and enter none of this.

Defined cases: a null text is empty; texts under LENGTH bytes lose nothing; rows of equal id
never remove each other's bytes; a missing id counts as larger than any; repeated rows are
judged alike; an empty table gives an empty result; other columns are not used.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ceasekit.llm.common import landed, release_shuffles, table

LENGTH = 50
GRAM = 24
SPAN = LENGTH - GRAM + 1          # anchor places in a string
BLOCK_BYTES = 1 << 20             # of different fragments in one Burrows-Wheeler transform
NO_ID = (1 << 63) - 1
ODD = np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(raw: np.ndarray) -> np.ndarray:
    """Hashes of all GRAM-byte substrings, from hashes of 2, 4, 8 and 16 bytes."""
    def join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        x = a * ODD
        x += b
        x ^= x >> np.uint64(29)
        return x
    h = raw.astype(np.uint64) + np.uint64(1)
    by = {}
    width = 1
    while width < 16:
        h = join(h[:len(h) - width], h[width:])
        width *= 2
        by[width] = h
    out = join(by[16][:len(raw) - GRAM + 1], by[8][16:16 + len(raw) - GRAM + 1])
    out *= ODD
    out ^= out >> np.uint64(32)
    return out


def sliding(x: np.ndarray, width: int, op) -> np.ndarray:
    """op (minimum or maximum) over every ``width`` neighbours, by doubling."""
    done, out = 1, x
    while done * 2 <= width:
        out = op(out[:len(out) - done], out[done:])
        done *= 2
    rest = width - done
    return op(out[:len(out) - rest], out[rest:]) if rest else out


class Anchored:
    """Texts one after the other, with the anchors of all of them found at once.

    ``hashes``: of all grams (those across two texts as the greatest number); ``least``: the least gram hash of each
    string, 0 where a string would leave its text; ``at``: places that are some string's anchor, ``of`` their text."""

    def __init__(self, raws: list[np.ndarray]):
        sizes = np.array([len(x) for x in raws], dtype=np.int64)
        self.raw = np.concatenate(raws) if len(raws) > 1 else raws[0]
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.hashes = gram_hashes(self.raw)
        self.blank(self.hashes, GRAM - 1, np.iinfo(np.uint64).max)
        self.least = sliding(self.hashes, SPAN, np.minimum)
        self.blank(self.least, LENGTH - 1, 0)
        edge = np.zeros(SPAN - 1, dtype=np.uint64)
        most = sliding(np.concatenate([edge, self.least, edge]), SPAN, np.maximum)
        self.at = np.flatnonzero((most == self.hashes) & (most != 0))
        self.of = np.searchsorted(self.ends, self.at, side="right")

    def blank(self, values: np.ndarray, last: int, value: int) -> None:
        """Put ``value`` at the ``last`` places of each text (all places of a shorter one)."""
        first = np.maximum(self.ends - last, self.starts)
        n = self.ends - first
        place = np.arange(int(n.sum())) + np.repeat(first - np.cumsum(n) + n, n)
        values[place[place < len(values)]] = value


TOGETHER = 1 << 16          # bytes of texts that are searched at once; a longer text is searched alone


def together(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about TOGETHER bytes."""
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if i > start and held + n > TOGETHER:
            yield start, i
            start, held = i, 0
        held += n
    if sizes:
        yield start, len(sizes)


def raw_of(value) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), dtype=np.uint8)


def pack_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, id, body) with the body compressed: texts are shuffled twice and stored once."""
    codec = pa.Codec("zstd")
    for b in batches:
        size = [len(x.as_buffer()) for x in b.column("body")]
        packed = [codec.compress(x.as_buffer(), asbytes=True) for x in b.column("body")]
        yield pa.RecordBatch.from_arrays([b.column("node"), b.column("id"), pa.array(size, pa.int64()), pa.array(packed, pa.binary())],
                                         names=["node", "id", "size", "packed"])


def unpacked_body(batch: pa.RecordBatch, i: int) -> bytes:
    return pa.decompress(batch.column("packed")[i].as_buffer(), batch.column("size")[i].as_py(), codec="zstd", asbytes=True)


def anchor_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, body) -> (anchor, node). A text that a task has met is not read again, so a group of
    copies counts once per task."""
    seen: set[int] = set()
    with np.errstate(over="ignore"):
        for b in batches:
            fresh = []
            for node, body in zip(b.column("node").to_pylist(), b.column("body"), strict=True):
                if node not in seen:
                    seen.add(node)
                    if len(body.as_buffer()) >= LENGTH:
                        fresh.append((node, raw_of(body)))
            for s, e in together([len(raw) for _, raw in fresh]):
                t = Anchored([raw for _, raw in fresh[s:e]])
                h = t.hashes[t.at]
                order = np.lexsort((h, t.of))
                h, of = h[order], t.of[order]
                own = np.concatenate(([True], (h[1:] != h[:-1]) | (of[1:] != of[:-1])))
                nodes = np.array([node for node, _ in fresh[s:e]], dtype=np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(h[own].view(np.int64)), pa.array(nodes[of[own]])], names=["anchor", "node"])


def shared_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(anchor, node) sorted -> the rows whose anchor has two nodes. Of a run that goes on in the next
    batch only its first row is held."""
    held_anchor = held_node = None
    sent = False
    for b in batches:
        a, n = b.column("anchor").to_numpy(), b.column("node").to_numpy()
        if held_anchor is not None:
            a, n = np.concatenate(([held_anchor], a)), np.concatenate(([held_node], n))
        new = np.concatenate(([True], (a[1:] != a[:-1]) | (n[1:] != n[:-1])))
        first = np.concatenate(([True], a[1:] != a[:-1]))
        run = np.cumsum(first) - 1
        several = np.bincount(run, weights=new) >= 2
        if held_anchor is not None and sent:
            several[0] = True
        keep = new & several[run]
        if held_anchor is not None and sent:
            keep[0] = False                     # went out with the batch before
        last_sent = bool(several[-1])
        if keep.any():
            yield pa.RecordBatch.from_arrays([pa.array(n[keep]), pa.array(a[keep])], names=["node", "anchor"])
        held_anchor, held_node, sent = a[-1], n[-1], last_sent


def fragment_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, id, packed body, shared anchors) -> (anchor, fragment, id, node, start): all strings of an anchor."""
    with np.errstate(over="ignore"):
        for b in batches:
            for s, e in together(b.column("size").to_pylist()):
                part = b.slice(s, e - s)
                t = Anchored([np.frombuffer(unpacked_body(part, i), dtype=np.uint8) for i in range(len(part))])
                shared = part.column("shared")
                which, low, high = fragments_of(t, shared.flatten().to_numpy().view(np.uint64), np.diff(shared.offsets.to_numpy()))
                text, whole = t.of[which], t.raw.tobytes()
                pieces = [whole[i:j] for i, j in zip(low.tolist(), high.tolist(), strict=True)]
                ids, nodes = part.column("id").to_numpy(), part.column("node").to_numpy()
                yield pa.RecordBatch.from_arrays([pa.array(t.hashes[t.at[which]].view(np.int64)), pa.array(pieces, pa.binary()), pa.array(ids[text]),
                                                  pa.array(nodes[text]), pa.array((low - t.starts[text]).astype(np.int32))],
                                                 names=["anchor", "fragment", "id", "node", "start"])


def fragments_of(t: Anchored, shared: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor place, begin, end) of the strings of each text's shared anchors: a contiguous run of them.
    ``shared``: the texts' shared anchors one after the other. Anchors are told apart by hash and text mixed into
    one number; should two meet, a fragment too many is made, which alone removes nothing."""
    mark = lambda h, text: h + text.astype(np.uint64) * ODD
    wanted = np.flatnonzero(np.isin(mark(t.hashes[t.at], t.of), mark(shared, np.repeat(np.arange(len(lengths)), lengths))))
    at = t.at[wanted]
    place = at[None, :] - np.arange(SPAN)[:, None]
    mine = (place >= 0) & (place < len(t.least)) & (t.least[np.clip(place, 0, len(t.least) - 1)] == t.hashes[at][None, :])
    some = mine.any(axis=0)
    high = at - mine.argmax(axis=0)
    low = at - (SPAN - 1 - mine[::-1].argmax(axis=0))
    return wanted[some], low[some], high[some] + LENGTH


PACKED = 7             # characters that fit in one whole number


def packed_prefix(text: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The first PACKED characters of each suffix as a number; 0 beyond its end mark (0), ``left`` characters on."""
    padded = np.concatenate([text, np.zeros(PACKED, dtype=text.dtype)]).astype(np.int64)
    key = np.zeros(len(text), dtype=np.int64)
    for k in range(PACKED):
        key = (key << 9) | np.where(left >= k, padded[k:k + len(text)], 0)
    return key


def suffix_order(key: np.ndarray, left: np.ndarray, length: int) -> np.ndarray:
    """Suffixes in the order of their first ``length`` characters at least, by prefix doubling from their packed
    prefixes; equal ones in any order."""
    n = len(key)
    width, longest = PACKED, min(length, int(left.max()) + 1)
    while True:
        order = np.argsort(key)
        ordered = key[order]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.cumsum(np.concatenate(([1], (ordered[1:] != ordered[:-1]).astype(np.int64))))
        if width >= longest:
            return order
        ahead = np.zeros(n, dtype=np.int64)
        ahead[:n - width] = rank[width:]
        key = rank * np.int64(n + 2) + np.where(left >= width, ahead, 0)
        width *= 2


def prefix_groups(text: np.ndarray, left: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes in order, boundary flags): suffixes with no boundary between them share ``length`` bytes, if
    they have as many.

    Breadth first: the intervals of suffixes that start with w, at first those of PACKED characters, are
    extended to the left by each character of the transform. The end of a new interval is a boundary with a
    common prefix of the level before. An interval whose end was known is not extended again; nor is one of
    a w with an end mark, which no string of ``length`` bytes starts with."""
    key = packed_prefix(text, left)
    order = suffix_order(key, left, length).astype(np.int32)
    n = len(order)
    rank = np.empty(n, dtype=np.int32)
    rank[order] = np.arange(n, dtype=np.int32)
    before = order - 1
    transform = np.where(before >= 0, text[before], 0)
    step = np.where(before >= 0, rank[before], 0)         # place of the suffix one longer
    ordered = key[order]
    boundary = np.concatenate(([True], ordered[1:] != ordered[:-1], [True]))
    starts = np.flatnonzero(boundary[:-1])
    ends = np.concatenate((starts[1:], [n]))
    real = left[order[starts]] >= PACKED
    starts, ends = starts[real], ends[real]
    for _ in range(length - PACKED):
        if len(starts) == 0:
            break
        sizes = ends - starts
        owner = np.repeat(np.arange(len(starts), dtype=np.int32), sizes)
        at = np.arange(len(owner)) + np.repeat(starts - np.cumsum(sizes) + sizes, sizes)
        char = transform[at]
        real = char != 0
        to, owner, char = step[at[real]], owner[real], char[real]
        if len(to) == 0:
            break
        by = np.argsort(to)
        to, owner, char = to[by], owner[by], char[by]
        cut = np.flatnonzero((to[1:] != to[:-1] + 1) | (owner[1:] != owner[:-1]) | (char[1:] != char[:-1])) + 1
        starts, ends = to[np.concatenate(([0], cut))].astype(np.int64), to[np.concatenate((cut - 1, [len(to) - 1]))].astype(np.int64) + 1
        new = ~boundary[ends]
        boundary[ends] = True
        starts, ends = starts[new], ends[new]
    return order, boundary


def late_ranges(fragments: list[bytes], ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(fragment, from, to) of the places whose LENGTH bytes a fragment of a smaller id has as well, as ranges of
    bytes in the fragment."""
    sizes = np.array([len(f) for f in fragments])
    joined = np.frombuffer(b"\0".join(fragments) + b"\0", dtype=np.uint8).astype(np.int16) + 1
    ends = np.cumsum(sizes + 1)
    joined[ends - 1] = 0
    left = np.repeat(ends - 1, sizes + 1) - np.arange(len(joined))
    order, boundary = prefix_groups(joined, left, LENGTH)
    own = np.where(left >= LENGTH, np.repeat(ids, sizes + 1), NO_ID)
    group = np.flatnonzero(boundary[:-1])
    least = np.empty(len(joined), dtype=np.int64)
    least[order] = np.repeat(np.minimum.reduceat(own[order], group), np.diff(np.concatenate((group, [len(order)]))))
    gone = np.flatnonzero(least < own)
    gone = gone[left[gone] >= LENGTH]
    if len(gone) == 0:
        return gone, gone, gone
    cut = np.flatnonzero(np.diff(gone) > 1) + 1            # fragments are apart, as their last places are never whole
    first, last = gone[np.concatenate(([0], cut))], gone[np.concatenate((cut - 1, [len(gone) - 1]))]
    owner = np.searchsorted(ends, first, side="right")
    begin = (ends - sizes - 1)[owner]
    return owner, first - begin, last - begin + LENGTH


class Block:
    """Sorted (anchor, fragment, id, node, start) rows of whole anchors; yields removed ranges."""

    def __init__(self) -> None:
        self.out: list[tuple[int, int, int]] = []         # node, from, to
        self.wide: list[tuple[bytes, int, int, int]] = [] # string, id, node, start
        self.fragments: list[bytes] = []
        self.ids: list[int] = []
        self.rows: list[tuple[int, int]] = []             # node, start of each fragment's least row
        self.size = 0
        self.anchor = self.last = None
        self.begin = self.open_size = 0                   # of the open anchor in fragments
        self.overflow = False

    def add(self, anchor: int, fragment: bytes, row_id: int, node: int, start: int) -> None:
        if anchor != self.anchor:
            self.close()
            self.anchor, self.last = anchor, None
        if fragment == self.last:                         # the same id again: larger ones are settled before
            if not self.overflow:
                self.fragments.append(fragment)
                self.ids.append(row_id)
                self.rows.append((node, start))
                return
        else:
            self.last = fragment
            self.size += len(fragment) + 1
            self.open_size += len(fragment) + 1
        if self.overflow:
            self.spill(fragment, row_id, node, start)
            return
        self.fragments.append(fragment)
        self.ids.append(row_id)
        self.rows.append((node, start))
        if self.open_size > BLOCK_BYTES:
            for f, i, (n, s) in zip(self.fragments[self.begin:], self.ids[self.begin:], self.rows[self.begin:], strict=True):
                self.spill(f, i, n, s)
            del self.fragments[self.begin:], self.ids[self.begin:], self.rows[self.begin:]
            self.overflow = True

    def spill(self, fragment: bytes, row_id: int, node: int, start: int) -> None:
        for k in range(len(fragment) - LENGTH + 1):
            self.wide.append((fragment[k:k + LENGTH], row_id, node, start + k))

    def close(self) -> None:
        """End of an anchor: alone, its fragment removes nothing more; a full block is settled."""
        if len(self.fragments) - self.begin <= 1 or len(set(self.ids[self.begin:])) == 1:
            del self.fragments[self.begin:], self.ids[self.begin:], self.rows[self.begin:]
        self.begin, self.open_size, self.overflow = len(self.fragments), 0, False
        if self.size >= BLOCK_BYTES:
            self.settle()

    def settle(self) -> None:
        if self.fragments:
            for owner, a, b in zip(*(x.tolist() for x in late_ranges(self.fragments, np.array(self.ids, dtype=np.int64))), strict=True):
                node, start = self.rows[owner]
                self.out.append((node, start + a, start + b))
        self.fragments, self.ids, self.rows, self.size, self.begin = [], [], [], 0, 0

    def drain(self) -> Iterator[pa.RecordBatch]:
        if self.out or self.wide:
            n = len(self.out)
            yield pa.RecordBatch.from_arrays([
                pa.array([x[0] for x in self.out] + [x[2] for x in self.wide], pa.int64()),
                pa.array([x[1] for x in self.out] + [x[3] for x in self.wide], pa.int32()),
                pa.array([x[2] for x in self.out] + [x[3] + LENGTH for x in self.wide], pa.int32()),
                pa.array([None] * n + [x[0] for x in self.wide], pa.binary()),
                pa.array([None] * n + [x[1] for x in self.wide], pa.int64())], names=["node", "start", "stop", "string", "id"])
        self.out, self.wide = [], []


def settled_rows(b: pa.RecordBatch, last: tuple) -> tuple[np.ndarray, tuple]:
    """Which sorted rows repeat the anchor and fragment of the row before under a larger id than the
    first such row, and the state to go on with. ``last``: anchor, fragment, least id of the batch before."""
    anchor, ids, fragment = b.column("anchor").to_numpy(), b.column("id").to_numpy(), b.column("fragment")
    same = np.zeros(len(b), dtype=bool)
    same[1:] = (anchor[1:] == anchor[:-1]) & pc.equal(fragment.slice(1), fragment.slice(0, len(b) - 1)).to_numpy(zero_copy_only=False)
    same[0] = (anchor[0], fragment[0].as_py()) == last[:2]
    head = np.maximum.accumulate(np.where(same, 0, np.arange(len(b))))
    least = ids[head]
    if same[0]:
        least[:np.argmin(same) if not same.all() else len(b)] = last[2]
    return same & (ids > least), (anchor[-1], fragment[len(b) - 1].as_py(), least[-1])


def open_rows(rows: pa.RecordBatch, open_anchor: int | None) -> pa.RecordBatch:
    """Rows without those of anchors that are whole in the batch and have one row or one id only: such an
    anchor removes nothing. The anchor that is open from the batch before and the last one may go on."""
    if len(rows) == 0:
        return rows
    anchor, ids = rows.column("anchor").to_numpy(), rows.column("id").to_numpy()
    first = np.concatenate(([True], anchor[1:] != anchor[:-1]))
    starts = np.flatnonzero(first)
    several = np.minimum.reduceat(ids, starts) != np.maximum.reduceat(ids, starts)
    several[0] |= anchor[0] == open_anchor
    several[-1] = True
    return rows.filter(pa.array(several[np.cumsum(first) - 1]))


def removal_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block, last = Block(), (None, None, None)
    for b in batches:
        if len(b) == 0:
            continue
        settled, last = settled_rows(b, last)
        if settled.any():
            gone = b.filter(pa.array(settled))
            start = gone.column("start")
            stop = pc.add(start, pc.binary_length(gone.column("fragment")).cast(pa.int32()))
            yield pa.RecordBatch.from_arrays([gone.column("node"), start, stop, pa.nulls(len(gone), pa.binary()), pa.nulls(len(gone), pa.int64())],
                                             names=["node", "start", "stop", "string", "id"])
        rest = open_rows(b.filter(pa.array(~settled)), block.anchor)
        cols = [rest.column(c).to_pylist() for c in ("anchor", "fragment", "id", "node", "start")]
        for row in zip(*cols, strict=True):
            block.add(*row)
            if len(block.wide) > 50_000:
                yield from block.drain()
        yield from block.drain()
    block.close()
    block.settle()
    yield from block.drain()


def merged(ranges: list[tuple[int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for s, e in sorted(ranges):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return out


def cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, packed body, ranges) -> (node, spans, kept bytes)."""
    for b in batches:
        spans, kept = [], []
        for i, ranges in enumerate(b.column("ranges").to_pylist()):
            body = unpacked_body(b, i)
            runs = merged([(x["start"], x["stop"]) for x in ranges])
            edges = [0, *[x for r in runs for x in r], len(body)]
            kept.append(b"".join(body[edges[i]:edges[i + 1]] for i in range(0, len(edges), 2)))
            spans.append([{"start": s, "stop": e} for s, e in runs])
        kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
        yield pa.RecordBatch.from_arrays([b.column("node"), pa.array(spans, kind), pa.array(kept, pa.binary())], names=["node", "spans", "kept"])


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def shared_anchors(docs: DataFrame) -> DataFrame:
    """(node, shared: its anchors that another text has)."""
    found = docs.where(F.octet_length("body") >= LENGTH).select("node", "body").mapInArrow(anchor_batches, "anchor bigint, node bigint")
    shared = found.repartition("anchor").sortWithinPartitions("anchor", "node").mapInArrow(shared_batches, "node bigint, anchor bigint")
    return landed(shared.groupBy("node").agg(F.collect_set("anchor").alias("shared")), "suffix-anchors")


def texts_with_shared(docs: DataFrame, reps: DataFrame) -> DataFrame:
    """(node, id, size, packed, shared) of the texts with a shared anchor, one row of each."""
    wanted = reps.join(shared_anchors(docs), "node").select(F.col("node").alias("_node"), F.col("least").alias("_least"), "shared")
    release_shuffles(docs.sparkSession)
    packed = docs.where(F.octet_length("body") >= LENGTH).select("node", "id", "body") \
        .mapInArrow(pack_batches, "node bigint, id bigint, size bigint, packed binary")
    texts = packed.join(wanted, (F.col("node") == F.col("_node")) & (F.col("id") == F.col("_least"))) \
        .select("node", "id", "size", "packed", "shared")
    return landed(texts.dropDuplicates(["node", "id"]), "suffix-texts")     # on the join's own partitioning


def removed_ranges(docs: DataFrame, reps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(texts with a shared anchor, their removed ranges by node). ``docs``: id, node, copy, body;
    ``reps``: the least id of each distinct text."""
    texts = texts_with_shared(docs, reps)
    release_shuffles(docs.sparkSession)
    rows = texts.mapInArrow(fragment_batches, "anchor bigint, fragment binary, id bigint, node bigint, start int")
    out = landed(rows.repartition("anchor").sortWithinPartitions("anchor", "fragment", "id")
                 .mapInArrow(removal_batches, "node bigint, start int, stop int, string binary, id bigint"), "suffix-ranges")
    strings = out.where("string IS NOT NULL")
    least = strings.groupBy("string").agg(F.min("id").alias("least"))
    late = strings.join(least, "string").where("id > least").select("node", "start", "stop")
    return texts, out.where("string IS NULL").select("node", "start", "stop").union(late)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, n_bytes, n_removed, n_spans, spans, kept (null: as it was) and kept_sha256."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID)).alias("id"),
                       F.md5(body).alias("copy"), body.alias("body"))
    rows = rows.withColumn("node", F.conv(F.substring("copy", 1, 15), 16, 10).cast("long"))
    facts = landed(rows.select("_id", "id", "copy", "node", F.octet_length("body").cast("long").alias("n_bytes"),
                               F.sha2("body", 256).alias("sha")), "suffix-facts")
    reps = landed(facts.groupBy("copy", "node").agg(F.min("id").alias("least")), "suffix-reps")
    texts, ranges = removed_ranges(rows, reps)
    release_shuffles(docs.sparkSession)
    listed = ranges.distinct().groupBy("node").agg(F.collect_list(F.struct("start", "stop")).alias("ranges"))
    cut = texts.select("node", "size", "packed").join(listed, "node").select("node", "size", "packed", "ranges") \
        .mapInArrow(cut_batches, "node bigint, spans array<struct<start:int,stop:int>>, kept binary")
    cut = cut.select("node", "spans", "kept", F.sha2("kept", 256).alias("cut_sha"))
    joined = facts.join(reps.select("copy", "least").join(cut.join(reps.select("node", "copy"), "node"), "copy", "left"), "copy")
    copied = (F.col("id") > F.col("least")) & (F.col("n_bytes") >= LENGTH)
    removed = F.coalesce(F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + (x.getField("stop") - x.getField("start"))), F.lit(0).cast("long"))
    all_of_it = F.array(F.struct(F.lit(0).alias("start"), F.col("n_bytes").cast("int").alias("stop")))
    return joined.select(
        F.col("_id").alias(id_col), "n_bytes", F.when(copied, F.col("n_bytes")).otherwise(removed).alias("n_removed"),
        F.when(copied, F.lit(1)).otherwise(F.greatest(F.coalesce(F.size("spans"), F.lit(0)), F.lit(0))).cast("long").alias("n_spans"),
        F.when(copied, all_of_it).otherwise(F.col("spans")).alias("spans"),
        F.when(copied, F.lit(b"")).otherwise(F.col("kept")).alias("kept"),
        F.when(copied, F.lit(sha256(b""))).otherwise(F.coalesce("cut_sha", "sha")).alias("kept_sha256"))


def op9_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
