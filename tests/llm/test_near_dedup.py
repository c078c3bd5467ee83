"""Near-duplicates against all pairs of a whole table, and sketches of slices, long texts and odd ids."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ceasekit.llm import near_dedup as nd

SF = "/root/testdata/sf0.001"


def edit_distance(a, b, most):
    """Edit distance over words within a band, or more than ``most``."""
    row = np.arange(len(b) + 1)
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        fresh = np.minimum(row[1:] + 1, np.concatenate(([last], row[1:-1])) + (b != x)) if len(b) else row[1:]
        row[1:] = np.minimum.accumulate(np.concatenate(([row[0]], fresh)) - np.arange(len(b) + 1))[1:] + np.arange(1, len(b) + 1)
        if row.min() > most:
            return most + 1
    return int(row[-1])


def test_all_pairs_of_a_table(spark):
    """Every pair of texts within the threshold that shares a sketch is of one class, and the classes are the
    components of such pairs; nearly all pairs within the threshold are joined."""
    docs = pd.read_parquet(f"{SF}/documents.parquet").sort_values("doc_id")
    got = nd.op7_near_dedup(spark, SF).toPandas().set_index("doc_id").class_id
    assert len(got) == len(docs)
    words = [np.array([hash(w) for w in (t or "").lower().split()]) for t in docs.text]
    ids = docs.doc_id.tolist()
    near, joined = [], 0
    for i in range(len(ids)):
        for j in range(i + 1, len(ids)):
            most = int(0.2 * max(len(words[i]), len(words[j])) + 1e-9)
            if abs(len(words[i]) - len(words[j])) <= most and edit_distance(words[i], words[j], most) <= most:
                near.append((ids[i], ids[j]))
                joined += got[ids[i]] == got[ids[j]]
    assert len(near) >= 20 and joined >= 0.95 * len(near)
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in near:
        if got[a] == got[b]:
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    assert [got[i] for i in ids] == [root(i) for i in ids]
    kept = nd.one_per_class(spark.read.parquet(f"{SF}/documents.parquet")).toPandas()
    assert sorted(kept.doc_id) == sorted({root(i) for i in ids})               # the document of the least id of each class


def hashed(rng, n, values):
    return rng.integers(1, values, n).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def plain_sketch(h):
    """Sketches of one text, window by window."""
    seen, windows = {}, []
    for i in range(len(h) - nd.K + 1):
        w = nd.window_hashes(h[i:i + nd.K])[0]
        seen[w] = seen.get(w, -1) + 1
        windows.append(nd.mixed(np.array([w + np.uint64(seen[w]) * np.uint64(0xD1B54A32D192ED03)]))[0])
    out = []
    for j in range(nd.SKETCHES):
        x = [nd.mixed(np.array([w ^ nd.mixed(np.array([np.uint64(nd.SEED + j) * np.uint64(0xA0761D6478BD642F) + np.uint64(1)]))[0]]))[0] for w in windows]
        one, two = [*sorted(range(len(x)), key=lambda i: x[i])[:2], None][:2]
        pair = sorted(i for i in (one, two) if i is not None)
        first, second = x[pair[0]], x[pair[1]] if len(pair) > 1 else np.uint64(0)
        out.append(nd.mixed(np.array([nd.mixed(np.array([first]))[0] + second + np.uint64(j)]))[0])
    return np.array(out)


def test_sketches_against_window_by_window():
    """Of texts alone, together, and in slices: a text's sketch does not depend on its neighbours."""
    with np.errstate(over="ignore"):
        rng = np.random.default_rng(1)
        texts = [hashed(rng, n, v) for n, v in ((5, 9), (40, 3), (6, 1000), (300, 4), (90, 10 ** 6))]
        lengths = np.array([len(t) for t in texts])
        starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        together = nd.order_sketches(np.concatenate(texts), starts, lengths)
        for t, row in zip(texts, together, strict=True):
            assert (plain_sketch(t) == row).all()
            assert (nd.order_sketches(t, np.array([0]), np.array([len(t)]))[0] == row).all()


def test_long_text_in_slices(monkeypatch):
    with np.errstate(over="ignore"):
        rng = np.random.default_rng(2)
        for n, values in ((4000, 5), (4003, 10 ** 6), (1001, 2)):
            h = hashed(rng, n, values)
            whole = nd.order_sketches(h, np.array([0]), np.array([n]))[0]
            for piece in (100, 333, 1000):
                monkeypatch.setattr(nd, "SLICE", piece)
                assert (nd.long_sketch(h) == whole).all()


def test_batches_in_slices(spark, odd, monkeypatch):
    """Rows of one batch give the same whatever the slice."""
    whole = nd.with_classes(odd).toPandas()
    monkeypatch.setattr(nd, "SLICE", 7)
    again = nd.with_classes(odd.repartition(3)).toPandas()
    key = lambda d: sorted(map(str, zip(d.doc_id, d.class_id, d["first"], strict=True)))
    assert key(whole) == key(again)
    assert nd.sliced(np.array([3, 3, 9, 1, 1, 1, 1, 4])) == [(0, 2), (2, 3), (3, 7), (7, 8)] and nd.sliced(np.array([])) == []


def test_counts_bound_the_edit_distance():
    with np.errstate(over="ignore"):
        rng = np.random.default_rng(3)
        for _ in range(200):
            a = rng.integers(0, 30, rng.integers(1, 60))
            b = list(a)
            edits = int(rng.integers(0, 8))
            for _ in range(edits):
                at = int(rng.integers(0, len(b) + 1))
                what = rng.integers(0, 3)
                if what == 0:
                    b.insert(at, int(rng.integers(0, 30)))
                elif b[at:]:
                    b[at:at + 1] = [int(rng.integers(0, 30))] if what == 1 else []
            h = np.concatenate([a, np.array(b, dtype=np.int64)]).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            x, y = nd.bags(h, np.array([0, len(a)]), np.array([len(a), len(b)])).astype(int)
            assert np.abs(x - y)[:nd.WORDS_BAG].sum() <= 2 * edits and np.abs(x - y)[nd.WORDS_BAG:].sum() <= 4 * edits


def test_ids_of_any_type(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [("b", text), ("a", text + " end"), ("c", "alone " * 9), (None, text)]
    got = nd.with_classes(spark.createDataFrame(rows, "doc_id string, text string")).toPandas()
    assert dict(zip(got.doc_id.fillna("-"), got.class_id, strict=True)) == {"b": "a", "a": "a", "c": "c", "-": "a"}
    kept = nd.one_per_class(spark.createDataFrame(rows, "doc_id string, text string")).toPandas()
    assert sorted(kept.doc_id) == ["a", "c"]


@pytest.mark.parametrize("cell", [(1000, 1 << 20), (7, 1 << 20), (1000, 900)])
def test_a_chain_is_one_class(spark, make, monkeypatch, cell):
    """A chain of texts, each near to the next only, in whole buckets and in cells of few texts or words."""
    monkeypatch.setattr(nd, "CELL", cell[0])
    monkeypatch.setattr(nd, "CELL_WORDS", cell[1])
    words = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(30):
        rows.append(list(words))
        for k in range(8):
            words[(i * 8 + k) % 200] = f"x{i}-{k}"
    got = nd.with_classes(make([(i, " ".join(r), "en", "s") for i, r in enumerate(rows)])).toPandas()
    assert set(got.class_id) == {0}


@pytest.mark.parametrize("changed, least", [(0.05, 0.99), (0.1, 0.9), (0.15, 0.6)])
def test_recall_by_edit_similarity(changed, least):
    """Share of pairs with scattered replacements that meet in a sketch, as the README states it."""
    with np.errstate(over="ignore"):
        rng = np.random.default_rng(4)
        met = 0
        for _ in range(200):
            a = rng.integers(1, 1 << 62, 300).astype(np.uint64)
            b = a.copy()
            b[rng.choice(300, int(300 * changed), replace=False)] = rng.integers(1, 1 << 62, int(300 * changed)).astype(np.uint64)
            x, y = nd.order_sketches(np.concatenate([a, b]), np.array([0, 300]), np.array([300, 300]))
            met += bool((x == y).any())
        assert met >= least * 200


def test_components(spark):
    """Paths, stars and random graphs against union-find; labels are the least member."""
    rng = np.random.default_rng(5)
    edges = [(f"p{i:04d}", f"p{i + 1:04d}") for i in range(300)] + [("s0500", f"s{i:04d}") for i in range(500)]
    edges += [(f"r{a:03d}", f"r{b:03d}") for a, b in rng.integers(0, 900, (700, 2))]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    got = {r.node: r.head for r in nd.classes(spark.createDataFrame(edges, "a string, b string")).collect()}
    alone = {a for a, b in edges if a == b} - {x for e in edges if e[0] != e[1] for x in e}
    assert got == {x: root(x) for x in parent if x not in alone}
    assert nd.classes(spark.createDataFrame([], "a string, b string")).count() == 0


def test_within_is_the_edit_distance():
    rng = np.random.default_rng(8)
    for _ in range(600):
        a = rng.integers(0, rng.integers(2, 9), rng.integers(0, 40)).astype(np.uint32)
        b = a.copy() if rng.random() < 0.5 else rng.integers(0, 9, rng.integers(0, 40)).astype(np.uint32)
        for _ in range(rng.integers(0, 6)):
            at = int(rng.integers(0, len(b) + 1))
            b = np.concatenate([b[:at], rng.integers(0, 9, rng.integers(0, 2)).astype(np.uint32), b[at + int(rng.integers(0, 2)):]])
        exact = edit_distance(a, b, 1000)
        for most in {0, 1, exact - 1, exact, exact + 1, 100}:
            if most >= 0:
                assert nd.within(a, b, most) == (exact <= most)
