"""Verdicts and scores of whole tables against plain Python, written from the rules and not with the operators' helpers."""

import math
import re
from collections import Counter

import numpy as np
import pandas as pd
import xxhash

from ceasekit.llm import classifier, quality

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shares(counts, total):
    parts = [c * quality.SCALE // max(total, 1) for c in counts]
    return [*parts, quality.SCALE - sum(parts)]


def distance(p, q):
    """Jensen-Shannon distance from its definition by entropies."""
    entropy = lambda x: -sum(v * math.log2(v) for v in x if v > 0)
    middle = [(a + b) / 2 for a, b in zip(p, q, strict=True)]
    return math.sqrt(max(entropy(middle) - (entropy(p) + entropy(q)) / 2, 0))


def test_quality_verdicts(spark):
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    rows, sums = {}, {}
    for r in docs.itertuples():
        text = r.text or ""
        words = WORD.findall(text)
        windows = Counter(zip(words, words[1:], words[2:], strict=False))
        repeated = {i + k for i, w in enumerate(zip(words, words[1:], words[2:], strict=False)) if windows[w] > 1 for k in range(3)}
        space = len(text) - sum(map(len, words))
        classes = shares([sum(map(len, re.findall(p, text))) for p in quality.CLASSES] + [space], len(text))
        listed = quality.COMMON_WORDS.get(r.lang)
        found = shares([words.count(w) for w in listed], len(words)) if listed else None
        rows[r.doc_id] = (text, len(words), len(repeated), r.lang if listed else None, classes, found)
        if len(text) >= quality.MIN_CHARS and len(words) >= quality.MIN_WORDS:
            for key, part in ((("class", r.lang), classes), (("class", None), classes), (("word", r.lang), found)):
                if part and (listed or key[1] is None):
                    sums[key] = np.add(sums.get(key, 0), part)
    got = quality.op3_quality_rules(spark, SF).toPandas().set_index("doc_id")
    kept = 0
    for i, (text, n, repeated, lang, classes, found) in rows.items():
        failed = n < 50 or 100 * repeated > 50 * n
        verdict = not failed
        norm = lambda x: [v / sum(x) for v in x]
        reference = sums.get(("class", lang), sums.get(("class", None)))
        if len(text) >= quality.MIN_CHARS:
            verdict &= distance(norm(classes), norm(reference)) <= quality.MAX_CLASS_DISTANCE
        if found and n >= quality.MIN_WORDS and ("word", lang) in sums:
            words = norm(sums["word", lang])
            bare = distance([0] * (len(words) - 1) + [1], words)
            limit = min(quality.MAX_WORD_DISTANCE, quality.MAX_WORD_SHARE * bare) if sum(words[:-1]) else quality.MAX_WORD_DISTANCE
            verdict &= distance(norm(found), words) <= limit
        assert (got.loc[i].n_words, got.loc[i].n_repeat_words, got.loc[i].base_failed, got.loc[i].kept) == (n, repeated, failed, verdict), i
        kept += verdict
    assert 0 < kept < len(rows) and len(got) == len(rows)


def test_scores_by_the_sum_over_pairs(spark):
    """Every document's score under a fixed model, its interactions summed pair by pair."""
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    rng = np.random.default_rng(3)
    width = classifier.BUCKETS + classifier.STATS
    model = {"w0": np.array([0.1], np.float32), "w": rng.normal(0, 0.3, width).astype(np.float32), "v": rng.normal(0, 0.2, (width, classifier.FACTORS)).astype(np.float32)}
    got = classifier.score(spark.read.parquet(f"{SF}/documents.parquet"), model).toPandas()
    got = got.set_index("doc_id").score
    kinds = {c: k for k, chars in enumerate(("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t\x0b\x0c\r",
                                             ".,;:!?'\"()-", "#*$%&|<>", "\n"), start=1) for c in chars.encode()}
    for r in docs.itertuples():
        text = r.text or ""
        words = WORD.findall(text.lower())
        x = np.zeros(width)
        for bucket, c in Counter(xxhash.xxh64_intdigest(w.encode(), 42) % classifier.BUCKETS for w in words).items():
            x[bucket] = math.sqrt(c / len(words))
        raw = text.encode()
        by = Counter(8 if b > 127 else kinds.get(b, 0) for b in raw)
        size, n = max(len(raw), 1), len(words)
        x[classifier.BUCKETS:] = [by[2] / size, by[3] / size, by[5] / size, min(by[6] / size * 4, 1), min(by[7] / size * 20, 1), min(size / max(n, 1) / 20, 1),
                                  (x > 0).sum() / min(max(n, 1), classifier.BUCKETS), min(math.log1p(n) / 12, 1), min(math.log1p(max(r.n_chars, 0)) / 14, 1),
                                  1 - max(by[1], by[2]) / size]
        at = np.flatnonzero(x)
        v = model["v"][at].astype(float) * x[at, None]
        pairs = np.triu(v @ v.T, 1).sum()                       # every pair once
        z = float(model["w0"][0]) + x @ model["w"] + pairs
        assert abs(got[r.doc_id] - 1 / (1 + math.exp(-z))) < 1e-4, r.doc_id
    assert len(got) == len(docs)
