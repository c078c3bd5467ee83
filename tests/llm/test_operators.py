"""Each operator against brute force or DuckDB on small whole tables, and its edge cases."""

import hashlib
import re
import zlib

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ceasekit.llm import classifier, decontaminate, fixity, mixing, near_dedup, pii, quality, queries, sharding, suffix_dedup, url_filter

SF = "/root/testdata/sf0.001"
SPACE = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def texts():
    return pd.read_parquet(f"{SF}/documents.parquet").set_index("doc_id").text


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(queries.SQL[name]).df()
    got = queries.QUERIES[name](spark, SF).toPandas()[list(want.columns)]
    key = [c for c in ("doc_id", "item_id", "page_id", "query_id", "rank", "vec_id") if c in want]
    pd.testing.assert_frame_equal(got.sort_values(key, ignore_index=True), want.sort_values(key, ignore_index=True))


def test_mix_targets_and_caps(spark, odd, empty):
    got = mixing.mix_sources(odd).toPandas()
    assert len(got) == 9 and (got["copies"] <= 2).all()
    by = got.groupby(got["source"].fillna("~")).first()
    assert (by["target"] <= 2 * by["source_size"]).all()
    assert abs(by["target"].sum() - 1.5 * by["source_size"].sum()) < 1e-6
    again = mixing.mix_sources(odd.repartition(5)).toPandas()
    assert sorted(got["copies"] * got["size"]) == sorted(again["copies"] * again["size"])
    assert mixing.emit_copies(odd).count() == got["copies"].sum() and mixing.mix_sources(empty).count() == 0


def test_mix_salted_join_agrees(spark, odd, monkeypatch):
    a = mixing.mix_sources(odd).toPandas()
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 1)
    b = mixing.mix_sources(odd).toPandas()
    assert sorted(a["copies"] * a["size"]) == sorted(b["copies"] * b["size"])


def test_shards(spark, odd, empty):
    clash = odd.withColumn("shard", F.lit("old")).withColumn("slot", F.lit(9))
    a = sharding.shuffle_into_shards(clash, shards=4, bucket_bytes=50).toPandas()
    b = sharding.shuffle_into_shards(clash.repartition(3), shards=4, bucket_bytes=50).toPandas()
    key = ["shard", "slot"]
    assert a.sort_values(key)["text"].tolist() == b.sort_values(key)["text"].tolist()
    sizes = a.groupby("shard").size()
    assert sizes.max() - sizes.min() <= 1 and len(a) == 9
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in a.groupby("shard"))
    assert sharding.shuffle_into_shards(empty).count() == 0


def test_shards_of_a_whole_table(spark, texts):
    """Bucket by bucket in plain Python, from the rows' hashes: the same shard and slot for every row."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    cols = [F.col(c) for c in docs.columns]
    for size in (sharding.BUCKET_BYTES, 40_000):
        keyed = docs.select("doc_id", F.xxhash64(F.lit(sharding.SEED), *cols).alias("a"), F.xxhash64(F.lit(sharding.SEED + 1), *cols).alias("b")).collect()
        buckets = -(-sum(8 + len((t or "").encode()) for t in texts) // size)
        order = []
        for k in range(buckets):
            mine = sorted((r.a, r.b, r.doc_id) for r in keyed if r.a % buckets == k)
            place = list(range(len(mine)))
            draws = np.random.Generator(np.random.PCG64([sharding.SEED, k])).random(len(mine))
            for i in range(len(mine) - 1, 0, -1):
                j = int(draws[i] * (i + 1))
                place[i], place[j] = place[j], place[i]
            order += [mine[i][2] for i in place]
        n, want, at = len(order), {}, 0
        for shard in range(24):
            for slot in range(n // 24 + (shard < n % 24)):
                want[order[at]] = (shard, slot)
                at += 1
        got = sharding.shuffle_into_shards(docs, bucket_bytes=size).collect()
        assert {r.doc_id: (r.shard, r.slot) for r in got} == want
    crc = {r.doc_id: (r.size, r.text_crc32) for r in sharding.op2_shard(spark, SF).collect()}
    assert crc == {i: (8 + len((t or "").encode()), zlib.crc32((t or "").encode())) for i, t in texts.items()}


def test_shards_of_equal_rows(spark, make, monkeypatch):
    """A row repeated more often than a bucket may hold is spread over the buckets, the same on any partitioning."""
    monkeypatch.setattr(sharding, "COPIES", 50)
    docs = make([(1, "same", "en", "s")] * 1234 + [(i, f"text {i}", "en", "s") for i in range(2, 300)])
    sizes, results = [], []
    inner = sharding.shuffle_bucket
    for parts in (1, 6):
        got = sharding.shuffle_into_shards(docs.repartition(parts), shards=5, bucket_bytes=800).toPandas()
        results.append(got.sort_values(["shard", "slot"]).text.tolist())
        assert len(got) == 1532 and (got.text == "same").sum() == 1234
        sizes.append(got.groupby("shard").text.apply(lambda t: (t == "same").mean()))
    assert results[0] == results[1] and sharding.shuffle_bucket is inner
    assert all(0.7 < x < 0.9 for x in sizes[0])                    # spread, not in one stretch


def test_fisher_yates_is_uniform():
    seen = np.zeros((4, 4))
    for k in range(4000):
        for i, x in enumerate(sharding.fisher_yates(4, 1, k)):
            seen[i, x] += 1
    assert (abs(seen / 4000 - 0.25) < 0.04).all()


def brute_quality(text):
    words = SPACE.findall(text or "")
    lines = [x for x in (text or "").split("\n") if SPACE.search(x)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    hit = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            hit |= {i, i + 1, i + 2}
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit),
            n < 50 or 100 * len(hit) > 50 * n)


def test_quality_base(spark, texts):
    got = quality.op3_quality_rules(spark, SF).toPandas().set_index("doc_id")
    cols = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    for i, t in texts[texts.str.len() < 9000].items():
        assert tuple(got.loc[i, cols]) == brute_quality(t), i
    assert not got[got.base_failed].kept.any()


def test_quality_distance_and_edges(spark, odd, empty):
    p, q = [0.5, 0.25, 0.25, 0.0], [0.25, 0.25, 0.25, 0.25]
    m = (np.array(p) + q) / 2
    kl = lambda a: sum(x * np.log2(x / y) for x, y in zip(a, m) if x > 0)
    got = spark.range(1).select(quality.js_distance(F.array(*map(F.lit, p)), F.array(*map(F.lit, q)))).first()[0]
    assert abs(got - np.sqrt((kl(p) + kl(q)) / 2)) < 1e-12
    out = quality.quality_rules(odd.withColumn("kept", F.lit(7))).toPandas()
    assert len(out) == 9 and not out[out.text.isna()].kept.any() and quality.quality_rules(empty).count() == 0


def test_quality_rejects_texts_without_common_words(spark, make):
    rng = np.random.default_rng(8)
    rows, bare = [], set()
    for lang, listed in quality.COMMON_WORDS.items():
        for k in range(20):
            words = ["".join(rng.choice(list("bcfghjklmnprstuvw"), 6)) for _ in range(400)]
            if k < 15:
                words = [str(rng.choice(listed)) if rng.random() < 0.18 else w for w in words]
            else:
                bare.add(len(rows))
            rows.append((len(rows), " ".join(words), lang, "s"))
    got = quality.quality_rules(make(rows)).toPandas()
    assert set(got[~got.kept].doc_id) == bare and not got.base_failed.any()
    p = [0.1, 0.05, 0.85]
    bare_text = spark.range(1).select(quality.js_distance(F.array(*map(F.lit, p)), F.array(*map(F.lit, [0.0, 0.0, 1.0])))).first()[0]
    assert abs(quality.bare_distance(p) - bare_text) < 1e-12 and abs(quality.bare_distance([1.0, 0.0]) - 1) < 1e-12
    only_bare = make([r for r in rows if r[0] in bare])
    assert quality.quality_rules(only_bare).where("kept").count() == len(bare)


@pytest.mark.parametrize("plan_bytes", [decontaminate.PLAN_BYTES, 0])
def test_decontaminate(spark, make, odd, empty, monkeypatch, plan_bytes):
    monkeypatch.setattr(decontaminate, "PLAN_BYTES", plan_bytes)
    items = spark.createDataFrame([(1, " ".join(f"q{i}" for i in range(20))), (2, "too short"), (3, None)], "item_id long, text string")
    part = " ".join(f"q{i}" for i in range(17))
    docs = make([(1, "x " * 5000 + " ".join(f"Q{i}" for i in range(20)) + " y" * 5000, "en", "s"), (2, part, "en", "s"),
                 (3, " ".join(f"q{i}" for i in range(12)), "en", "s"), (4, None, None, None)])
    got = {(r.doc_id, r.item_id, r.n_common) for r in decontaminate.contaminations(docs, items).collect()}
    assert got == {(1, 1, 16), (2, 1, 13)}
    assert [r.doc_id for r in decontaminate.decontaminated(docs, items).orderBy("doc_id").collect()] == [3, 4]
    assert decontaminate.decontaminated(odd, items).count() == 9 and decontaminate.contaminations(empty, items).count() == 0
    assert decontaminate.decontaminated(odd, items.limit(0)).count() == 9


def test_decontaminate_joined_agrees(spark, monkeypatch):
    want = {tuple(r) for r in decontaminate.op4_decontaminate(spark, SF).collect()}
    monkeypatch.setattr(decontaminate, "PLAN_BYTES", 0)
    assert {tuple(r) for r in decontaminate.op4_decontaminate(spark, SF).collect()} == want and want


def test_url_filter_against_brute_force(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    captures, entries = url_filter.dated_captures(pages), url_filter.dated_entries(pages)
    events: dict = {}
    for e in entries.collect():
        days = events.setdefault(e.key, {}).setdefault(e.category, {})
        days[e.day] = days.get(e.day, False) or e.added
    day0 = pd.Timestamp("1970-01-01")
    got = url_filter.filter_urls(captures, entries).toPandas()
    for r in got.itertuples():
        page = r.url.split("?")[0].split("#")[0]
        host = page.split("/")[2]
        keys = {host, host + "/" + page.split("/", 3)[3]} | {host.split(".", k)[k] for k in range(host.count("."))}
        day = (pd.Timestamp(r.fetched) - day0).days
        hit = [category for key in keys for category, days in events.get(key, {}).items()       # the last event up to the day decides
               if (past := [d for d in days if d <= day]) and days[max(past)]]
        assert (r.blocked, r.n_entries, r.categories) == (len(hit) > 0, len(hit), ",".join(sorted(set(hit)))), r.url


def test_url_filter_edges(spark):
    caps = spark.createDataFrame([("http://a.b.com/x", "2024-01-05"), (None, "2024-01-05"), ("http://a.b.com/x", None), ("junk", "2024-01-05")],
                                 "url string, fetched string").withColumn("blocked", F.lit("old"))
    entries = spark.createDataFrame([("b.com", "ads", 19727, True), ("b.com", "ads", 19727, False), ("b.com", "ads", 19728, False),
                                     (None, "ads", 1, True), ("b.com", "spam", None, True)], "key string, category string, day int, added boolean")
    assert [r.blocked for r in url_filter.filter_urls(caps, entries).collect()].count(True) == 1
    assert not any(r.blocked for r in url_filter.filter_urls(caps, entries.limit(0)).collect())
    assert url_filter.filter_urls(caps.limit(0), entries).count() == 0


def test_classifier_identity_and_held_out(spark, odd, empty):
    rng = np.random.default_rng(0)
    x = rng.random((5, 6))
    m = {"w0": np.zeros(1), "w": rng.random(6), "v": rng.random((6, 3))}
    full = [x[r] @ m["w"] + sum(m["v"][i] @ m["v"][j] * x[r, i] * x[r, j] for i in range(6) for j in range(i + 1, 6)) for r in range(5)]
    assert np.allclose(classifier.raw_score(x, m), full)
    sf = "/root/testdata/sf0.01"
    got = classifier.op6_quality_classifier(spark, sf).toPandas().merge(pd.read_parquet(f"{sf}/labels.parquet"), on="doc_id")
    held = got[got.held_out]
    good, bad = held[held.quality == 1].score, held[held.quality == 0].score
    assert np.mean([(good > b).mean() for b in bad]) > 0.95
    labels = spark.createDataFrame([(1, 1), (None, 0), (7, 3)], "doc_id long, quality int")
    model = classifier.train(odd, labels)
    out = classifier.score(odd, model).toPandas()
    assert len(out) == 9 and out.score.between(0, 1).all() and classifier.score(empty, model).count() == 0
    assert (classifier.score(odd, classifier.train(odd, labels.limit(0))).toPandas().score == 0.5).all()


def test_near_dedup(spark, make, odd, empty):
    rng = np.random.default_rng(3)
    base = [f"v{rng.integers(1_000_000)}" for _ in range(300)]
    other = [f"u{rng.integers(1_000_000)}" for _ in range(300)]
    near = base[:100] + ["new"] + base[101:200] + base[202:]
    rows = [(5, " ".join(base), "en", "s"), (3, " ".join(near), "en", "s"), (9, " ".join(base), "en", "s"), (4, " ".join(other), "en", "s"),
            (6, " ".join(base[:60] + other[60:]), "en", "s"), (None, " ".join(base), "en", "s")]
    got = near_dedup.with_classes(make(rows)).toPandas()
    assert got.set_index(got.doc_id.fillna(-1)).class_id.to_dict() == {5: 3, 3: 3, 9: 3, 4: 4, 6: 4, -1: 3} or \
        got[got.doc_id == 6].class_id.iloc[0] in (4, 6)
    kept = near_dedup.one_per_class(make(rows)).toPandas()
    assert {3, 4} <= set(kept.doc_id) and not {5, 9} & set(kept.doc_id)
    out = near_dedup.one_per_class(odd.withColumn("node", F.lit(1))).toPandas()
    assert sorted(out["doc_id"].fillna(-1)) == [-1, 1, 2, 4, 6] and near_dedup.one_per_class(empty).count() == 0


@pytest.mark.parametrize("cell", [near_dedup.CELL, 150])
def test_near_dedup_shared_passage(spark, make, monkeypatch, cell):
    """Clusters a ~ b ~ c with a and c apart, all texts sharing a passage of 0.7 of their words."""
    monkeypatch.setattr(near_dedup, "CELL", cell)
    rng = np.random.default_rng(6)
    word = iter(rng.permutation(1_000_000))
    fresh = lambda n: [f"v{next(word)}" for _ in range(n)]
    passage, rows = fresh(140), []
    for _ in range(400):
        one, two = fresh(30), fresh(30)
        rows += [passage + one + two, passage + one + fresh(30), passage + fresh(30) + two]
    got = near_dedup.with_classes(make([(i, " ".join(x), "en", "s") for i, x in enumerate(rows)])).toPandas()
    want = got.doc_id // 3
    h = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(rows)], "doc_id long, text string")
    sketches = {r.id: set(enumerate(r.sketches)) for r in near_dedup.sketched(h, "doc_id", "text").collect()}
    label = got.set_index("doc_id").class_id
    for k in range(400):
        for other in (1, 2):
            assert not sketches[3 * k] & sketches[3 * k + other] or label[3 * k] == label[3 * k + other]
    assert (got.class_id // 3 == want).all()


def test_fixity_edges(spark):
    schema = "file long, offset long, record_id long, url string, payload string"
    a = spark.createDataFrame([(0, i * 100_000, i, "u", f"p{i}") for i in range(40)] + [(1, 0, 99, None, None), (1, 0, 99, None, "")], schema)
    b = a.where("record_id <> 7").withColumn("payload", F.when(F.col("record_id") == 20, "bad").otherwise(F.col("payload")))
    assert {(r.record_id, r.state) for r in fixity.audit(a, b).collect()} == {(7, "missing"), (20, "changed")}
    assert {(r.record_id, r.state) for r in fixity.audit(b, a).collect()} == {(7, "extra"), (20, "changed")}
    assert fixity.audit(a, a).count() == 0 and fixity.audit(a.limit(0), a.limit(0)).count() == 0
    assert fixity.audit(a, a.limit(0)).count() == 42


def brute_repeats(rows):
    """(id, text) by ascending id -> what remains."""
    seen, out = {}, []
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), dtype=bool)
        for s in range(len(b) - 49):
            if seen.get(b[s:s + 50], i) < i:
                gone[s:s + 50] = True
            seen.setdefault(b[s:s + 50], i)
        runs = int((gone & ~np.concatenate(([False], gone[:-1]))).sum()) if len(b) else 0
        out.append((len(b), int(gone.sum()), runs, hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~gone])).hexdigest()))
    return out


@pytest.mark.parametrize("block", [1 << 20, 4000, 300])
def test_suffix_dedup(spark, texts, monkeypatch, block):
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", block)
    got = suffix_dedup.op9_suffix_dedup(spark, SF).toPandas().sort_values("doc_id")
    assert [tuple(r)[1:] for r in got.itertuples(index=False)] == brute_repeats(texts.sort_index().items())


def test_suffix_dedup_edges(spark, odd, empty, make):
    got = suffix_dedup.remove_repeats(odd).toPandas()
    by = {(None if pd.isna(r.doc_id) else r.doc_id, r.n_bytes): r for r in got.itertuples()}
    assert len(got) == 9 and by[(4, max(got.n_bytes) - 5)].n_removed == 0 and by[(5, max(got.n_bytes))].n_removed > 100_000
    assert by[(2, 0)].kept_sha256 == hashlib.sha256(b"").hexdigest() and suffix_dedup.remove_repeats(empty).count() == 0
    line = "z" * 30 + "y" * 30
    rows = suffix_dedup.remove_repeats(make([(1, line + line, "", ""), (2, "ab" + line, "", "")])).orderBy("doc_id").collect()
    assert [(r.n_removed, r.n_spans) for r in rows] == [(0, 0), (60, 1)]


def test_pii_patterns():
    simple = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
              "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def passes(kind, m):
        digits = re.sub("[^0-9]", "", m)
        return {"email": True, "ip": all(int(x) <= 255 for x in m.split(".")) if kind == "ip" else True,
                "card": 12 <= len(digits) <= 19 and pii.luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
    rng = np.random.default_rng(5)
    text = "".join(rng.choice(list("a@.1234567890 -+()%\n"), 60_000)) + "4111 1111-1111 1111 x@y.z.w 1.2.3.4.5.6.7.8 +1 (609) 555-7932"
    want = sorted((m.start(), m.end(), k) for k, p in simple.items() for m in re.finditer(p, text) if passes(k, m[0]))
    assert sorted(pii.base_spans(text)) == want and len(want) > 20


def test_pii_terms_and_edges(spark, make, odd, empty):
    filler = [f"common{i} words everywhere here number{i}" for i in range(40)]
    rows = [(i, f"{filler[i]} Zorblat wrote from zed@mail.example.com today everywhere", "en", "s") for i in range(4)]
    rows += [(i, f"{filler[i]} today everywhere from wrote", "en", "s") for i in range(4, 40)]
    docs = make([*rows, (90, None, None, None)])
    got = pii.find_personal_data(docs).toPandas().set_index("doc_id")
    assert [rows[0][1][t["start"]:t["stop"]] for t in got.loc[0].terms] == ["Zorblat"] and len(got.loc[10].base) == 0
    clean = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert "Zorblat" not in clean[0] and "<EMAIL>" in clean[0] and clean[10] == rows[10][1] and clean[90] is None
    assert pii.find_personal_data(odd).count() == 9 and pii.find_personal_data(empty).count() == 0


def test_pii_terms_of_rare_values(spark, make):
    common = [f"usual{i}" for i in range(30)]
    rng = np.random.default_rng(4)
    prose = [" ".join(rng.choice(common, 40)) for _ in range(200)]
    rows = [(i, t, "en", "s") for i, t in enumerate(prose)]
    far = f"{prose[0]} zed@one.example.com {prose[1]} Zorblat, {prose[2]} (zorblat) {prose[3]}"      # a value in one text
    rows += [(300, far, "en", "s"), (301, far, "en", "s")]
    rows += [(310 + i, f"{prose[i]} user{i}@acme.example.org {prose[i + 9]} Acmeco {prose[i + 20]}", "en", "s") for i in range(8)]
    rows += [(320 + i, f"{prose[i]} Elsewhere {prose[i + 5]} +1 609 555 010{i} {prose[i + 7]}", "en", "s") for i in range(2)]
    rows += [(330 + i, f"{prose[i]} Elsewhere {prose[i + 3]}", "en", "s") for i in range(9)]
    got = pii.find_personal_data(make(rows)).toPandas().set_index("doc_id")
    marked = {i: [t[s["start"]:s["stop"]] for s in got.loc[i].terms] for i, t, _, _ in rows}
    assert marked[300] == marked[301] == ["Zorblat,", "(zorblat)"]
    assert all(marked[310 + i] == ["Acmeco"] for i in range(8))       # only the domain has them in common
    assert not any(marked[i] for i in range(200)) and not any(marked[320 + i] for i in range(2))


def brute_terms(texts):
    """text -> (start, end) of the words that disclose an entity, all pairs counted."""
    private = {t: (pii.base_spans(t), set()) for t in texts if pii.base_spans(t)}
    rows = [t for t in texts if t not in private] + list(private)
    terms = lambda t: {pii.term_of(w) for w in SPACE.findall(t)}
    n_t = {}
    for t in rows:
        for w in terms(t):
            n_t[w] = n_t.get(w, 0) + 1
    holds, out = {}, {}
    for t, (spans, _) in private.items():
        for s, e, k in spans:
            for x in pii.entities(t[s:e], k):
                holds.setdefault(x, set()).add(t)
    for t, (spans, _) in private.items():
        free = [m for m in SPACE.finditer(t) if len(pii.term_of(m[0])) >= 3 and not any(s < m.end() and m.start() < e for s, e, _ in spans)]
        hit = set()
        for x in {x for s, e, k in spans for x in pii.entities(t[s:e], k)}:
            p = len(holds[x]) / len(rows)
            for w in {pii.term_of(m[0]) for m in free}:
                both = sum(w in terms(u) for u in holds[x])
                if np.log2((both + p) / (n_t[w] + 1) / p) / -np.log2(p) >= pii.ALPHA:
                    hit.add(w)
        out[t] = sorted((m.start(), m.end()) for m in free if pii.term_of(m[0]) in hit)
    return out


def test_pii_terms_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = brute_terms([r.text or "" for r in docs.collect()])
    got = pii.find_personal_data(docs).collect()
    assert want and any(want.values())
    for r in got:
        assert [(x.start, x.stop) for x in r.terms] == want.get(r.text or "", []), r.doc_id


def test_pipeline_stages(spark, texts):
    import corpus_pipeline as P
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept, seen = docs, {}
    for name, stage in P.STAGES:
        kept = stage(spark, kept, SF)
        seen[name] = kept.toPandas()
        if name != "shard":
            assert kept.columns == docs.columns
    verdicts = quality.op3_quality_rules(spark, SF).toPandas()
    assert set(seen["quality"].doc_id) == set(verdicts[verdicts.kept].doc_id)
    assert set(seen["near_dedup"].doc_id) <= set(seen["quality"].doc_id) and not seen["near_dedup"].text.duplicated().any()
    leaks = {r.doc_id for r in decontaminate.op4_decontaminate(spark, SF).collect()}
    assert set(seen["decontaminate"].doc_id) == set(seen["near_dedup"].doc_id) - leaks
    assert sorted(seen["shard"].doc_id) == sorted(seen["mix"].doc_id)


def test_repeated_windows_do_not_depend_on_hashes(spark, monkeypatch):
    """With hashes of two values only, repeats are still exact; and a text of more than 2^24 words is counted."""
    rng = np.random.default_rng(9)
    rows = [(i, " ".join(rng.choice(list("abcdef"), rng.integers(0, 60))), "en") for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    monkeypatch.setattr(quality.F, "xxhash64", lambda *c, h=F.xxhash64: F.pmod(h(*c), F.lit(2)))
    got = quality.with_counts(docs).select("doc_id", "_q_repeat").collect()
    assert {r.doc_id: r["_q_repeat"] for r in got} == {i: brute_quality(t)[4] for i, t, _ in rows}
    assert sum(r["_q_repeat"] for r in got) > 500


def test_classifier_fits_one_row_of_each_id(spark):
    """Labelled ids of several documents: the same scores on any partitioning, with a bound on the labelled ids only."""
    rng = np.random.default_rng(2)
    rows = [(i % 20, " ".join(rng.choice(["good", "fine", "text"] if i % 2 else ["bad", "spam", "#"], 30)), 100) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, quality int")
    scores = []
    for n in (1, 7):
        model = classifier.train(docs.repartition(n), labels, train_rows=20)
        scores.append(classifier.score(docs, model).toPandas().sort_values(["doc_id", "score"]).score.round(9).tolist())
    assert scores[0] == scores[1]


def test_fixity_null_keys_and_one_root(spark):
    """Null file, offset and id; files enough for two levels over their roots; a swap of two files' contents."""
    schema = "file string, offset long, record_id long, url string, payload string"
    rows = [(None if f == 0 else f"f{f}", i * 200_000 if i < 3 else None, None if i == 1 else f * 10 + i, "u", f"p{f}-{i}") for f in range(300) for i in range(4)]
    a = spark.createDataFrame(rows, schema)
    assert fixity.audit(a, a.repartition(3)).count() == 0
    change = lambda r, **kw: tuple(kw.get(k, v) for k, v in zip(("file", "offset", "record_id", "url", "payload"), r, strict=True))
    other = [change(r, payload="bad") if k in (2, 3, 401) else r for k, r in enumerate(rows) if k != 5]
    got = {(r.file, r.offset, r.record_id, r.state) for r in fixity.audit(a, spark.createDataFrame(other, schema)).collect()}
    assert got == {(*rows[2][:3], "changed"), (*rows[3][:3], "changed"), (*rows[401][:3], "changed"), (*rows[5][:3], "missing")}
    swapped = [change(r, file={"f1": "f2", "f2": "f1"}.get(r[0], r[0])) for r in rows]
    assert {r.file for r in fixity.audit(a, spark.createDataFrame(swapped, schema)).collect()} == {"f1", "f2"}
