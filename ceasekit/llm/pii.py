"""Operator 10: personal data and information-theoretic sanitisation.

Base spans are found by fixed patterns. The personal values found are protected entities, and so
is what several values share: the mail domain, the block of an IP address, the prefix of a phone
number. Corpus co-occurrence then estimates how strongly a word reveals them: with the numbers of
texts of the word t, the entity e and both, PMI(t, e) = log2(N n_te / (n_t n_e)) is compared with
the information of the entity, IC(e) = log2(N / n_e). The share of e in the texts of t is smoothed
by ``SMOOTHING`` texts of the corpus average, so that one text proves little about an entity of many
texts, while a value of a single text is protected as well. A word of a text with PMI >= alpha * IC
for an entity of that text discloses it: all its mentions in the text become spans of kind 'term'.
In the sanitised text base spans become their kind, terms are generalised to their shape, and those
that give the entity away entirely are removed.

Counts are over all documents; copies of a text with personal data count once. Defined cases: a null
text counts as empty; a text without personal data is left as it is; rows without an id are treated
like any other; repeated rows are treated alike; an empty table gives an empty result; a column named
like an added one is replaced.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ceasekit.llm.common import landed, packed, split_words, table, unpacked

# Kinds in order, and the base patterns. Possessive quantifiers and the look-behind
# match the same spans in linear time.
KINDS = ["email", "ip", "card", "phone", "term"]
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOCAL_CHARS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
EDGES = ".,;:!?'\"()[]<>|#*$%&"
ALPHA = 0.8           # share of the entity's information that a word may not give away
REMOVE = 0.98         # from this share on the word is removed, below it is generalised
SMOOTHING = 1.0       # texts of the corpus average added to those of a word


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches: at each @, the longest run before it and the domain after it."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL_CHARS:
            start -= 1
        found = DOMAIN.match(text, at) if start < at else None
        if found:
            yield start, found.end()
            end = found.end()
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) by start, then kind as listed."""
    out = [(s, e, 0) for s, e in emails(text)]
    for m in IP.finditer(text):
        if all(len(x.lstrip("0")) <= 3 and int(x) <= 255 for x in m[0].split(".")):
            out.append((m.start(), m.end(), 1))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), m.end(), 2))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((m.start(), m.end(), 3))
    return [(s, e, KINDS[k]) for s, e, k in sorted(out, key=lambda x: (x[0], x[2], x[1]))]


def term_of(word: str) -> str:
    return word.strip(EDGES).lower()


def entities(value: str, kind: str) -> list[str]:
    """The value, spelled in one way, and what it shares with others."""
    digits = "".join(c for c in value if c.isdigit())
    own = {"email": value.lower(), "ip": value}.get(kind, digits)
    wide = {"email": own.rpartition("@")[2], "ip": value.rpartition(".")[0], "phone": digits[:-4]}.get(kind)
    return [f"{kind}:{own}"] + ([f"{kind} of:{wide}"] if wide else [])


def mentions(text: str, spans: list[tuple[int, int, str]]) -> list[tuple[str, int, int]]:
    """(term, start, end) of all words that are no part of a span."""
    taken = sorted((s, e) for s, e, _ in spans)
    reach = []                    # of the spans so far, for overlap tests
    most = 0
    for s, e in taken:
        most = max(most, e)
        reach.append(most)
    begins = [s for s, _ in taken]
    out = []
    for m in WORD.finditer(text):
        k = bisect_left(begins, m.end())
        if (k == 0 or reach[k - 1] <= m.start()) and len(t := term_of(m[0])) >= 3:
            out.append((t, m.start(), m.end()))
    return out


def find_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("kind", pa.string())]))
    word = pa.list_(pa.struct([("term", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]))
    for b in batches:
        spans, keys, words = [], [], []
        for t in b.column("_text"):
            text = t.as_py() or ""
            found = base_spans(text)
            spans.append([{"start": s, "stop": e, "kind": k} for s, e, k in found])
            keys.append(sorted({x for s, e, k in found for x in entities(text[s:e], k)}))
            words.append([{"term": w, "start": s, "stop": e} for w, s, e in (mentions(text, found) if found else [])])
        yield pa.RecordBatch.from_arrays([b.column("_row"), pa.array(spans, span), pa.array(keys, pa.list_(pa.string())), pa.array(words, word)],
                                         names=["_row", "base", "keys", "words"])


def with_base_spans(docs: DataFrame, carry: list[str], text: str) -> DataFrame:
    """(_row: the carried columns, node, base spans, keys: its entities, words: the
    other words of a text with personal data)."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry], F.md5(body).alias("_node")).alias("_row"), body.alias("_text"))
    schema = T.StructType([rows.schema["_row"], T.StructField("base", T.ArrayType(T.StructType([
        T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType()), T.StructField("kind", T.StringType())]))),
        T.StructField("keys", T.ArrayType(T.StringType())), T.StructField("words", T.ArrayType(T.StructType([
            T.StructField("term", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType())])))])
    return landed(rows.mapInArrow(find_batches, schema), "pii-spans")


def text_set(node) -> list:
    """Aggregates that are equal for entities of the same texts."""
    return [F.count(F.lit(1)).alias("n_e"), F.bit_xor(F.xxhash64(node)).alias("x"), F.bit_xor(F.xxhash64(node, F.lit(1))).alias("y")]


def disclosing_terms(private: DataFrame, docs: DataFrame, text: str, alpha: float, smoothing: float) -> DataFrame:
    """(node, term, share of the entity's information) for the ``private`` texts: node, copies, keys, words.

    Entities of the same texts have the same shares, so one of them stands for all: a text full of
    values of its own costs one entity. The words of all documents are counted by task first,
    whatever the entities are; a word too frequent for any share of ``alpha`` meets no entity."""
    keys = private.select("node", F.explode("keys").alias("entity"))
    sets = keys.groupBy("entity").agg(*text_set(F.col("node"))).groupBy("n_e", "x", "y").agg(F.min("entity").alias("entity"))
    words = F.array_distinct(F.transform(split_words(F.lower(F.col(f"`{text}`"))), lambda w: F.btrim(w, F.lit(EDGES))))
    counts = docs.select(F.explode(words).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    held = private.select("node", "copies", F.explode(F.array_distinct(F.transform("words", lambda x: x.getField("term")))).alias("term"))
    by_term = held.groupBy("term").agg(F.count(F.lit(1)).alias("n_held"), F.sum(F.col("copies") - 1).alias("again"))
    n_t = by_term.join(counts, "term", "left").select(
        "term", F.greatest(F.coalesce("n", F.lit(0)) - F.col("again"), "n_held").alias("n_t"))
    total = docs.count() - (private.agg(F.sum(F.col("copies") - 1)).first()[0] or 0)
    p = F.col("n_e") / F.lit(float(max(total, 1)))
    likely = lambda both: (both + smoothing * p) / (F.col("n_t") + smoothing)
    share = lambda both: F.log2(likely(both) / p) / -F.log2(p)
    of_text = keys.join(sets.where(p < 1), "entity").select("node", "entity", "n_e")
    pairs = landed(held.join(n_t, "term").select("node", "term", "n_t").join(of_text, "node").where(
        share(F.least("n_e", "n_t")) >= alpha), "pii-pairs")
    strong = pairs.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_te"), F.first("n_t").alias("n_t"), F.first("n_e").alias("n_e")) \
        .select("entity", "term", share(F.col("n_te")).alias("share")).where(F.col("share") >= alpha)
    return pairs.join(strong, ["entity", "term"]).groupBy("node", "term").agg(F.max("share").alias("share"))


def find_personal_data(docs: DataFrame, carry: list[str] | None = None, text: str = "text", alpha: float = ALPHA,
                       smoothing: float = SMOOTHING) -> DataFrame:
    """The ``carry`` columns of ``docs`` (all by default) plus ``base`` and ``terms`` (arrays of start, stop,
    kind; terms with their share instead), in code points."""
    carry = docs.columns if carry is None else carry
    found = with_base_spans(docs, carry, text)
    none = F.array().cast("array<struct<start:int,stop:int,share:double>>")
    plain = found.where(F.size("keys") == 0).select("_row", "base", none.alias("terms"))
    sided = found.where(F.size("keys") > 0).withColumn("node", F.col("_row._node"))
    private = landed(sided.groupBy("node").agg(F.count(F.lit(1)).alias("copies"), F.first("keys").alias("keys"), F.first("words").alias("words")), "pii-texts")
    strong = disclosing_terms(private, docs, text, alpha, smoothing)
    # only texts with personal data are joined; mentions are looked up once for all copies of a text
    hits = landed(private.select("node", F.inline("words")).join(strong, ["node", "term"]).groupBy("node").agg(
        F.sort_array(F.collect_list(F.struct("start", "stop", "share"))).alias("terms")), "pii-terms")
    joined = sided.select("node", "_row", "base").join(hits, "node", "left").select("_row", "base", F.coalesce("terms", none).alias("terms"))
    return unpacked(plain.unionByName(joined), carry, ["base", "terms"])


def digest(start, stop, kind):
    return F.concat_ws(":", kind, start.cast("string"), stop.cast("string"))


def sanitised(text: str, base, terms) -> str:
    """``text`` with base spans as <KIND>, strong terms removed and weaker ones generalised by shape."""
    parts = [(s["start"], s["stop"], f"<{s['kind'].upper()}>") for s in base]
    for t in terms:
        word = text[t["start"]:t["stop"]]
        shape = "<NUMBER>" if any(c.isdigit() for c in word) else "<NAME>" if word[:1].isupper() else "<TERM>"
        parts.append((t["start"], t["stop"], "" if t["share"] >= REMOVE else shape))
    out, end = [], 0
    for s, e, put in sorted(parts):
        if s >= end:
            out += [text[end:s], put]
        end = max(end, e)
    return "".join([*out, text[end:]])


def sanitise(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` with the text sanitised."""
    found = find_personal_data(docs, text=text, **options)
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [None if t is None else sanitised(t, s, w) for t, s, w in
                     zip(b.column(text).to_pylist(), b.column("base").to_pylist(), b.column("terms").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if n == text else b.column(n) for n in schema.names], names=schema.names)
    return found.mapInArrow(run, schema)


def op10_personal_data(spark, sf_dir: str) -> DataFrame:
    found = find_personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"), carry=["doc_id"])
    count = lambda kind: F.size(F.filter("base", lambda x: x.getField("kind") == kind)).cast("long").alias(f"n_{kind}")
    listed = lambda spans: F.array_join(F.transform(spans, lambda x: digest(
        x.getField("start"), x.getField("stop"), x.getField("kind"))), ",")
    order = F.array(*[F.lit(k) for k in KINDS])
    keyed = lambda x: F.struct(x.getField("start").alias("start"), F.array_position(order, x.getField("kind")).alias("k"),
                               x.getField("stop").alias("stop"), x.getField("kind").alias("kind"))
    terms = F.transform("terms", lambda x: F.struct(x.getField("start").alias("start"), x.getField("stop").alias("stop"), F.lit("term").alias("kind")))
    every = F.sort_array(F.transform(F.concat("base", terms), keyed))
    return found.select("doc_id", *[count(k) for k in KINDS[:4]], F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
                        listed(every).alias("spans"))
