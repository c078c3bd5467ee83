"""Operator 3: quality rules by distribution divergence.

Base counts (words, symbols, repeated lines, repeated 3-word windows) reject a text by fixed
rules. The rest is judged by its histograms of character classes and of common words, each
compared with the reference of its language by the Jensen-Shannon distance. References are
averages over all documents of the language that are long enough; a text too short for a
stable histogram is not judged by it. A reference holds few common words, so even a text without
any is not far from it: the limit by words is a share of that text's distance (and never above
``MAX_WORD_DISTANCE``). A reference without a common word sets no such limit.

Defined cases: a null text counts as empty and fails the base rules; a language without a
common-word list (or null) is compared with the average over all languages, by character
classes only; repeated rows are judged alike; with an empty table there are no references
and an empty result; a column named like an added one is replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ceasekit.llm.common import SPACE, landed, let, split_words, table, with_columns

# The common words of each language.
COMMON_WORDS = {
    "en": ["the", "of", "and", "to", "a", "in", "is", "that", "it", "on", "for", "with"],
    "de": ["der", "die", "und", "den", "von", "zu", "das", "mit", "ist", "im", "nicht", "eine"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "pour"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "del", "se", "las", "por"],
}
# Character classes counted by a pattern; white space and the rest make two more.
CLASSES = [r"[A-Z\u00C0-\u00DE]+", r"""[0-9.,;:!?'"()\-]+""", r"[#*$%&|<>]+"]
SYMBOLS = 2            # the class that n_symbols counts
ANY = "*"              # the reference over all languages
SCALE = 1_000_000      # shares are whole millionths, so that sums do not depend on their order
MIN_WORDS = 50         # base rule and guard of the word histogram
MAX_REPEAT_PERCENT = 50
MIN_CHARS = 200        # guard of the character histogram
MAX_CLASS_DISTANCE = 0.32
MAX_WORD_DISTANCE = 0.30
MAX_WORD_SHARE = 0.8   # of the distance that a text without any common word has


def with_counts(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``docs`` plus working columns ``_q_*``: the base counts and both histograms.

    Written as a ladder of projections: what several later columns need is evaluated once, and
    splitting, sorting and distinct run as generated code."""
    body, words = F.col("_q_body"), F.col("_q_words")
    df = docs.withColumn("_q_body", F.coalesce(F.col(f"`{text}`"), F.lit(""))) \
        .withColumn("_q_words", split_words(body)).withColumn("_q_n", F.size(words)) \
        .withColumn("_q_chars", F.length(body)).withColumn("_q_word_chars", F.length(F.array_join(words, "")))
    df = df.withColumns({f"_q_class{i}": F.col("_q_chars") - F.length(F.regexp_replace(body, p, "")) for i, p in enumerate(CLASSES)})
    df = df.withColumn("_q_class", shares(F.array(*[F.col(f"_q_class{i}") for i in range(len(CLASSES))],
                                                  F.col("_q_chars") - F.col("_q_word_chars")), F.col("_q_chars")))
    common = F.lit(None).cast("array<string>")
    only = lambda listed: F.filter(words, lambda x: x.isin(listed))
    for code, listed in COMMON_WORDS.items():
        common = F.when(F.col(f"`{lang}`") == code, only(listed)).otherwise(common)
    df = df.withColumn("_q_common", common)
    found = F.lit(None).cast("array<int>")
    for code, listed in COMMON_WORDS.items():
        found = F.when(F.col(f"`{lang}`") == code, F.array(*[
            F.size("_q_common") - F.size(F.array_remove("_q_common", w)) for w in listed])).otherwise(found)
    df = df.withColumn("_q_found", found).withColumn("_q_word", shares(F.col("_q_found"), F.col("_q_n")))
    df = df.withColumn("_q_lines", F.filter(F.split(body, "\n"), lambda x: x.rlike(f"[^{SPACE}]")))
    return with_repeats(df.withColumn("_q_dup_lines", F.size("_q_lines") - F.size(F.array_distinct("_q_lines"))))


def with_repeats(df: DataFrame) -> DataFrame:
    """``_q_repeat``: words that lie in a 3-word window found twice or more in the text, the first included.

    Windows are hashed to 64 bits. Where a text has equal hashes, its windows are sorted by hash, then by their
    words, then by place, so that equal windows are neighbours whatever the hash does and however long the text
    is (n log n, no pairs). Neighbours are paired by ``zip_with`` a shifted copy, which costs far less than
    indexed access."""
    words = F.col("_q_words")
    after = lambda c, k: F.slice(c, k + 1, F.greatest(F.size(c) - k, F.lit(0)))
    threes = lambda c, op: F.slice(F.zip_with(F.zip_with(c, after(c, 1), op), after(c, 2), op), 1, F.greatest(F.col("_q_n") - 2, F.lit(0)))
    df = df.withColumn("_q_hash", F.transform(words, lambda x: F.xxhash64(x)))
    df = df.withColumn("_q_window", threes(F.col("_q_hash"), lambda a, b: F.xxhash64(a, b)))
    placed = F.zip_with("_q_window", threes(words, lambda a, b: F.concat_ws(" ", a, b)), lambda h, w: F.struct(h.alias("h"), w.alias("w")))
    placed = F.transform(placed, lambda x, i: F.struct(x.getField("h").alias("h"), x.getField("w").alias("w"), i.alias("i")))
    df = df.withColumn("_q_placed", F.when(F.size(F.array_distinct("_q_window")) < F.size("_q_window"), placed))
    df = df.withColumn("_q_sorted", F.sort_array(F.coalesce("_q_placed", F.array().cast("array<struct<h:bigint,w:string,i:int>>"))))
    same = lambda a, b: (a.getField("h") == b.getField("h")) & (a.getField("w") == b.getField("w"))
    pairs = F.zip_with("_q_sorted", after(F.col("_q_sorted"), 1), lambda a, b: F.when(same(a, b), F.array(a.getField("i"), b.getField("i"))))
    df = df.withColumn("_q_at", F.sort_array(F.array_distinct(F.flatten(F.filter(pairs, lambda v: v.isNotNull())))))
    steps = F.zip_with("_q_at", after(F.col("_q_at"), 1), lambda x, y: F.least(F.lit(3), F.coalesce(y - x, F.lit(3))))
    return df.withColumn("_q_repeat", F.aggregate(steps, F.lit(0).cast("long"), lambda total, x: total + x))


def shares(counts: Column, total: Column) -> Column:
    """Millionths, rounded down, of each count in the total, and the rest."""
    parts = F.transform(counts, lambda c: F.floor(c.cast("long") * SCALE / F.greatest(total, F.lit(1))))
    return let(parts, lambda p: F.concat(p, F.array(F.lit(SCALE).cast("long") - F.aggregate(p, F.lit(0).cast("long"), lambda a, x: a + x))))


FEATURES = ["_q_n", "_q_chars", "_q_word_chars", f"_q_class{SYMBOLS}", "_q_dup_lines", "_q_repeat", "_q_class", "_q_word"]


def features(docs: DataFrame, carry: list[str] | None = None, text: str = "text", lang: str = "lang") -> DataFrame:
    """The ``carry`` columns of ``docs`` (all by default) and the counts of each text, written once,
    since the references need all of them before any row can be judged."""
    df = docs.withColumn("_q_lang", F.when(F.col(f"`{lang}`").isin(list(COMMON_WORDS)), F.col(f"`{lang}`")))
    carried = [F.col(f"`{c}`") for c in (docs.columns if carry is None else carry)]
    return landed(with_counts(df, text, "_q_lang").select(*carried, "_q_lang", *FEATURES), "quality-features")


def language_references(counted: DataFrame) -> list[tuple[str, str, list[int]]]:
    """(language, 'class' or 'word', summed millionths) over all documents that pass the length guards.

    One aggregate over the whole table; its result has a row per listed language, so it is
    bounded by :data:`COMMON_WORDS`, not by the data."""
    width, wide = len(CLASSES) + 2, max(map(len, COMMON_WORDS.values())) + 1
    rows = counted.where((F.col("_q_chars") >= MIN_CHARS) & (F.col("_q_n") >= MIN_WORDS))
    got = rows.groupBy(F.coalesce("_q_lang", F.lit(ANY)).alias("lang")).agg(
        *[F.sum(F.get("_q_class", F.lit(i))).alias(f"c{i}") for i in range(width)],
        *[F.sum(F.get("_q_word", F.lit(i))).alias(f"w{i}") for i in range(wide)]).collect()
    out = []
    for r in got:
        out.append((r.lang, "class", [r[f"c{i}"] for i in range(width)]))
        if r.lang != ANY:
            out.append((r.lang, "word", [r[f"w{i}"] for i in range(len(COMMON_WORDS[r.lang]) + 1)]))
    if got:
        out = [x for x in out if x[0] != ANY]
        out.append((ANY, "class", [sum(r[f"c{i}"] for r in got) for i in range(width)]))
    return out


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (base 2, 0 to 1) of two histograms of equal length, each summing to 1."""
    def term(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(a * 2 / (a + b))).otherwise(F.lit(0.0))

    terms = F.zip_with(p, q, lambda a, b: term(a, b) + term(b, a))
    return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda s, x: s + x) / 2, F.lit(0.0)))


def reference_column(references, kind: str, lang: Column) -> Column:
    out = F.lit(None).cast("array<double>")
    for code, what, sums in sorted(references):
        total = sum(sums)
        if what == kind and total:
            q = F.array(*[F.lit(x / total) for x in sums])
            out = F.coalesce(out, q) if code == ANY else F.when(lang == code, q).otherwise(out)
    return out


def bare_distance(reference: list[float]) -> float:
    """Jensen-Shannon distance between a word histogram and that of a text without any common word."""
    *listed, rest = reference
    terms = [*listed, rest * math.log2(rest * 2 / (1 + rest)) if rest else 0.0, math.log2(2 / (1 + rest))]
    return math.sqrt(max(sum(terms) / 2, 0.0))


def word_limit(references, lang: Column, most: float, share: float) -> Column:
    """The largest word distance of a kept text of a language; null if its reference has no common word."""
    out = F.lit(None).cast("double")
    for code, what, sums in sorted(references):
        if what == "word" and sum(sums[:-1]):
            out = F.when(lang == code, F.lit(min(most, share * bare_distance([x / sum(sums) for x in sums])))).otherwise(out)
    return out


def quality_rules(docs: DataFrame, references=None, carry: list[str] | None = None, text: str = "text", lang: str = "lang",
                  max_class_distance: float = MAX_CLASS_DISTANCE, max_word_distance: float = MAX_WORD_DISTANCE,
                  max_word_share: float = MAX_WORD_SHARE) -> DataFrame:
    """The ``carry`` columns of ``docs`` (all by default) plus the base counts, base_failed,
    class_distance, word_distance and kept."""
    df = features(docs, carry, text, lang)
    if references is None:
        references = language_references(df)
    known = F.col("_q_lang")
    fraction = lambda c: F.transform(c, lambda v: v / F.lit(float(SCALE)))
    df = df.withColumn("_q_class_distance", F.when(F.col("_q_chars") >= MIN_CHARS, js_distance(
            fraction("_q_class"), reference_column(references, "class", known)))) \
        .withColumn("_q_word_distance", F.when(F.col("_q_n") >= MIN_WORDS, js_distance(
            fraction("_q_word"), reference_column(references, "word", known))))
    failed = (F.col("_q_n") < MIN_WORDS) | (F.col("_q_repeat") * 100 > F.col("_q_n") * MAX_REPEAT_PERCENT)
    near = (F.coalesce("_q_class_distance", F.lit(0.0)) <= max_class_distance) \
        & (F.coalesce("_q_word_distance", F.lit(0.0)) <= F.coalesce(
            word_limit(references, known, max_word_distance, max_word_share), F.lit(max_word_distance)))
    long = lambda c: F.col(c).cast("long")
    out = with_columns(df, {
        "n_words": long("_q_n"), "word_chars": long("_q_word_chars"), "n_symbols": long(f"_q_class{SYMBOLS}"),
        "n_dup_lines": long("_q_dup_lines"), "n_repeat_words": long("_q_repeat"), "base_failed": failed,
        "class_distance": F.col("_q_class_distance"), "word_distance": F.col("_q_word_distance"), "kept": ~failed & near})
    return out.drop(*[c for c in out.columns if c.startswith("_q_")])


def keep_good(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their columns."""
    return quality_rules(docs, **options).where("kept").select(*[F.col(f"`{c}`") for c in docs.columns])


def op3_quality_rules(spark, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), carry=["doc_id"]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
