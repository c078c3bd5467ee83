"""Operator 4: benchmark decontamination by size-partitioned MinHash containment search.

A test item is contained in a document when at least ``threshold`` of its distinct 5-word
shingles occur there. The items are partitioned by size. An item's sketch is its
floor((1 - t) * upper) + 1 smallest shingle hashes, ``upper`` being the largest size of its
partition: with a containment of t or more at least one of them is in the document, so the
search loses nothing. A document is only searched for the partitions whose items can be
contained in it at all. Candidates are verified by their exact shingles (as text).

A benchmark of at most ``PLAN_BYTES`` of text, measured first, travels to the documents as
constants and nothing is shuffled. A larger one is joined on the sketch hashes instead, by the
same rules; neither the driver nor a task then holds it whole.

Words are lower-cased runs of non-space. Defined cases: null and empty texts, and texts or
items of fewer than five words, have no shingles and match nothing; repeated rows and items
are judged alike; an empty benchmark leaves every document; extra columns are carried.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ceasekit.llm.common import landed, let, packed, split_words, table, unpacked

SHINGLE = 5
THRESHOLD = 0.8
#: Items are held in the plan in blocks of this many; each block is searched in the same scan.
BLOCK_ITEMS = 2_000
#: Items with at most this much text in all (their shingles have about five times as much) go into the plan.
PLAN_BYTES = 4 << 20


def shingles(words: Column, join) -> Column:
    """The 5-word shingles in order: pairs, then pairs of pairs, then the fifth word, each by one
    ``zip_with`` a shifted copy (a slice per position would copy the text for each word)."""
    after = lambda c, k: F.slice(c, k + 1, F.greatest(F.size(c) - k, F.lit(0)))

    def chain(w: Column) -> Column:
        two = F.zip_with(w, after(w, 1), join)
        four = let(two, lambda t: F.zip_with(t, after(t, 2), join))
        return F.slice(F.zip_with(four, after(w, 4), join), 1, F.greatest(F.size(w) - (SHINGLE - 1), F.lit(0)))
    return let(words, chain)


def joined(a: Column, b: Column) -> Column:
    return F.concat_ws(" ", a, b)


def shingle_texts(words: Column) -> Column:
    """Distinct 5-word shingles as text."""
    return F.array_distinct(shingles(words, joined))


def shingle_hashes(hashes: Column) -> Column:
    """64-bit hashes of the 5-word shingles, from word hashes."""
    return shingles(hashes, lambda a, b: F.xxhash64(a, b))


def with_words(df: DataFrame, text: str) -> DataFrame:
    return df.withColumn("_c_words", split_words(F.lower(F.col(f"`{text}`"))))


def hashed_shingles() -> Column:
    return shingle_hashes(F.transform("_c_words", lambda x: F.xxhash64(x)))


def least_common(size: int, threshold: float) -> int:
    """Shingles of an item of ``size`` that a document must have."""
    return math.ceil(threshold * size - 1e-9)


def paired_items(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """(id, pairs: the item's distinct shingles as (hash, text), by hash) of the items that have any."""
    pairs = F.array_distinct(F.arrays_zip(hashed_shingles().alias("h"), shingles(F.col("_c_words"), joined).alias("s")))
    return with_words(items, text).select(F.col(f"`{item_id}`").alias("id"), F.sort_array(pairs).alias("pairs")).where(F.size("pairs") > 0)


def sketched_items(items: DataFrame, threshold: float = THRESHOLD, item_id: str = "item_id", text: str = "text") -> list[list[dict]]:
    """Blocks of items with size, sketch and shingles, for a benchmark within ``PLAN_BYTES``."""
    blocks: list[list[dict]] = [[]]
    for r in paired_items(items, item_id, text).toLocalIterator():
        upper = (1 << len(r.pairs).bit_length()) - 1          # sizes from 2^k to 2^(k + 1) - 1 make a partition
        sketch = r.pairs[:math.floor((1 - threshold) * upper + 1e-9) + 1]
        if len(blocks[-1]) == BLOCK_ITEMS:
            blocks.append([])
        blocks[-1].append({"id": r.id, "n": len(r.pairs), "need": least_common(len(r.pairs), threshold),
                           "sketch": [x[0] for x in sketch], "probes": [max(x[1].split(" "), key=len) for x in sketch],
                           "shingles": [x[1] for x in r.pairs]})
    return [b for b in blocks if b]


def constant(values: list, kind: str) -> Column:
    """A long literal array as one text that the optimizer folds to a constant."""
    return F.split(F.lit("\n".join(map(str, values))), "\n").cast(f"array<{kind}>")


def matches(block: list[dict], id_type: str) -> tuple[Column, Column]:
    """(whether any item of the block is a candidate, the contained items) for rows with shingles."""
    size = F.size("_c_shingles")
    sketches, upto = F.array().cast("array<bigint>"), []
    for bits in sorted({x["n"].bit_length() for x in block}):
        upto = upto + [h for x in block if x["n"].bit_length() == bits for h in x["sketch"]]
        least = least_common(1 << (bits - 1), min(x["need"] / x["n"] for x in block if x["n"].bit_length() == bits))
        sketches = F.when(size >= least, constant(sorted(set(upto)), "bigint")).otherwise(sketches)
    items = F.array(*[F.struct(F.lit(x["id"]).cast(id_type).alias("id"), F.lit(x["n"]).alias("n"), F.lit(x["need"]).alias("need"),
                               constant(x["sketch"], "bigint").alias("sketch"), constant(x["shingles"], "string").alias("shingles"))
                      for x in block])
    hits = F.array_intersect("_c_shingles", sketches)
    texts = shingle_texts(F.col("_c_words"))

    def verified(h: Column, t: Column) -> Column:
        found = F.filter(items, lambda x: F.arrays_overlap(x.getField("sketch"), h))
        counted = F.transform(found, lambda x: F.struct(
            x.getField("id").alias("item_id"), x.getField("n").alias("n_shingles"), x.getField("need").alias("need"),
            F.size(F.array_intersect(x.getField("shingles"), t)).alias("n_common")))
        return F.filter(counted, lambda x: x.getField("n_common") >= x.getField("need"))

    bound = F.transform(F.array(F.struct(hits.alias("h"), texts.alias("t"))),
                        lambda x: verified(x.getField("h"), x.getField("t")))
    return F.coalesce(F.arrays_overlap("_c_shingles", sketches), F.lit(False)), F.get(bound, F.lit(0))


def fits_plan(items: DataFrame, text: str) -> bool:
    return (items.agg(F.sum(F.octet_length(F.col(f"`{text}`")).cast("long")).alias("b")).first().b or 0) <= PLAN_BYTES


def found_type(items: DataFrame, item_id: str) -> str:
    return f"array<struct<item_id:{items.schema[item_id].dataType.simpleString()},n_shingles:int,need:int,n_common:int>>"


def joined_items(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, text: str = "text",
                 item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """:func:`contained_items` for a benchmark of any size: equal texts are one node, whose distinct
    shingle hashes meet the sketches; candidates are verified by joins on the item and the node."""
    body = F.col(f"`{text}`")
    node = F.md5(F.coalesce(body, F.lit("")))
    n = F.size("pairs")
    upper = F.pow(F.lit(2.0), F.length(F.bin(n.cast("long")))) - 1          # the largest size of the item's partition
    listed = landed(paired_items(items, item_id, item_text).select(
        F.expr("uuid()").alias("item"), "id", n.alias("n"), F.ceil(n * threshold - 1e-9).cast("int").alias("need"),
        F.floor(upper * (1 - threshold) + 1e-9).cast("int").alias("k"), "pairs"), "decontaminate-items")
    sketches = listed.select("item", F.explode(F.slice(F.transform("pairs", lambda x: x.getField("h")), F.lit(1), F.col("k") + 1)).alias("h"))
    hashes = with_words(docs.select(body.alias("text")), "text").select(
        F.md5(F.coalesce("text", F.lit(""))).alias("node"), F.explode(F.array_distinct(hashed_shingles())).alias("h"))
    candidates = landed(hashes.join(sketches, "h").select("node", "item").distinct(), "decontaminate-candidates")
    nodes = docs.select(node.alias("node"), body.alias("text")).join(candidates.select("node").distinct(), "node", "left_semi") \
        .groupBy("node").agg(F.first("text").alias("text"))
    shingled = with_words(nodes, "text").select("node", shingle_texts(F.col("_c_words")).alias("texts"))
    items_of = listed.select("item", "id", "n", "need", F.transform("pairs", lambda x: x.getField("s")).alias("shingles"))
    counted = candidates.join(items_of, "item").join(shingled, "node").select(
        "node", "id", "n", "need", F.size(F.array_intersect("shingles", "texts")).alias("common")).where("common >= need")
    found = counted.groupBy("node").agg(F.collect_list(F.struct(
        F.col("id").alias("item_id"), F.col("n").alias("n_shingles"), "need", F.col("common").alias("n_common"))).alias("found"))
    found = landed(found, "decontaminate-found")
    rows = docs.select(packed(docs), node.alias("node")).join(found, "node", "left")
    empty = F.array().cast(found_type(items, item_id))
    return unpacked(rows.withColumn("_c_found", F.coalesce("found", empty)), docs.columns, ["_c_found"])


def contained_items(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, text: str = "text",
                    item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``docs`` plus working column ``_c_found``: the items contained in the row's text. Nothing is
    shuffled when the items fit the plan: the sketches travel to the documents."""
    if not fits_plan(items, item_text):
        return joined_items(docs, items, threshold, text, item_id, item_text)
    id_type = items.schema[item_id].dataType.simpleString()
    empty = F.array().cast(found_type(items, item_id))
    blocks = sketched_items(items, threshold, item_id, item_text)
    # a text with a sketched shingle has its longest word: most texts have none and are not shingled at all
    probes = constant(sorted({w for b in blocks for x in b for w in x["probes"]}), "string") if blocks else F.array().cast("array<string>")
    df = with_words(docs, text).withColumn("_c_shingles", F.when(F.arrays_overlap("_c_words", probes), F.array_distinct(hashed_shingles()))
                                           .otherwise(F.array().cast("array<bigint>")))
    found = empty
    for block in blocks:
        candidate, contained = matches(block, id_type)
        found = F.concat(found, F.when(candidate, contained).otherwise(empty))
    return df.withColumn("_c_found", found).drop("_c_words", "_c_shingles")


def contaminations(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """One row per document and contained item: the id, item_id, n_shingles of the item, n_common."""
    pairs = contained_items(docs, items, **options).select(F.col(f"`{id_col}`"), F.explode("_c_found").alias("x"))
    return pairs.select(F.col(f"`{id_col}`"), "x.item_id", F.col("x.n_shingles").cast("long").alias("n_shingles"),
                        F.col("x.n_common").cast("long").alias("n_common"))


def decontaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that contain no item, with their columns."""
    return contained_items(docs, items, **options).where(F.size("_c_found") == 0).drop("_c_found")


def op4_decontaminate(spark, sf_dir: str) -> DataFrame:
    return contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP4_SQL = r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') AS w FROM documents WHERE text IS NOT NULL),
iw AS (SELECT item_id, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') AS w FROM benchmark WHERE text IS NOT NULL),
ds AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
       FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1))) AS i FROM dw)),
si AS (SELECT DISTINCT item_id, array_to_string(w[i:i + 4], ' ') AS s
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 3, 1))) AS i FROM iw)),
n AS (SELECT item_id, count(*) AS n_shingles FROM si GROUP BY item_id)
SELECT ds.doc_id, si.item_id, n.n_shingles, count(*) AS n_common
FROM ds JOIN si ON ds.s = si.s JOIN n ON n.item_id = si.item_id
GROUP BY ds.doc_id, si.item_id, n.n_shingles
HAVING count(*) >= ceil(0.8 * n.n_shingles - 1e-9)
"""
