"""Operator 8: Merkle fixity audit of WARC replicas.

Every record (its header line and payload) is hashed. Within a file, records are grouped by
ordered offset ranges of ``RANGE_BYTES``; a range's hash covers the offsets and hashes of its
records in order. ``FANOUT`` ranges make the next node, up to a root per file. Files are placed by a
hash of their name, and their roots are folded ``FANOUT`` ways by the digits of that hash up to one
root per replica. An audit compares the roots and descends only into branches that differ, level by
level; each level is one equi-join of the children of differing nodes.

No group is unbounded: a node has at most ``FANOUT`` children and a range at most RANGE_BYTES
records. Levels are written once, so a lost executor costs a task.

Defined cases: a null file, offset or record id is a value of its own, equal to itself only (records
without an offset are one range of their file); a null payload hashes differently from an empty one; a record missing from one
replica is reported as missing or extra; records repeated at one offset are hashed in the order
of their hashes; two empty replicas agree; other columns are not part of the audit.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ceasekit.llm.common import landed, table

RANGE_BYTES = 1 << 18
FANOUT = 16
FILE_RECORDS = 1_000     # records of a file in warc_records


def record_hash(url: Column, payload: Column) -> Column:
    head = F.concat(F.lit("WARC/1.1 "), F.coalesce(url, F.lit("-")), F.lit("\r\n"))
    return F.sha2(F.concat(head, F.coalesce(F.concat(F.lit("+"), payload), F.lit("-"))), 256)


def leaves(records: DataFrame) -> DataFrame:
    """(file, offset, record_id, url, payload) -> leaf nodes of the tree."""
    return records.select("file", "offset", "record_id", record_hash(F.col("url"), F.col("payload")).alias("hash"))


def fold(children: DataFrame, keys: list[str], place: str) -> DataFrame:
    """One node per key: the hash of its children's (place, hash) in order."""
    ordered = F.sort_array(F.collect_list(F.struct(F.col(place).cast("long").alias("p"), F.col("hash").alias("h"))))
    joined = F.array_join(F.transform(ordered, lambda x: F.concat(F.coalesce(x.getField("p").cast("string"), F.lit("-")), F.lit(":"), x.getField("h"))), ",")
    return children.groupBy(*keys).agg(F.sha2(joined, 256).alias("hash"))


def height(records: DataFrame) -> int:
    """Levels above the ranges that the longest file needs."""
    longest = records.agg(F.max(F.expr(f"offset div {RANGE_BYTES}")).alias("m")).first().m or 0
    levels = 1
    while FANOUT ** levels <= longest:
        levels += 1
    return levels


def tree(records: DataFrame, levels: int) -> list[DataFrame]:
    """Levels from the leaves up: (file, offset, record_id, hash), then (file, node, hash) for ranges and above."""
    out = [landed(leaves(records), "fixity-leaves")]
    ranges = out[0].withColumn("node", F.expr(f"offset div {RANGE_BYTES}"))
    out.append(landed(fold(ranges, ["file", "node"], "offset"), "fixity-ranges"))
    for _ in range(levels):
        below = out[-1].withColumnRenamed("node", "child").withColumn("node", F.expr(f"child div {FANOUT}"))
        out.append(landed(fold(below, ["file", "node"], "child"), "fixity-level"))
    return out


def forest(files: DataFrame, depth: int) -> list[DataFrame]:
    """Levels (node, hash) over the roots of all files, from ``depth`` hash digits down to the one root."""
    place = F.xxhash64(F.col("file").isNull(), F.col("file"))
    node = F.shiftrightunsigned(place, 64 - 4 * depth) if depth else F.lit(0).cast("long")
    rows = files.select(place.alias("child"), node.alias("node"), F.concat(F.coalesce(F.col("node").cast("string"), F.lit("-")), F.lit(":"), F.col("hash")).alias("hash"))
    out = [landed(fold(rows, ["node"], "child"), "fixity-forest")]
    for _ in range(depth):
        below = out[-1].select(F.col("node").alias("child"), F.expr(f"node div {FANOUT}").alias("node"), "hash")
        out.append(landed(fold(below, ["node"], "child"), "fixity-forest"))
    return out


def forest_depth(files: DataFrame) -> int:
    """Hash digits by which the files are parted, so that a node has FANOUT files on average at most."""
    n, depth = files.count(), 0
    while FANOUT ** (depth + 1) < n:
        depth += 1
    return min(depth, 15)


def same(keys: list[str]) -> Column:
    """Null-safe equality of the keys with their ``_b_`` counterparts."""
    return functools.reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_b_{k}")) for k in keys])


def differing(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Keys whose hashes differ or that one side lacks."""
    a = left.select(*keys, F.col("hash").alias("_l"))
    b = right.select(*[F.col(k).alias(f"_b_{k}") for k in keys], F.col("hash").alias("_r"))
    found = a.join(b, same(keys), "full_outer").where(~F.col("_l").eqNullSafe(F.col("_r")))
    return found.select(*[F.coalesce(k, f"_b_{k}").alias(k) for k in keys], "_l", "_r")


def within(level: DataFrame, bad: DataFrame, parent: dict[str, Column]) -> DataFrame:
    """Rows of a level whose parent (by the given expressions) is a bad node."""
    rows = level.select("*", *[c.alias(f"_p_{k}") for k, c in parent.items()])
    marked = bad.select(*[F.col(k).alias(f"_b_{k}") for k in parent])
    both = functools.reduce(lambda x, y: x & y, [F.col(f"_p_{k}").eqNullSafe(F.col(f"_b_{k}")) for k in parent])
    return rows.join(marked, both, "left_semi").drop(*[f"_p_{k}" for k in parent])


def audit(left: DataFrame, right: DataFrame) -> DataFrame:
    """Records that differ between two replicas: file, offset, record_id and state ('changed',
    'missing' from or 'extra' in the right one). Records: file, offset (long), record_id, url, payload."""
    levels = max(height(left), height(right))
    a, b = tree(left, levels), tree(right, levels)
    depth = max(forest_depth(a[-1]), forest_depth(b[-1]))
    over_a, over_b = forest(a[-1], depth), forest(b[-1], depth)
    bad = landed(differing(over_a[-1], over_b[-1], ["node"]).select("node"), "fixity-bad")
    if bad.isEmpty():                                               # the roots agree
        return a[0].limit(0).select("file", "offset", "record_id", F.lit("").alias("state"))
    up = F.expr(f"node div {FANOUT}")
    for x, y in zip(over_a[-2::-1], over_b[-2::-1], strict=True):
        bad = landed(differing(within(x, bad, {"node": up}), within(y, bad, {"node": up}), ["node"]).select("node"), "fixity-bad")
    place = F.xxhash64(F.col("file").isNull(), F.col("file"))
    of_file = F.shiftrightunsigned(place, 64 - 4 * depth) if depth else F.lit(0).cast("long")
    bad = landed(differing(*[within(t[-1], bad, {"node": of_file}) for t in (a, b)], ["file", "node"]).select("file", "node"), "fixity-bad")
    for level in range(len(a) - 2, 0, -1):
        below = [within(t[level], bad, {"file": F.col("file"), "node": up}) for t in (a, b)]
        bad = landed(differing(*below, ["file", "node"]).select("file", "node"), "fixity-bad")
    # repeated records at one place are compared in the order of their hashes
    order = Window.partitionBy("file", "offset", "record_id").orderBy("hash")
    ranged = {"file": F.col("file"), "node": F.expr(f"offset div {RANGE_BYTES}")}
    a0, b0 = (within(t[0], bad, ranged).withColumn("turn", F.row_number().over(order)) for t in (a, b))
    state = F.when(F.col("_r").isNull(), "missing").when(F.col("_l").isNull(), "extra").otherwise("changed")
    return differing(a0, b0, ["file", "offset", "record_id", "turn"]).select("file", "offset", "record_id", state.alias("state"))


def warc_records(pages: DataFrame) -> DataFrame:
    """The pages as records of files of :data:`FILE_RECORDS` ids each, with running byte offsets. A
    file is the unit of the window, so its records are a bounded group."""
    size = F.coalesce(F.octet_length("html"), F.lit(0)) + F.coalesce(F.octet_length("url"), F.lit(0)) + 13
    order = Window.partitionBy("file").orderBy("page_id").rowsBetween(Window.unboundedPreceding, -1)
    sized = pages.select(F.expr(f"page_id div {FILE_RECORDS}").alias("file"), "page_id", size.cast("long").alias("size"), "url", "html")
    return sized.select("file", F.coalesce(F.sum("size").over(order), F.lit(0)).cast("long").alias("offset"),
                        F.col("page_id").alias("record_id"), "url", F.col("html").alias("payload"))


def damaged(records: DataFrame) -> DataFrame:
    """A second replica as a careless copy leaves it: the symbol % is lost from payloads of under
    4,000 characters that have one, and records whose URL ends in #top are lost."""
    payload = F.when(F.length("payload") < 4000, F.replace("payload", F.lit("%%%"), F.lit("%%"))).otherwise(F.col("payload"))
    return records.where(~F.coalesce(F.col("url").endswith("#top"), F.lit(False))).withColumn("payload", payload)


def op8_fixity_audit(spark, sf_dir: str) -> DataFrame:
    records = warc_records(table(spark, sf_dir, "pages"))
    return audit(records, damaged(records)).select("file", "offset", F.col("record_id").alias("page_id"), "state")


OP8_SQL = r"""
WITH r AS (SELECT page_id, page_id // 1000 AS file, url, html,
             CAST(coalesce(sum(coalesce(strlen(html), 0) + coalesce(strlen(url), 0) + 13) OVER (
               PARTITION BY page_id // 1000 ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset"
           FROM pages)
SELECT file, "offset", page_id, CASE WHEN url LIKE '%#top' THEN 'missing' ELSE 'changed' END AS state
FROM r WHERE url LIKE '%#top' OR (length(html) < 4000 AND contains(html, '%%%'))
"""
