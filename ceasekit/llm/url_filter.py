"""Operator 5: URL filters by a temporal list join.

Dated list entries (key, category, day, add or remove) become validity intervals. A capture is
judged by the entries that are active at its fetch time: those of its URL without scheme,
query and fragment, of its host, and of every parent domain of the host.

The as-of join runs once per distinct (key, day), not per capture, so that a host with a third
of all captures costs a row per day. Interval and probe meet on (key, 32-day block), which
bounds what is compared for one key. List, pages and probes are written once each, as several steps
read them. Spark splits skewed partitions of the last join.

Defined cases: a null URL or time, or a URL without a host, matches nothing; several adds in a
row are one interval; on one day an add wins over a remove; an interval holds its first day
and not its last; a remove without an add does nothing; repeated captures are judged alike;
empty captures give an empty result and an empty list blocks nothing; a column named like an
added one is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ceasekit.llm.common import landed, packed, table, unpacked

BLOCK_DAYS = 32
FOREVER = 2_000_000      # day number of an open end


def host_of(url: Column) -> Column:
    """Lower-cased host without user and port; null when there is none."""
    found = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.when(found != "", found)


def url_keys(url: Column) -> Column:
    """What an entry for this capture may name: host and path, host, parent domains of two labels or more."""
    host = host_of(url)
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*(/[^?#]*)", 1)
    labels = F.split(host, r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))),
                          lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    return F.when(host.isNotNull(), F.array_distinct(F.concat(F.array(host), parents, F.array(F.concat(host, path)))))


def day_number(time: Column) -> Column:
    return F.datediff(time.cast("date"), F.lit("1970-01-01").cast("date"))


def validity(entries: DataFrame) -> DataFrame:
    """(key, category, day, added) -> (key, category, valid_from, valid_to), disjoint per key and category.
    Events are first reduced to one per day."""
    daily = entries.where("key IS NOT NULL AND day IS NOT NULL").groupBy("key", "category", "day").agg(F.max("added").alias("added"))
    order = Window.partitionBy("key", "category").orderBy("day")
    turns = daily.withColumn("was", F.lag("added").over(order)).where("was IS NULL OR was <> added")
    spans = turns.withColumn("valid_to", F.coalesce(F.lead("day").over(order), F.lit(FOREVER))).where("added")
    return spans.select("key", "category", F.col("day").alias("valid_from"), "valid_to")


def active_entries(probes: DataFrame, spans: DataFrame) -> DataFrame:
    """As-of join: (key, day) -> (key, day, categories active on that day)."""
    ends = probes.agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
    lo, hi = ends.select("lo").scalar(), ends.select("hi").scalar()
    first, last = F.greatest("valid_from", lo), F.least(F.col("valid_to") - 1, hi)
    block = lambda day: F.floor(day / BLOCK_DAYS).cast("int")
    cut = spans.withColumn("first", first).withColumn("last", last).where("first <= last") \
        .withColumn("block", F.explode(F.sequence(block(F.col("first")), block(F.col("last")))))
    at = probes.withColumn("block", block(F.col("day")))
    hits = at.join(cut, ["key", "block"]).where("day >= valid_from AND day < valid_to")
    return hits.groupBy("key", "day").agg(F.collect_set(F.coalesce("category", F.lit(""))).alias("categories"))


def filter_urls(captures: DataFrame, entries: DataFrame, url: str = "url", time: str = "fetched") -> DataFrame:
    """``captures`` plus host, blocked, n_entries (active entries that match) and categories.

    ``entries``: key, category, day (number of days since 1970), added (boolean)."""
    rows = captures.select(packed(captures), host_of(F.col(f"`{url}`")).alias("host"),
                           F.regexp_extract(F.col(f"`{url}`"), r"^[^?#]*", 0).alias("_page"), day_number(F.col(f"`{time}`")).alias("_day"))
    pages = landed(rows.where("host IS NOT NULL AND _day IS NOT NULL").select("_page", F.col("_day").alias("day")).distinct(), "url-pages") \
        .withColumn("key", F.explode(url_keys(F.col("_page"))))
    spans = landed(validity(entries), "url-spans")
    # one row per key and day, of keys that the list names at all: a host of a third of all captures is a row per day
    # (written first, as Spark would move the semi join below the distinct)
    probes = landed(pages.select("key", "day").distinct(), "url-probes").join(spans.select("key").distinct(), "key", "left_semi")
    active = active_entries(probes, spans)
    verdicts = pages.join(active, ["key", "day"]).groupBy(F.col("_page").alias("_p"), F.col("day").alias("_d")).agg(
        F.sum(F.size("categories")).alias("n"), F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list("categories")))), ",").alias("c"))
    out = rows.join(verdicts, (F.col("_page") == F.col("_p")) & (F.col("_day") == F.col("_d")), "left")
    out = out.withColumn("blocked", F.col("n").isNotNull()).withColumn("n_entries", F.coalesce("n", F.lit(0)).cast("long")) \
        .withColumn("categories", F.coalesce("c", F.lit("")))
    return unpacked(out, captures.columns, ["host", "blocked", "n_entries", "categories"])


def dated_captures(pages: DataFrame) -> DataFrame:
    """The pages with a fetch time in 2024, spread by a checksum of their id."""
    return pages.select("page_id", "url", F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(
        F.crc32(F.col("page_id").cast("string").cast("binary")), F.lit(366)).cast("int")).alias("fetched"))


def dated_entries(pages: DataFrame) -> DataFrame:
    """A dated list about what the pages link to: each host is listed twice (and delisted), each
    parent domain once, each page of a host on https once for good; days come from checksums."""
    start = 19_723           # 2024-01-01
    days = lambda salt, n: F.pmod(F.crc32(F.concat(F.col("key"), F.lit(salt)).cast("binary")), F.lit(n)).cast("int")
    hosts = pages.select(host_of(F.col("url")).alias("key")).where("key IS NOT NULL").distinct()
    event = lambda category, day, added: F.struct(F.lit(category).alias("category"), day.alias("day"), F.lit(added).alias("added"))
    a = F.lit(start) + days("a", 120)
    b = a + days("b", 60) + 1
    c = b + days("c", 90) + 1
    own = hosts.select("key", F.inline(F.array(event("ads", a, True), event("ads", b, False), event("ads", c, True), event("adult", c, True),
                                               event("adult", c + days("d", 60) + 1, False))))
    domains = hosts.select(F.regexp_extract("key", r"([^.]+\.[^.]+)$", 1).alias("key")).where("key <> ''").distinct()
    wide = domains.select("key", F.inline(F.array(event("spam", F.lit(start) + days("e", 300), True),
                                                  event("spam", F.lit(start) + days("e", 300) + 20, False))))
    secure = pages.where(F.col("url").startswith("https://")).select(F.element_at(url_keys(F.col("url")), -1).alias("key")) \
        .where("key IS NOT NULL").distinct().select("key", F.inline(F.array(event("page", F.lit(start) + days("f", 366), True))))
    return own.union(wide).union(secure)


def op5_url_filter(spark, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    out = filter_urls(dated_captures(pages), dated_entries(pages))
    return out.select("page_id", "host", F.date_format("fetched", "yyyy-MM-dd").alias("fetched"), "blocked", "n_entries", "categories")

