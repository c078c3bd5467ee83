"""Running totals over any number of ordered rows, and walks along links, without a task that holds all rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ceasekit.sources.io import scratch_path

#: kind -> (aggregate, how the total of earlier partitions joins the running value of this one)
KINDS = {
    "sum": (F.sum, lambda before, here: F.coalesce(before + here, here, before)),
    "min": (F.min, F.least),
    "max": (F.max, F.greatest),
}


def landed(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def prefix_scan(df: DataFrame, order: Sequence[str | Column], running: Mapping[str, tuple[str, Column]], partitions: int | None = None) -> DataFrame:
    """``df`` with running aggregates, each row included, in the order of ``order``; ``running`` is
    {column: ("sum" | "min" | "max", value)}. Nulls are left out of an aggregate. ``order`` should tell rows
    apart: equal rows follow each other in any order.

    Two passes: the rows are range-partitioned by the order and written with the number of their partition;
    each partition is scanned by itself, and what earlier partitions add up to (one row per partition) is
    joined to it. No task sees more than its range."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    rows = landed(df.withColumns({f"_v{i}": v for i, (_, v) in enumerate(running.values())}).repartitionByRange(n, *order)
                  .withColumn("_part", F.spark_partition_id()), "ranges")
    agg = [KINDS[kind][0] for kind, _ in running.values()]
    totals = rows.groupBy("_part").agg(*[a(f"_v{i}").alias(f"_t{i}") for i, a in enumerate(agg)])
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)          # over one row per partition
    before = totals.select(F.col("_part").alias("_p"), *[a(f"_t{i}").over(earlier).alias(f"_b{i}") for i, a in enumerate(agg)])
    here = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    scanned = rows.withColumns({f"_r{i}": a(f"_v{i}").over(here) for i, a in enumerate(agg)})
    joined = scanned.join(F.broadcast(before), F.col("_part") == F.col("_p"))             # at most ``partitions`` rows
    out = {name: KINDS[kind][1](F.col(f"_b{i}"), F.col(f"_r{i}")) for i, (name, (kind, _)) in enumerate(running.items())}
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], *[v.alias(k) for k, v in out.items()])


def reached(links: DataFrame, start: int) -> DataFrame:
    """(at): every place on the way from ``start`` along ``links`` (at, next; next > at, one link per place).

    Pointer doubling: the links are joined with themselves, so each round covers twice as many steps and the
    rounds grow with the logarithm of the way's length. Each round is written, which cuts its lineage."""
    spark = links.sparkSession
    links = landed(links.select(F.col("at").cast("long"), F.col("next").cast("long")), "links")
    found = spark.range(start, start + 1).select(F.col("id").alias("at"))
    while True:
        further = landed(found.join(links, "at").select(F.col("next").alias("at")), "reached")
        if further.isEmpty():
            return found
        found = landed(found.unionByName(further), "reached")
        after = links.select(F.col("at").alias("next"), F.col("next").alias("_after"))
        links = landed(links.join(after, "next").select("at", F.col("_after").alias("next")), "links")
