"""Landing, reading and exporting tables.

Paths for scratch output live under the session's ``spark.checkpoint.dir`` (the
shared folder a cluster names), never under a machine-local temp folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ceasekit.functions.keys import order_key
from ceasekit.session import ensure_checkpoint_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh directory name under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/ceasekit/{name}-{uuid.uuid4().hex[:12]}"


def table_format(spark: SparkSession) -> str:
    """``delta`` when its extension is configured on the session, else ``parquet``."""
    ext = spark.conf.get("spark.sql.extensions", "") or ""
    return "delta" if "DeltaSparkSessionExtension" in ext else "parquet"


def read_csv(spark: SparkSession, path: str, schema: StructType | str, header: bool = True,
             date_format: str = "yyyy-MM-dd") -> DataFrame:
    """CSV with a declared schema (no inference pass; ids stay text)."""
    return spark.read.schema(schema).option("header", header).option("dateFormat", date_format) \
        .option("mode", "PERMISSIVE").csv(path)


def read_csv_checked(spark: SparkSession, path: str, schema: StructType, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """S1 with a report: the typed rows, and per column how many values were present but did not
    convert. Fields are read as text: with declared types Spark nulls them without a count, and
    a pruned scan does not even parse the other columns."""
    text = ", ".join(f"`{f.name}` string" for f in schema.fields)
    return typed_cleanse(read_csv(spark, path, text, header), schema)


def read_parquet(spark: SparkSession, path: str, expect: StructType | None = None) -> DataFrame:
    """Parquet; with ``expect`` the embedded schema is checked (names and types)."""
    df = spark.read.parquet(path)
    if expect is not None:
        have = {f.name: f.dataType for f in df.schema.fields}
        bad = [f.name for f in expect.fields if have.get(f.name) != f.dataType]
        if bad:
            raise ValueError(f"columns missing or of another type: {bad}")
    return df


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """S3: a catalog table by (qualified) name."""
    return spark.table(name)


def create_namespace(spark: SparkSession, name: str, use: bool = False) -> None:
    """S5."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
    if use:
        spark.sql(f"USE {name}")


def drop_table(spark: SparkSession, name: str) -> None:
    """S6."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def write_table(df: DataFrame, name: str, path: str, fmt: str | None = None, mode: str = "overwrite",
                partition_by=None, bucket_by: tuple[int, str] | None = None, dealt: bool = False) -> DataFrame:
    """Write ``df`` as table ``name`` stored at ``path`` and return the table. ``bucket_by``
    (buckets, column) deals the rows into sorted buckets, one file each, so that joins and groups on the column
    need no shuffle of this table; a key must not hold a large part of the rows then (pre-aggregate first).
    ``dealt``: the rows come in these buckets already (``repartition`` by the column), they are not shuffled again.

    Reading a table while overwriting it is refused by Spark for file tables, so
    callers that rewrite a table use :func:`rewrite_deduplicated`.
    """
    spark = df.sparkSession
    w = df.write.mode(mode).format(fmt or table_format(spark)).option("path", path)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if bucket_by:
        n, key = bucket_by
        w = (df if dealt else df.repartition(n, key)).write.mode(mode).format(fmt or "parquet").option("path", path).bucketBy(n, key).sortBy(key)
    w.saveAsTable(name)
    return spark.table(name)


def export_csv(df: DataFrame, path: str) -> str:
    """Distributed CSV export with a header (one file per task, no driver copy)."""
    df.write.mode("overwrite").option("header", True).option("dateFormat", "yyyy-MM-dd").csv(path)
    return path


def rewrite_deduplicated(spark: SparkSession, name: str, key, order, root: str) -> DataFrame:
    """Keep the first row per key of table ``name``, with its partitioning.

    The result is written first (a new version under ``root``; nothing is overwritten while it is
    read) and then taken over by one catalog change. A Delta table commits the rewrite itself. A
    partitioned table, whose partitions the catalog may list by path, is exchanged by name and
    put back if that fails. Old versions stay for readers that still hold them."""
    from ceasekit.operators.relational import keep_first
    cur = spark.table(name)
    parts = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    fmt = table_format(spark)
    rows = keep_first(cur, key, order)
    if fmt == "delta":
        w = rows.write.mode("overwrite").format(fmt)
        (w.partitionBy(*parts) if parts else w).saveAsTable(name)
        return spark.table(name)
    version = uuid.uuid4().hex[:8]
    new_path = f"{root.rstrip('/')}/v-{version}"
    if not parts:
        rows.write.format(fmt).save(new_path)
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{new_path}'")
    else:
        new, old = f"{name}_new_{version}", f"{name}_old_{version}"
        write_table(rows, new, new_path, fmt, partition_by=parts)
        spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
        try:
            spark.sql(f"ALTER TABLE {new} RENAME TO {name}")
        except Exception:
            spark.sql(f"ALTER TABLE {old} RENAME TO {name}")
            raise
        drop_table(spark, old)
    spark.catalog.refreshTable(name)
    return spark.table(name)


def preview(df: DataFrame, n: int = 5, order=None) -> DataFrame:
    """``n`` rows for display. With ``order`` (column names) the first ``n`` in
    that order, ties broken by the remaining columns: repeatable, and planned as a
    per-task top-n, not a global sort. Without it, whatever rows come first."""
    if not order:
        return df.limit(n)
    order = list(order)
    return df.orderBy(*order, *[c for c in df.columns if c not in order]).limit(n)


def sample_n(df: DataFrame, n: int, key_cols, seed: int = 42) -> DataFrame:
    """``n`` rows chosen by a seeded hash order (repeatable; planned as a
    per-task top-n, not a global sort)."""
    return df.orderBy(order_key(*key_cols, seed=seed), *key_cols).limit(n)


def schema_report(df: DataFrame) -> DataFrame:
    """Position, name, type and nullability of every column, and the row count."""
    spark = df.sparkSession
    rows = [(i + 1, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    meta = spark.createDataFrame(rows, "position int, column_name string, data_type string, nullable boolean")
    return meta.withColumn("row_count", df.select(F.count(F.lit(1))).scalar())


def typed_cleanse(raw: DataFrame, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """Cast text columns to the declared types with ``try_cast``.

    Returns the typed rows and a one-pass report of values that were present but
    did not convert (per column).
    """
    typed = raw.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema.fields])
    checks = [F.count_if(F.col(f"`{f.name}`").isNotNull() & F.col(f"`{f.name}`").try_cast(f.dataType).isNull())
              .alias(f.name) for f in schema.fields]
    report = raw.agg(*checks).select(F.inline(F.array(*[
        F.struct(F.lit(f.name).alias("column_name"), F.col(f"`{f.name}`").alias("rejected")) for f in schema.fields])))
    return typed, report


HAND_OFF_ROWS = 1_000_000


def hand_off(df: DataFrame, max_rows: int = HAND_OFF_ROWS):
    """A result as a pandas frame on the driver. It must be small by its kind (a rate table, a report); one of
    more than ``max_rows`` rows is refused with an error, never cut."""
    got = df.limit(max_rows + 1).toPandas()
    if len(got) > max_rows:
        raise ValueError(f"more than {max_rows} rows: write the result as a table instead")
    return got
