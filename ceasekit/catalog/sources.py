"""Registered queries: sources and sinks (S1-S13) and incremental landing."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StringType, StructField, StructType

from ceasekit.catalog import query
from ceasekit.catalog.study import study
from ceasekit.functions.keys import order_key
from ceasekit.plans import observation as OB
from ceasekit.sources import io as IO
from ceasekit.streaming.ingest import land_files

ID = "unique_customer_identifier"
CEASE_SCHEMA = StructType([StructField(ID, StringType()), StructField("cease_placed_date", DateType()),
                           StructField("cease_completed_date", DateType()),
                           StructField("reason_description_insight", StringType())])


@query("s1_csv_scan", "SELECT * FROM cease")
def s1(spark, d):
    s = study(spark, d)
    path = IO.export_csv(s.cease, IO.scratch_path(spark, "cease-csv"))
    return IO.read_csv(spark, path, CEASE_SCHEMA)


@query("s2_parquet_scan", "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer")
def s2(spark, d):
    c = IO.read_parquet(spark, f"{d}/customer.parquet")
    return c.select("c_custkey", "c_mktsegment", "c_acctbal")


@query("s3_s4_table_write_scan", "SELECT * FROM raw_info")
def s3(spark, d):
    s = study(spark, d)
    IO.create_namespace(spark, "ceasekit_check")
    name = "ceasekit_check.raw_info"
    IO.drop_table(spark, name)
    IO.write_table(s.raw_info, name, IO.scratch_path(spark, "raw-info"))
    return IO.read_table(spark, name)


@query("s5_s6_namespace_drop", """
SELECT 'created' AS step, 1 AS tables, count(*) AS n_rows FROM region UNION ALL SELECT 'dropped', 0, 0""")
def s5(spark, d):
    """The namespace lists the table after the write, and no longer after the drop."""
    IO.create_namespace(spark, "ceasekit_drop")
    name = "ceasekit_drop.region_copy"
    IO.drop_table(spark, name)
    listed = lambda: sum(t.name == "region_copy" for t in spark.catalog.listTables("ceasekit_drop"))
    n = IO.write_table(IO.read_parquet(spark, f"{d}/region.parquet"), name, IO.scratch_path(spark, "region")).count()
    rows = [("created", listed(), n)]
    IO.drop_table(spark, name)
    rows.append(("dropped", listed(), 0))
    return spark.createDataFrame(rows, "step string, tables int, n_rows long")


@query("s7_csv_export", f"""
SELECT u.{ID}, min(u.calendar_date) AS first_usage_date, max(u.calendar_date) AS last_usage_date, c.cease_placed_date,
       CAST(date_diff('day', max(u.calendar_date), c.cease_placed_date) AS INTEGER) AS days_diff_usage_to_cease
FROM usage u JOIN cease c ON u.{ID} = c.{ID} GROUP BY u.{ID}, c.cease_placed_date""")
def s7(spark, d):
    from ceasekit.plans.quality import usage_to_event_gap
    s = study(spark, d)
    g = usage_to_event_gap(s.usage, s.cease, ID, "calendar_date", "cease_placed_date")
    path = IO.export_csv(g, IO.scratch_path(spark, "gap-csv"))
    return IO.read_csv(spark, path, f"{ID} string, first_usage_date date, last_usage_date date, "
                                    "cease_placed_date date, days_diff_usage_to_cease int")


@query("s8_rewrite_deduplicated", """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY unique_customer_identifier
  ORDER BY behav_win, reason_description_insight NULLS FIRST) AS rn FROM churned_baseline) WHERE rn = 1""")
def s8(spark, d):
    s = study(spark, d)
    IO.create_namespace(spark, "ceasekit_check")
    name = "ceasekit_check.churned_baseline"
    IO.drop_table(spark, name)
    root = IO.scratch_path(spark, "churned")
    IO.write_table(OB.churned_baseline(s.info, s.cease, s.cfg), name, f"{root}/v-0")
    return IO.rewrite_deduplicated(spark, name, ID, "behav_win", root)


@query("s9_preview", "SELECT * FROM customer_info ORDER BY ALL LIMIT 25")
def s9(spark, d):
    return IO.preview(study(spark, d).info, 25, order=[ID, "datevalue"])


@query("s10_random_sample", f"""
SELECT * FROM raw_info
ORDER BY CAST(('0x' || substr(md5(concat_ws('|', {ID}, '42')), 1, 15)) AS BIGINT), {ID} LIMIT 20""")
def s10(spark, d):
    return IO.sample_n(study(spark, d).raw_info, 20, [ID], seed=42)


@query("s11_schema_report", """
SELECT CAST(row_number() OVER () AS INTEGER) AS position, column_name,
       CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int'
            WHEN 'DOUBLE' THEN 'double' WHEN 'DATE' THEN 'date' ELSE lower(column_type) END AS data_type,
       "null" = 'YES' AS nullable, (SELECT count(*) FROM customer_info) AS row_count
FROM (DESCRIBE SELECT * FROM customer_info)""")
def s11(spark, d):
    return IO.schema_report(study(spark, d).info)


@query("s12_hand_off", """
SELECT contract_status, CAST(avg(churned) AS DOUBLE) AS churn_rate, count(*) AS customers FROM raw_info GROUP BY 1""")
def s12(spark, d):
    """A rate table handed to the driver as pandas, as the study does before it plots, and back."""
    rates = study(spark, d).raw_info.groupBy("contract_status").agg(F.avg("churned").alias("churn_rate"), F.count(F.lit(1)).alias("customers"))
    local = IO.hand_off(rates, 10_000)
    return spark.createDataFrame(local, rates.schema)


@query("s13_typed_cleansing", f"""
SELECT 'unique_customer_identifier' AS column_name, 0 AS rejected
UNION ALL SELECT 'cease_placed_date', 0 UNION ALL SELECT 'cease_completed_date', 0
UNION ALL SELECT 'reason_description_insight', count(reason_description_insight) FROM cease""")
def s13(spark, d):
    s = study(spark, d)
    path = IO.export_csv(s.cease, IO.scratch_path(spark, "cease-text"))
    text = IO.read_csv(spark, path, ", ".join(f"`{f.name}` string" for f in CEASE_SCHEMA.fields))
    declared = StructType(CEASE_SCHEMA.fields[:3] + [StructField("reason_description_insight", IntegerType())])
    _, report = IO.typed_cleanse(text, declared)
    return report.withColumn("rejected", F.col("rejected").cast("int"))


@query("st1_stream_land_usage", "SELECT * FROM usage")
def st1(spark, d):
    s = study(spark, d)
    src = IO.scratch_path(spark, "usage-files")
    s.usage.write.mode("overwrite").parquet(src)
    target = IO.scratch_path(spark, "usage-bronze")
    land_files(spark, src, s.usage.schema, target, IO.scratch_path(spark, "usage-stream-ckpt"))
    return spark.read.schema(s.usage.schema).parquet(target)
