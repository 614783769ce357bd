"""S1, S4-S8 sources and K1-K8 sinks: write, read back, compare."""

from __future__ import annotations

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cartwheel.operators import QualityError, normalize_orders
from cartwheel.schema import CONFORMED_SCHEMA, ORDER_COLUMNS, RAW_SCHEMA
from cartwheel.sinks import (
    append_table,
    create_table_if_missing,
    ctas_replace,
    publish_table,
    table_ddl,
    write_csv,
    write_dataset,
    write_parquet,
    write_parquet_by_month,
)
from cartwheel.sources import (
    generate_orders,
    inline_rows,
    read_raw_csv,
    register_csv_table,
    register_parquet_table,
    scan_catalog,
    select_all,
)

ROW = ("900018", "C7778", "2025-11-23", "Home", "  DELHI ", "77.05", "SHIPPED", "PAID", "2025-11-24 09:45:30")


def conformed(spark, n=5):
    rows = [
        (100000 + i, f"C{i:04d}", dt.date(2026, 1 + i % 12, 1), "Home", "Pune", Decimal("10.00") * i,
         "PLACED", "PAID", dt.datetime(2026, 1 + i % 12, 2, 3, 0))
        for i in range(1, n + 1)
    ]
    return inline_rows(spark, rows)


def test_s1_k6_csv_keeps_padding_and_reads_text(spark, out):
    df = spark.createDataFrame([ROW, tuple(None if c == "order_id" else v for c, v in zip(ORDER_COLUMNS, ROW))], RAW_SCHEMA)
    assert write_csv(df, out, mode="overwrite") == 2
    back = read_raw_csv(spark, out)
    assert back.schema == RAW_SCHEMA
    assert sorted(back.collect(), key=str) == sorted(df.collect(), key=str)
    assert {r.city for r in back.collect()} == {"  DELHI "}


def test_s1_header_names_bind_columns(spark, out):
    path = os.path.join(out, "orders.csv")
    with open(path, "w") as f:
        f.write("city,order_id,extra\nPune,7,x\n")
    back = read_raw_csv(spark, path)
    assert back.columns == ["city", "order_id", "extra"]
    assert back.first().order_id == "7"


def test_k6_k7_empty_writes_nothing(spark, out):
    empty = spark.createDataFrame([], RAW_SCHEMA)
    assert write_csv(empty, os.path.join(out, "c")) == 0
    assert write_parquet(empty, os.path.join(out, "p")) == 0
    assert not os.path.exists(os.path.join(out, "c")) and not os.path.exists(os.path.join(out, "p"))


def test_k7_parquet_roundtrip(spark, out):
    df = conformed(spark)
    assert write_parquet(df, out, mode="overwrite") == 5
    assert sorted(spark.read.parquet(out).collect()) == sorted(df.collect())


def test_k8_format_by_name(spark, out):
    df = conformed(spark, 2)
    assert write_dataset(df, os.path.join(out, "a"), "parquet") == 2
    assert write_dataset(df, os.path.join(out, "b"), "CSV") == 2
    with pytest.raises(ValueError, match="csv.*parquet"):
        write_dataset(df, os.path.join(out, "c"), "orc")


def test_k2_static_overwrite_leaves_only_new_months(spark, out):
    df = conformed(spark, 24).withColumn("month", F.month("updated_at"))
    assert write_parquet_by_month(df, out) == 24
    assert sorted(d for d in os.listdir(out) if d.startswith("month=")) == sorted(f"month={m}" for m in range(1, 13))
    write_parquet_by_month(df.filter("month = 2"), out)
    months = [r.month for r in spark.read.parquet(out).select("month").distinct().collect()]
    assert months == [2]


def test_k2_dynamic_overwrite_keeps_other_months(spark, out):
    df = conformed(spark, 24).withColumn("month", F.month("updated_at"))
    write_parquet_by_month(df, out)
    write_parquet_by_month(df.filter("month = 2"), out, partition_overwrite="dynamic")
    back = spark.read.parquet(out)
    assert back.select("month").distinct().count() == 12 and back.count() == 24
    with pytest.raises(ValueError):
        write_parquet_by_month(df, out, partition_overwrite="append")


def test_s5_register_partitions(spark, out, db):
    df = conformed(spark, 12).withColumn("month", F.month("updated_at"))
    write_parquet_by_month(df, out)
    table = register_parquet_table(spark, f"{db}.orders_city", out)
    assert table.count() == 12
    assert table.columns[-1] == "month"
    # Partition pruning reaches the scan.
    plan = table.filter("month = 2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and "(month" in plan


def test_s5_register_unpartitioned(spark, out, db):
    write_parquet(conformed(spark, 4), out, mode="overwrite")
    table = register_parquet_table(spark, f"{db}.orders_flat", out)
    assert table.count() == 4 and "month" not in table.columns


def test_s4_inferred_csv_is_normalized_like_text(spark, out, db):
    df = spark.createDataFrame([ROW], RAW_SCHEMA)
    write_csv(df, out, mode="overwrite")
    table = register_csv_table(spark, f"{db}.orders_csv", out)
    types = {f.name: f.dataType.simpleString() for f in table.schema.fields}
    assert types["order_id"] == "int" and types["updated_at"] == "timestamp_ntz"
    assert normalize_orders(table).collect() == normalize_orders(df).collect()


def test_s2_s7_catalog(spark):
    spark.createDataFrame([ROW], RAW_SCHEMA).createOrReplaceTempView("orders_s2")
    assert scan_catalog(spark, "orders_s2").count() == 1
    assert select_all(spark, "orders_s2").columns == list(ORDER_COLUMNS)
    with pytest.raises(ValueError):
        select_all(spark, "orders; DROP TABLE x")


def test_s6_inline_rows_typed(spark):
    df = conformed(spark, 3)
    assert df.schema == CONFORMED_SCHEMA and df.count() == 3
    with pytest.raises(Exception):
        inline_rows(spark, [("not a number",) + (None,) * 8])


def test_s8_generator_properties(spark):
    a = generate_orders(spark, 5000, num_partitions=3)
    b = generate_orders(spark, 5000, num_partitions=7)
    assert sorted(a.collect()) == sorted(b.collect())
    stats = a.agg(
        F.count("*"), F.countDistinct("order_id"), F.min("order_id"), F.max("order_id"),
        F.min("order_date"), F.max("order_date"), F.min("order_amount"), F.max("order_amount"),
        F.countDistinct("city"), F.countDistinct("product_category"), F.countDistinct("order_status"),
        F.countDistinct("payment_status"), F.min("customer_id"), F.max("customer_id"),
    ).first()
    assert tuple(stats[:4]) == (5000, 5000, 100001, 105000)
    assert stats[4] >= "2026-01-01" and stats[5] <= "2026-03-02"
    assert Decimal("300.00") <= stats[6] and stats[7] <= Decimal("75000.00")
    assert tuple(stats[8:12]) == (7, 6, 3, 2)
    assert stats[12] >= "C0001" and stats[13] <= "C0300"
    gap = a.select(
        ((F.unix_timestamp(F.to_timestamp("updated_at")) - F.unix_timestamp(F.to_timestamp("order_date"))) / 3600).alias("h")
    ).agg(F.min("h"), F.max("h")).first()
    assert gap[0] >= 1 and gap[1] <= 48
    assert generate_orders(spark, 10, seed=1).collect() != generate_orders(spark, 10, seed=42).collect()
    # Conforms without a single invalid row.
    assert normalize_orders(a).filter(F.col("order_id").isNull() | F.col("updated_at").isNull()).count() == 0


def test_k3_create_is_idempotent_and_enforces_bounds(spark, db):
    name = f"{db}.orders"
    assert create_table_if_missing(spark, name) is True
    assert create_table_if_missing(spark, name) is False
    assert "customer_id VARCHAR(32)" in table_ddl(name)
    append_table(conformed(spark, 3), name)
    assert spark.table(name).count() == 3
    too_long = conformed(spark, 1).withColumn("customer_id", F.lit("C" * 40))
    with pytest.raises(Exception, match="(?i)length|exceeds|char"):
        append_table(too_long, name)


def test_k1_append_twice_without_and_with_key(spark, db):
    plain = f"{db}.orders_plain"
    create_table_if_missing(spark, plain)
    df = conformed(spark, 4)
    append_table(df, plain)
    append_table(df, plain)
    assert spark.table(plain).count() == 8
    keyed = f"{db}.orders_keyed"
    create_table_if_missing(spark, keyed)
    assert append_table(df, keyed, key="order_id") == 4
    with pytest.raises(QualityError, match="already present"):
        append_table(df, keyed, key="order_id")
    assert spark.table(keyed).count() == 4
    with pytest.raises(QualityError, match="duplicate"):
        append_table(df.union(df), f"{db}.orders_keyed", key="order_id")


def test_k4_ctas_rerun_same_result(spark, db):
    name = f"{db}.orders_ctas"
    df = conformed(spark, 6)
    ctas_replace(df, name)
    ctas_replace(df, name)
    assert sorted(spark.table(name).collect()) == sorted(df.collect())


def test_k5_publish_replaces_without_gap(spark, db):
    view = f"{db}.city_wise_revenue"
    first, rows = publish_table(spark.range(3).withColumnRenamed("id", "n"), view)
    assert rows == 3
    assert spark.table(view).count() == 3
    second, _ = publish_table(spark.range(5).withColumnRenamed("id", "n"), view)
    assert spark.table(view).count() == 5
    assert first != second
    # The version before stays for its readers; it goes with the next publish.
    assert spark.catalog.tableExists(first) and spark.catalog.tableExists(second)
    publish_table(spark.range(6).withColumnRenamed("id", "n"), view)
    assert not spark.catalog.tableExists(first) and spark.catalog.tableExists(second)


def test_k4_failed_replace_keeps_the_old_table(spark, db):
    from cartwheel.sinks.tables import ctas_replace

    ctas_replace(spark.range(4), f"{db}.t")
    bad = spark.range(3).select(F.expr("IF(id < 9, raise_error('no'), id)").alias("id"))
    with pytest.raises(Exception, match="no"):
        ctas_replace(bad, f"{db}.t")
    assert spark.table(f"{db}.t").count() == 4
    assert ctas_replace(spark.range(2), f"{db}.t") == 2 and spark.table(f"{db}.t").count() == 2


def test_k1_key_check_does_not_shuffle_the_table(spark, db):
    spark.range(50_000).withColumnRenamed("id", "k").write.saveAsTable(f"{db}.history")
    batch = spark.range(60_000, 60_005).withColumnRenamed("id", "k")
    keys = batch.select(F.col("k").alias("__key"))
    hits = spark.table(f"{db}.history").select(F.col("k").alias("__existing")).join(keys, F.col("__existing") == F.col("__key"), "left_semi")
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_s4_s5_register_twice_after_a_change(spark, out, db):
    from cartwheel.sources.files import register_csv_table, register_parquet_table

    spark.range(3).write.csv(f"{out}/a", header=True)
    spark.range(3).selectExpr("id", "id * 2 AS extra").write.csv(f"{out}/b", header=True)
    assert register_csv_table(spark, f"{db}.c", f"{out}/a").columns == ["id"]
    assert register_csv_table(spark, f"{db}.c", f"{out}/b").columns == ["id", "extra"]
    spark.range(3).selectExpr("id", "id AS month").write.partitionBy("month").parquet(f"{out}/p")
    assert register_parquet_table(spark, f"{db}.p", f"{out}/p").count() == 3
    spark.range(3, 5).selectExpr("id", "id AS month").write.mode("append").partitionBy("month").parquet(f"{out}/p")
    assert register_parquet_table(spark, f"{db}.p", f"{out}/p").count() == 5


def test_k1_key_check_range_reaches_scan_and_stays_exact(spark, db):
    name = f"{db}.orders_range"
    create_table_if_missing(spark, name)
    append_table(conformed(spark, 6), name, key="order_id")  # keys 100001..100006
    from cartwheel.sinks.tables import check_new_keys

    later = conformed(spark, 9).filter("order_id > 100006")
    assert check_new_keys(later, spark, name, "order_id")["existing_keys"] == 0
    overlap = conformed(spark, 9).filter("order_id >= 100005")
    with pytest.raises(QualityError, match="2 order_id value"):
        check_new_keys(overlap, spark, name, "order_id")
    lo_hi = spark.table(name).select("order_id").filter(F.col("order_id").between(100007, 100009))
    plan = lo_hi._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(order_id,100007)" in plan and "LessThanOrEqual(order_id,100009)" in plan
