"""W1-W4 and the JDBC option builders, on the driver's test tables."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from cartwheel.operators import QualityError
from cartwheel.plans import extract_city, load_orders
from cartwheel.plans.jobs import city_revenue_job, conform_orders
from cartwheel.plans.params import check_identifier, check_jdbc_url, check_location, check_table_name
from cartwheel.plans.registry import passes_gate
from cartwheel.schema import RAW_SCHEMA
from cartwheel.sinks import create_table_column_types, jdbc_write_options, write_csv
from cartwheel.sources import JdbcConnection, jdbc_read_options, raw_orders, read_raw_csv

from .conftest import SF001


def _staging_dbs(spark):
    return [d.name for d in spark.catalog.listDatabases() if d.name.startswith("cw_load_staging")]


def test_w1_refuses_dirty_input_and_writes_nothing(spark, db):
    target = f"{db}.orders"
    with pytest.raises(QualityError, match="nothing was written"):
        load_orders(spark, raw_orders(spark, SF001), target)
    assert not spark.catalog.tableExists(target)
    assert _staging_dbs(spark) == []


def test_w1_success_path_counts_match(spark, db):
    target = f"{db}.orders"
    source = passes_gate(raw_orders(spark, SF001))
    result = load_orders(spark, source, target, key_check=True)
    assert result.status == "written"
    assert result.rows_written == spark.table(target).count() == 1412
    assert result.details["report"]["invalid_rows"] == 0
    assert _staging_dbs(spark) == []
    # A second run of the same batch is refused by the key check.
    with pytest.raises(QualityError, match="already present"):
        load_orders(spark, source, target, key_check=True)
    assert spark.table(target).count() == 1412


def test_w1_empty_source_succeeds_without_writing(spark, db):
    target = f"{db}.orders"
    result = load_orders(spark, spark.createDataFrame([], RAW_SCHEMA), target)
    assert (result.status, result.rows_written) == ("empty", 0)
    assert not spark.catalog.tableExists(target)


def test_w2_month_gate_and_partitions(spark, out):
    good = conform_orders(passes_gate(raw_orders(spark, SF001)))
    res = extract_city(spark, good, os.path.join(out, "ok"))
    assert res.status == "written"
    back = spark.read.parquet(os.path.join(out, "ok"))
    assert back.count() == res.rows_written == good.filter("city = 'Kolkata'").count()
    assert back.columns[-1] == "month"
    # Rows with no update time refuse the whole extract.
    bad = good.withColumn("updated_at", F.when(F.col("order_id") % 7 == 0, None).otherwise(F.col("updated_at")))
    with pytest.raises(QualityError):
        extract_city(spark, bad, os.path.join(out, "bad"))
    assert not os.path.exists(os.path.join(out, "bad"))
    assert extract_city(spark, good, os.path.join(out, "none"), city="Nowhere").status == "empty"


@pytest.mark.parametrize("keep", ["stage", "none"])
def test_w2_keep_modes_agree(spark, out, keep):
    good = conform_orders(passes_gate(raw_orders(spark, SF001)))
    res = extract_city(spark, good, os.path.join(out, keep), keep=keep)
    assert res.rows_written == spark.read.parquet(os.path.join(out, keep)).count()
    assert res.rows_written == good.filter("city = 'Kolkata'").count() > 0


def test_w2_unknown_keep_mode(spark, out):
    good = conform_orders(passes_gate(raw_orders(spark, SF001)))
    with pytest.raises(ValueError, match="keep"):
        extract_city(spark, good, os.path.join(out, "x"), keep="cache")


def test_w2_city_filter_is_pushed_to_parquet(spark, out):
    good = conform_orders(passes_gate(raw_orders(spark, SF001)))
    good.write.parquet(os.path.join(out, "t"))
    table = spark.read.parquet(os.path.join(out, "t"))
    from cartwheel.plans.jobs import city_rows

    plan = city_rows(table)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(city,Kolkata)" in plan


def test_w3_revenue_after_load_and_rerun_doubles(spark, out, db):
    write_csv(raw_orders(spark, SF001), out, mode="overwrite")
    source = read_raw_csv(spark, out)
    loaded, revenue = city_revenue_job(spark, source, f"{db}.orders_tidy", f"{db}.city_wise_revenue")
    assert loaded.rows_written == 1513
    first = {r.city: r.order_count for r in spark.table(f"{db}.city_wise_revenue").collect()}
    assert sum(first.values()) == 1513 and len(first) == 7
    city_revenue_job(spark, source, f"{db}.orders_tidy", f"{db}.city_wise_revenue")
    second = {r.city: r.order_count for r in spark.table(f"{db}.city_wise_revenue").collect()}
    assert second == {c: 2 * n for c, n in first.items()}


@pytest.mark.parametrize("bad", ["a;b", "a.b.c", "1abc", "", "a b", "public.orders--"])
def test_w4_bad_table_names(bad):
    with pytest.raises(ValueError):
        check_table_name(bad)


def test_w4_good_names_and_urls():
    assert check_table_name("public.orders") == "public.orders"
    assert check_table_name("orders") == "orders"
    with pytest.raises(ValueError):
        check_table_name("orders", require_schema=True)
    assert check_identifier("practice") == "practice"
    assert check_jdbc_url("jdbc:postgresql://h:5432/db", ["postgresql"])
    with pytest.raises(ValueError):
        check_jdbc_url("jdbc:mysql://h/db", ["postgresql"])
    with pytest.raises(ValueError):
        check_jdbc_url("postgresql://h/db")
    assert check_location("s3://bucket/curated/orders/")
    with pytest.raises(ValueError):
        check_location("/tmp/out")


def test_s3_k1_k3_jdbc_options():
    conn = JdbcConnection("jdbc:postgresql://db:5432/practice", user="u", password="s3cr3t-value", driver="org.postgresql.Driver")
    assert "s3cr3t-value" not in repr(conn)
    opts = jdbc_read_options(conn, "public.orders", partition_column="order_id", lower_bound=1, upper_bound=1000, num_partitions=8)
    assert opts["fetchsize"] == "1000" and opts["numPartitions"] == "8" and opts["dbtable"] == "public.orders"
    with pytest.raises(ValueError):
        jdbc_read_options(conn, "public.orders", partition_column="order_id")
    with pytest.raises(ValueError):
        jdbc_read_options(conn, "public.orders; DROP TABLE x")
    with pytest.raises(ValueError):
        jdbc_read_options(conn, "public.orders", partition_column="id) OR (1=1", lower_bound=1, upper_bound=2, num_partitions=2)
    w = jdbc_write_options(conn, "public.orders", num_partitions=4)
    assert w["numPartitions"] == "4" and w["batchsize"] == "1000"
    types = create_table_column_types()
    assert "customer_id VARCHAR(32)" in types and "order_amount DECIMAL(12,2)" in types
    assert "updated_at TIMESTAMP" in types


def test_seed_orders_files_and_table(spark, out, db):
    from cartwheel.plans.jobs import seed_orders

    res = seed_orders(spark, os.path.join(out, "csv"), "csv", n=500, table=f"{db}.orders")
    assert (res.status, res.rows_written, res.details["table_rows"]) == ("written", 500, 500)
    again = seed_orders(spark, os.path.join(out, "csv"), "csv", n=500, table=f"{db}.orders")
    assert again.details["table_rows"] == 500 and spark.table(f"{db}.orders").count() == 500
    typed = spark.table(f"{db}.orders")
    assert typed.filter("order_id IS NULL OR updated_at IS NULL OR order_amount IS NULL").count() == 0
    res_p = seed_orders(spark, os.path.join(out, "pq"), "parquet", n=300)
    assert res_p.rows_written == 300 and spark.read.parquet(os.path.join(out, "pq")).count() == 300
    empty = seed_orders(spark, os.path.join(out, "none"), "csv", n=0)
    assert empty.status == "empty" and not os.path.exists(os.path.join(out, "none"))
    with pytest.raises(ValueError):
        seed_orders(spark, os.path.join(out, "orc"), "orc", n=5)


def test_w3_incremental_revenue_equals_full_rebuild(spark, out, db):
    from cartwheel.operators import city_revenue, tidy_orders

    write_csv(raw_orders(spark, SF001), out, mode="overwrite")
    source = read_raw_csv(spark, out)
    view = f"{db}.city_wise_revenue"
    first, rev1 = city_revenue_job(spark, source, f"{db}.orders_tidy", view, incremental=True)
    assert rev1.details["mode"] == "full"
    second, rev2 = city_revenue_job(spark, source, f"{db}.orders_tidy", view, incremental=True)
    assert rev2.details["mode"] == "incremental"
    got = sorted(tuple(r) for r in spark.table(view).collect())
    want = sorted(tuple(r) for r in city_revenue(spark.table(f"{db}.orders_tidy")).collect())
    assert got == want
    assert spark.table(view).columns == ["city", "order_count", "total_revenue", "average_order_value"]
    assert sum(r.order_count for r in spark.table(view).collect()) == 2 * tidy_orders(source).count()


def test_w3_incremental_revenue_after_a_crash_is_rebuilt(spark, out, db):
    from cartwheel.operators import city_revenue
    from cartwheel.plans.jobs import tidy_load

    write_csv(raw_orders(spark, SF001), out, mode="overwrite")
    source, table, view = read_raw_csv(spark, out), f"{db}.orders_tidy", f"{db}.city_wise_revenue"
    city_revenue_job(spark, source, table, view, incremental=True)
    tidy_load(spark, source, table)  # appended, then the job died before its publish
    _, revenue = city_revenue_job(spark, source, table, view, incremental=True)
    assert revenue.details["mode"] == "full"
    got = sorted(tuple(r) for r in spark.table(view).collect())
    assert got == sorted(tuple(r) for r in city_revenue(spark.table(table)).collect())


def test_w1_default_load_refuses_its_own_batch_again(spark, db):
    from cartwheel.plans.registry import passes_gate

    source = passes_gate(raw_orders(spark, SF001))
    load_orders(spark, source, f"{db}.orders")
    with pytest.raises(QualityError, match="already present"):
        load_orders(spark, source, f"{db}.orders")


def test_w1_refuses_text_overruns_before_writing(spark, db):
    source = passes_gate(raw_orders(spark, SF001)).withColumn("order_status", F.repeat(F.lit("x"), 33))
    assert dict(source.dtypes)["order_amount"] == "string"  # the load parses text
    with pytest.raises(QualityError, match="over_order_status"):
        load_orders(spark, source, f"{db}.orders")
    assert not spark.catalog.tableExists(f"{db}.orders")


def test_w2_location_guard(spark):
    good = conform_orders(passes_gate(raw_orders(spark, SF001)))
    with pytest.raises(ValueError, match="s3"):
        extract_city(spark, good, "/tmp/out", schemes=("s3://",))


def test_scratch_is_released(spark, out):
    from cartwheel.plans.registry import QUERIES
    from cartwheel.session import release_scratch

    QUERIES["sink_table_append"](spark, SF001).collect()
    assert release_scratch(spark) > 0 and release_scratch(spark) == 0
    assert not [r.namespace for r in spark.sql("SHOW DATABASES").collect() if r.namespace.startswith("cw_")]


def test_k4_typed_replace_keeps_the_old_table_on_a_bad_row(spark, db):
    from cartwheel.schema import TABLE_COLUMNS
    from cartwheel.sinks.tables import ctas_replace

    good = conform_orders(passes_gate(raw_orders(spark, SF001)))
    rows = ctas_replace(good, f"{db}.typed", TABLE_COLUMNS, "order_id")
    with pytest.raises(QualityError, match="null_order_date"):
        ctas_replace(good.withColumn("order_date", F.lit(None).cast("date")), f"{db}.typed", TABLE_COLUMNS, "order_id")
    with pytest.raises(QualityError, match="repeats"):
        ctas_replace(good.unionByName(good), f"{db}.typed", TABLE_COLUMNS, "order_id")
    assert spark.table(f"{db}.typed").count() == rows
    ddl = spark.sql(f"SHOW CREATE TABLE {db}.typed").first()[0]
    assert "VARCHAR(32)" in ddl
