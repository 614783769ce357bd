"""Version pointers, batches, journals, merges, crawls and footers: crashes at every step included."""

from __future__ import annotations

import datetime as dt
import os
import threading
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.operators import QualityError, dedup_latest
from cartwheel.plans.journal import Journal
from cartwheel.plans.jobs import city_revenue_job, conform_orders, extract_city, load_orders
from cartwheel.plans.registry import passes_gate
from cartwheel.sinks.batches import KnownBatch, append_batch, batch_ledger, batch_rows, create_batch_table, drop_replaced_batches, known_batches
from cartwheel.sinks.merge import merge_latest, merged_latest
from cartwheel.sinks.tables import ctas_replace, publish_table
from cartwheel.sources import raw_orders
from cartwheel.sources.files import csv_schema, footer_count, merge_schemas, refresh_parquet_partitions, register_csv_table, register_parquet_table, wider
from cartwheel.storage import list_folders, read_text, table_location, write_text

from .conftest import SF001


class Killed(Exception):
    pass


class Killer:
    """Raises at the n-th step it is told of; counts them otherwise."""

    def __init__(self, at: int | None = None):
        self.at, self.seen = at, []

    def __call__(self, step: str) -> None:
        self.seen.append(step)
        if len(self.seen) - 1 == self.at:
            raise Killed(step)


def files_under(path: str) -> set[str]:
    path = path.split(":", 1)[-1]
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


# --- K4: pointers ---------------------------------------------------------------------------------


def test_k4_crash_at_every_step_leaves_old_or_new_rows_and_moves_no_file(spark, db):
    name = f"{db}.t"
    ctas_replace(spark.range(4), name)
    steps = Killer()
    ctas_replace(spark.range(4), name, watch=steps)
    for k, step in enumerate(steps.seen):
        before = files_under(table_location(spark, name))
        old = sorted(r.id for r in spark.table(name).collect())
        with pytest.raises(Killed):
            ctas_replace(spark.range(10 + k), name, watch=Killer(k))
        now = sorted(r.id for r in spark.table(name).collect())
        assert now == (list(range(10 + k)) if step == "swapped" else old)
        assert all(os.path.exists(f) for f in before)
    assert ctas_replace(spark.range(3), name) == 3 and spark.table(name).count() == 3


def test_k4_readers_of_the_old_rows_finish_and_old_versions_go(spark, db):
    name = f"{db}.t"
    ctas_replace(spark.range(4), name)
    reader = spark.table(name)
    ctas_replace(spark.range(9), name)
    assert reader.count() in (4, 9) and spark.read.parquet(*[f for f in reader.inputFiles()]).count() in (4, 9)
    for n in range(4):
        ctas_replace(spark.range(n + 1), name)
    assert len(list_folders(spark, f"{table_location(spark, name).rsplit('/', 1)[0]}")) == 2


def test_k4_changed_columns_managed_tables_and_self_replacement(spark, db):
    ctas_replace(spark.range(4), f"{db}.t")
    ctas_replace(spark.range(3).selectExpr("id", "id * 2 AS twice"), f"{db}.t")
    assert spark.table(f"{db}.t").columns == ["id", "twice"]
    ctas_replace(spark.table(f"{db}.t").filter("id > 0"), f"{db}.t")
    assert spark.table(f"{db}.t").count() == 2
    spark.range(7).write.saveAsTable(f"{db}.managed")
    ctas_replace(spark.range(5), f"{db}.managed")
    assert spark.table(f"{db}.managed").count() == 5


def test_k5_publishes_without_a_rename(spark, db, monkeypatch):
    said, plain = [], type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **k: said.append(text) or plain(self, text, *a, **k))
    publish_table(spark.range(3), f"{db}.v")
    publish_table(spark.range(4), f"{db}.v")
    assert spark.table(f"{db}.v").count() == 4 and not any("RENAME" in s for s in said)


# --- K1, W1, W3: batches --------------------------------------------------------------------------


def test_k1_batches_are_refused_skipped_or_replaced_as_one(spark, db):
    name = f"{db}.b"
    assert create_batch_table(spark, name, "id BIGINT, t VARCHAR(3)") and not create_batch_table(spark, name, "id BIGINT, t VARCHAR(3)")
    rows = lambda n, t="x": spark.range(n).select("id", F.lit(t).alias("t"))
    assert append_batch(rows(5), name, "one").rows == 5
    with pytest.raises(KnownBatch):
        append_batch(rows(9), name, "one")
    assert append_batch(rows(9), name, "one", on_known="skip").rows == 5
    assert append_batch(rows(2, "y"), name, "two").status == "appended"
    assert append_batch(rows(3, "z"), name, "one", on_known="replace").status == "replaced"
    assert batch_rows(spark, name).columns == ["id", "t"]
    assert sorted(r.t for r in spark.table(name).collect()) == ["y", "y", "z", "z", "z"]
    ledger = {(r.batch_id, r.rows, r.current) for r in batch_ledger(spark, name).collect()}
    assert ledger == {("one", 5, False), ("one", 3, True), ("two", 2, True)}
    with pytest.raises(Exception, match="(?i)length|exceeds"):
        append_batch(rows(1, "long text"), name, "three")
    assert known_batches(spark, name) == {"one", "two"}
    assert drop_replaced_batches(spark, name) == 2 and spark.table(name).count() == 5
    for bad in ("", "a/b", "a'b", "../x", "a" * 101):
        with pytest.raises(ValueError):
            append_batch(rows(1), name, bad)
    with pytest.raises(ValueError, match="on_known"):
        append_batch(rows(1), name, "four", on_known="what")
    with pytest.raises(ValueError, match="partitioned"):
        spark.range(1).write.saveAsTable(f"{db}.plain")
        create_batch_table(spark, f"{db}.plain", "id BIGINT")


def test_k1_batch_keys_are_checked_against_other_batches_only(spark, db):
    name = f"{db}.b"
    create_batch_table(spark, name, "id BIGINT")
    append_batch(spark.range(5), name, "one", key="id")
    with pytest.raises(QualityError, match="already present"):
        append_batch(spark.range(4, 8), name, "two", key="id")
    assert append_batch(spark.range(4, 8), name, "one", on_known="replace", key="id").rows == 4
    assert append_batch(spark.range(4), name, "two", key="id").rows == 4


@pytest.mark.parametrize("on_known", ["refuse", "replace"])
def test_k1_crash_at_every_step_of_an_append(spark, db, on_known):
    name = f"{db}.b"
    create_batch_table(spark, name, "id BIGINT")
    append_batch(spark.range(2), name, "other")
    if on_known == "replace":
        append_batch(spark.range(7), name, "one")
    before = spark.table(name).count()
    steps = ["write", "commit", "committed", "noted"]
    for k, step in enumerate(steps):
        batch = f"{'one' if on_known == 'replace' else f'run-{k}'}"
        with pytest.raises(Killed):
            append_batch(spark.range(10 + k), name, batch, on_known, watch=Killer(k))
        after = spark.table(name).count()
        committed = step in ("committed", "noted")
        assert after == ((2 + 10 + k) if on_known == "replace" else before + 10 + k) if committed else after == before
        again = append_batch(spark.range(10 + k), name, batch, "replace" if on_known == "replace" else "skip")
        assert again.rows == 10 + k and (batch, 10 + k, True) in {(r.batch_id, r.rows, r.current) for r in batch_ledger(spark, name).collect()}
        before = spark.table(name).count()


def _restarted(run, steps: int):
    """Kill ``run(watch)`` at its first step, then its second ...; each restart goes on. Finally let it end."""
    for k in range(steps):
        try:
            run(Killer(k % 3))
        except Killed:
            continue
        break
    return run(Killer())


def test_w1_killed_after_each_step_ends_as_an_unbroken_run(spark, db):
    source = passes_gate(raw_orders(spark, SF001))
    whole = load_orders(spark, source, f"{db}.whole", run_id=f"{db}-w")
    want = sorted(map(tuple, batch_rows(spark, f"{db}.whole").collect()))
    steps = Killer()
    load_orders(spark, source, f"{db}.count", run_id=f"{db}-n", watch=steps)
    assert len(steps.seen) >= 9
    for k in range(len(steps.seen)):
        target = f"{db}.killed{k}"
        with pytest.raises(Killed):
            load_orders(spark, source, target, run_id=f"{db}-{k}", watch=Killer(k))
        # The restart may not read the source again once the rows are staged.
        staged = steps.seen.index("stage:noted") <= k
        result = load_orders(spark, source if not staged else source.select("*").filter(F.expr("raise_error('read again') IS NULL")), target, run_id=f"{db}-{k}")
        assert result.rows_written == whole.rows_written
        assert sorted(map(tuple, batch_rows(spark, target).collect())) == want
    again = _restarted(lambda watch: load_orders(spark, source, f"{db}.often", run_id=f"{db}-o", watch=watch), 12)
    assert again.rows_written == whole.rows_written == spark.table(f"{db}.often").count()


def test_w1_run_ids_repeat_refuse_and_replace(spark, db):
    source, target = passes_gate(raw_orders(spark, SF001)), f"{db}.orders"
    first = load_orders(spark, source, target, run_id=f"{db}-1")
    again = load_orders(spark, source, target, run_id=f"{db}-1")
    assert again.rows_written == first.rows_written == spark.table(target).count() and again.details["repeated"]
    with pytest.raises(KnownBatch):
        load_orders(spark, source, target, run_id=f"{db}-1", on_known="refuse")
    fewer = source.filter("city IS NOT NULL").limit(100)
    replaced = load_orders(spark, fewer, target, run_id=f"{db}-1", on_known="replace")
    assert replaced.rows_written == spark.table(target).count() <= 100
    with pytest.raises(QualityError, match="already present"):
        load_orders(spark, source, target, run_id=f"{db}-2")
    assert load_orders(spark, source.limit(0), target, run_id=f"{db}-3").status == "empty"
    with pytest.raises(QualityError, match="nothing was written"):
        load_orders(spark, raw_orders(spark, SF001), target, run_id=f"{db}-4")


def test_w2_killed_after_each_step(spark, out, db):
    orders = conform_orders(passes_gate(raw_orders(spark, SF001)))
    want = sorted(map(str, orders.filter("city = 'Kolkata'").collect()))
    steps = Killer()
    extract_city(spark, orders, f"{out}/n", run_id=f"{db}-n", watch=steps)
    for k in range(len(steps.seen)):
        path = f"{out}/{k}"
        with pytest.raises(Killed):
            extract_city(spark, orders, path, run_id=f"{db}-{k}", watch=Killer(k))
        assert extract_city(spark, orders, path, run_id=f"{db}-{k}").rows_written == len(want)
        assert sorted(map(str, spark.read.parquet(path).drop("month").collect())) == want


@pytest.mark.parametrize("incremental", [False, True])
def test_w3_killed_after_each_step_and_run_twice(spark, db, incremental):
    source = raw_orders(spark, SF001)
    steps = Killer()
    city_revenue_job(spark, source, f"{db}.n", f"{db}.nv", incremental, run_id=f"{db}-n", watch=steps)
    want = sorted(map(tuple, spark.table(f"{db}.nv").collect()))
    for k in range(len(steps.seen)):
        table, view = f"{db}.t{k}", f"{db}.v{k}"
        with pytest.raises(Killed):
            city_revenue_job(spark, source, table, view, incremental, run_id=f"{db}-{k}", watch=Killer(k))
        for _ in range(2):
            city_revenue_job(spark, source, table, view, incremental, run_id=f"{db}-{k}")
        assert sorted(map(tuple, spark.table(view).collect())) == want and spark.table(table).count() == spark.table(f"{db}.n").count()
    loaded, revenue = city_revenue_job(spark, source.limit(50), f"{db}.n", f"{db}.nv", incremental, run_id=f"{db}-n", on_known="replace")
    assert spark.table(f"{db}.n").count() == loaded.rows_written == sum(r.order_count for r in spark.table(f"{db}.nv").collect()) <= 50
    assert revenue.details["mode"] == "full"


def test_journal_entries_are_whole_or_absent(spark, out):
    journal = Journal(spark, "job", "r1", root=out)
    assert journal.step("a", lambda: {"n": 1}) == {"n": 1} == journal.step("a", lambda: {"n": 2})
    write_text(spark, f"{out}/x.json", "é")
    write_text(spark, f"{out}/x.json", "two")
    assert read_text(spark, f"{out}/x.json") == "two" and read_text(spark, f"{out}/none") is None
    journal.forget()
    assert journal.finished("a") is None


# --- D1 into a stored table -----------------------------------------------------------------------


def _rows(spark, rows):
    return spark.createDataFrame(rows, "order_id long, updated_at timestamp_ntz, city string, order_amount decimal(12,2)")


def _order(k, day, city="Pune", amount="1.00"):
    return (k, None if day is None else dt.datetime(2026, 1, day), city, None if amount is None else Decimal(amount))


def test_d1_merges_batches_as_one_deduplication(spark, db):
    batches = [
        _rows(spark, [_order(k, 1 + k % 5) for k in range(40)] + [_order(None, 3), _order(None, 9, "Delhi")]),
        _rows(spark, [_order(k, 3, "Delhi", None) for k in range(20, 60)] + [_order(7, None), _order(None, 5)]),
        _rows(spark, [_order(k, 28, amount="2.50") for k in range(0, 60, 7)] * 3),
    ]
    name, union = f"{db}.m", None
    for batch in batches:
        n = merge_latest(batch, name, buckets=4)
        union = batch if union is None else union.unionByName(batch)
        want = sorted(map(str, dedup_latest(union).collect()))
        assert sorted(map(str, spark.table(name).collect())) == want and n == len(want)
    merge_latest(batches[1], name)
    assert sorted(map(str, spark.table(name).collect())) == want
    with pytest.raises(ValueError, match="bucketed"):
        merge_latest(batches[0].withColumnRenamed("city", "place"), name, key="order_amount")


def test_d1_merge_does_not_shuffle_the_history(spark, db):
    name = f"{db}.m"
    merge_latest(_rows(spark, [_order(k, 1) for k in range(400)]), name, buckets=4)
    merged = merged_latest(spark.table(name), _rows(spark, [_order(k, 2) for k in range(9)]), buckets=4)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = merged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    lines = plan.splitlines()
    join = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
    scan = next(i for i, line in enumerate(lines[join:], join) if "FileScan" in line)
    # On the table's side, the first below the join, nothing is exchanged.
    assert not any("Exchange" in line for line in lines[join:scan]) and "Bucketed: true" in lines[scan]


def test_d1_merge_crash_leaves_old_or_new(spark, db):
    name, old, new = f"{db}.m", _rows(spark, [_order(k, 1) for k in range(9)]), _rows(spark, [_order(k, 2) for k in range(5, 12)])
    merge_latest(old, name, buckets=4)
    steps = Killer()
    merge_latest(old, name, watch=steps)
    for k, step in enumerate(steps.seen):
        with pytest.raises(Killed):
            merge_latest(new, name, watch=Killer(k))
        assert spark.table(name).count() == (12 if step == "swapped" else 9)


# --- S4, S5, A6 -----------------------------------------------------------------------------------


def test_s4_types_widen_by_the_lattice():
    i, n, d, s, day, at = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType(), T.DateType(), T.TimestampNTZType()
    dec = T.DecimalType
    cases = [(i, n, n), (i, d, d), (n, d, s), (i, s, s), (day, at, at), (day, i, s), (T.BooleanType(), i, s), (i, dec(20, 0), dec(20, 0)), (n, dec(4, 2), dec(21, 2)), (dec(38, 0), dec(38, 9), s), (T.NullType(), at, at), (at, T.TimestampType(), s), (dec(20, 0), d, s)]
    for a, b, want in cases:
        assert wider(a, b) == wider(b, a) == want
        assert wider(a, a) == a


def test_s4_second_crawl_merges_types_and_columns(spark, out, db):
    spark.createDataFrame([(1, "2026-01-02", 5)], "k int, day string, n int").write.csv(f"{out}/a", header=True)
    spark.createDataFrame([("x1", "2026-01-03 04:05:06", "2.5", "new")], "k string, day string, n string, extra string").write.csv(f"{out}/b", header=True)
    name = f"{db}.c"
    first = register_csv_table(spark, name, out, files=f"{out}/a")
    assert [f.dataType.simpleString() for f in first.schema.fields] == ["int", "date", "int"]
    second = register_csv_table(spark, name, out, merge=True, files=f"{out}/b")
    assert [f.dataType.simpleString() for f in second.schema.fields] == ["string", "timestamp_ntz", "double", "string"]
    got = {r.k: (r.n, r.extra, r.day) for r in second.collect()}
    assert got == {"1": (5.0, None, dt.datetime(2026, 1, 2)), "x1": (2.5, "new", dt.datetime(2026, 1, 3, 4, 5, 6))}
    # A later crawl that lacks the new column keeps it.
    assert register_csv_table(spark, name, out, merge=True, files=f"{out}/a").columns == ["k", "day", "n", "extra"]
    with pytest.raises(ValueError, match="order"):
        merge_schemas(T.StructType().add("a", T.LongType()).add("b", T.LongType()), T.StructType().add("b", T.LongType()))


def test_s4_two_threads_do_not_disturb_each_other(spark, out, db):
    spark.createDataFrame([("2026-01-03 04:05:06",)], "day string").write.csv(f"{out}/t", header=True)
    before, wrong, stop = spark.conf.get("spark.sql.timestampType"), [], threading.Event()

    def watch():
        while not stop.is_set():
            if spark.conf.get("spark.sql.timestampType") != before:
                wrong.append("setting changed")

    watcher = threading.Thread(target=watch)
    watcher.start()
    try:
        for k in range(3):
            assert register_csv_table(spark, f"{db}.t{k}", f"{out}/t").dtypes == [("day", "timestamp_ntz")]
            assert csv_schema(spark, f"{out}/t", timestamps_without_zone=False)["day"].dataType == T.TimestampType()
    finally:
        stop.set()
        watcher.join()
    assert not wrong


def test_s5_only_changed_partitions_are_altered(spark, out, db, monkeypatch):
    out = f"{out}/p"
    rows = spark.range(60).select("id", (F.col("id") % 6).cast("int").alias("month"), F.concat(F.lit("c/ '="), F.col("id") % 2).alias("city"))
    rows.filter("month <> 3").write.partitionBy("month", "city").parquet(out)
    name = f"{db}.p"
    assert register_parquet_table(spark, name, out).count() == 50
    rows.filter("month = 3").write.mode("append").partitionBy("month", "city").parquet(out)
    import shutil

    shutil.rmtree(f"{out}/month=1")
    said, plain = [], type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **k: said.append(text) or plain(self, text, *a, **k))
    diff = refresh_parquet_partitions(spark, name)
    assert {p.split("/")[0] for p in diff.added} == {"month=3"} and {p.split("/")[0] for p in diff.dropped} == {"month=1"}
    assert sum("ALTER TABLE" in s for s in said) == 2 and not any("REPAIR" in s or "RECOVER" in s for s in said)
    assert sorted(r.id for r in spark.table(name).collect()) == [i for i in range(60) if i % 6 != 1]
    assert refresh_parquet_partitions(spark, name) == ((), ())
    # Registering again alters nothing but the differences either.
    said.clear()
    rows.filter("month = 1").write.mode("append").partitionBy("month", "city").parquet(out)
    assert register_parquet_table(spark, name, out).count() == 60
    assert not any("DROP TABLE" in s or "RECOVER" in s for s in said)


def test_a6_counts_from_footers(spark, out):
    rows = spark.range(1000).select("id", (F.col("id") % 3).alias("month"))
    rows.write.partitionBy("month").parquet(f"{out}/p")
    counted = footer_count(spark, f"{out}/p")
    assert "PushedAggregation: [COUNT(*)]" in counted._jdf.queryExecution().executedPlan().toString()
    assert counted.first()["row_count"] == 1000
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


# --- Q6 / K1: Bloom filters -----------------------------------------------------------------------


def _rows_scanned(df) -> int:
    """Rows that the file scans of an executed plan gave out."""
    df.collect()

    def walk(node) -> int:
        name, total = node.nodeName(), 0
        if name.startswith("AdaptiveSparkPlan"):
            return walk(node.executedPlan())
        if name.startswith("Scan parquet"):
            total += node.metrics().apply("numOutputRows").value()
        if "QueryStage" in name:
            total += walk(node.plan())
        for i in range(node.children().size()):
            total += walk(node.children().apply(i))
        return total

    return walk(df._jdf.queryExecution().executedPlan())


@pytest.mark.parametrize("kept", [True, False])
def test_q6_random_keys_skip_files_by_their_filters(spark, db, kept):
    from cartwheel.sinks import create_table_if_missing
    from cartwheel.sinks.tables import append_table, check_new_keys, rows_with_keys

    name = f"{db}.keyed{kept}"
    columns = (("k", "BIGINT", True), ("v", "BIGINT", False))
    create_table_if_missing(spark, name, columns, key_filter="k" if kept else None)
    # Every file spans the whole range of keys, and holds too many of them for a dictionary.
    rows = spark.range(0, 1_200_000, numPartitions=4).select((F.shiftright(F.xxhash64("id"), 2) * 2).alias("k"), F.col("id").alias("v"))
    append_table(rows, name)
    stored = spark.table(name)
    old = [r.k for r in stored.filter("v % 400000 = 7").collect()]
    new = [r[0] for r in spark.range(50).select(F.shiftright(F.xxhash64(F.lit("new"), "id"), 2) * 2 + 1).collect()]
    scanned = _rows_scanned(rows_with_keys(spark, name, "k", new[:3]))
    assert scanned < 600_000 if kept else scanned == 1_200_000
    assert sorted(r.k for r in rows_with_keys(spark, name, "k", [*new, *old]).collect()) == sorted(old)
    batch = lambda keys: spark.createDataFrame([(k, 0) for k in keys], "k long, v long")
    assert check_new_keys(batch(new), spark, name, "k")["existing_keys"] == 0
    with pytest.raises(QualityError, match=f"{len(old)} k value"):
        append_table(batch([*new, *old]), name, key="k")
    large = [r[0] for r in spark.range(3000).select(F.shiftright(F.xxhash64(F.lit("more"), "id"), 2) * 2 + 1).collect()]
    with pytest.raises(QualityError, match="1 k value"):
        append_table(batch([*large, old[0]]), name, key="k")
    assert append_table(batch(large), name, key="k") == 3000
    assert rows_with_keys(spark, name, "k", []).count() == 0
