"""Measure task balance of the keyed operators when one key holds a third of the rows.

    python tools/skew_check.py [sf_dir]

Builds the conformed orders from ``{sf_dir}/orders.parquet``, rewrites every
third ``order_id`` to the same value (and every third city to one city), runs
de-duplication, the duplicate-key report, the city revenue and the month
write, and reads Spark's event log (written to a fresh folder under /tmp) to
print, per shuffle-reading stage, the largest and the median number of
records a task read. A plan that pre-aggregates before its shuffle shows a
max/median ratio near 1 even with the hot key; a plan that ships every row of
the hot key to one task would show about a third of all rows in one task.
"""

from __future__ import annotations

import io
import json
import os
import statistics
import sys
import tempfile
from collections import defaultdict

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def _events(folder: str):
    for root, _, names in os.walk(folder):
        for name in sorted(names):
            if not name.startswith("events_"):
                continue
            path = os.path.join(root, name)
            if name.endswith(".zstd"):
                import zstandard

                with open(path, "rb") as raw:
                    yield from (json.loads(x) for x in io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw)))
            else:
                with open(path) as fh:
                    yield from (json.loads(x) for x in fh)


def main(argv) -> None:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="cartwheel-skew-")
    from pyspark.sql import functions as F

    from cartwheel.operators import city_revenue, dedup_latest, duplicate_keys, normalize_orders
    from cartwheel.session import build_session, scratch_path
    from cartwheel.sinks import write_parquet_by_month
    from cartwheel.sources import raw_orders

    spark = build_session(
        "local[8]",
        shuffle_partitions=8,
        extra={
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": log_dir,
            "spark.eventLog.compress": "false",
            # Small advisory size so that AQE treats this small input the way it
            # treats a large one: partitions above it are split or not merged.
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k",
            "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.sparkContext.setCheckpointDir(os.path.join(log_dir, "checkpoints"))
    norm = normalize_orders(raw_orders(spark, sf_dir))
    hot = norm.withColumns(
        {
            "order_id": F.when(F.col("order_id") % 3 == 0, F.lit(1)).otherwise(F.col("order_id")),
            "city": F.when(F.col("order_id") % 3 == 1, F.lit("Kolkata")).otherwise(F.col("city")),
            "updated_at": F.when(
                F.col("order_id") % 3 == 2, F.make_timestamp_ntz(F.lit(2026), F.lit(1), F.lit(15), F.lit(0), F.lit(0), F.lit(0))
            ).otherwise(F.col("updated_at")),
        }
    )
    spark.sparkContext.setJobGroup("setup", "setup")
    total = hot.count()
    hot_rows = hot.filter("order_id = 1").count()

    def run(label, action):
        spark.sparkContext.setJobGroup(label, label)
        action()

    run("dedup_latest", lambda: dedup_latest(hot).write.format("noop").mode("overwrite").save())

    # For comparison only: the same survivor by a row_number() window, with the
    # optimizer's partial window group limit switched off.
    def window_dedup():
        from pyspark.sql import Window

        order = [F.col("updated_at").desc_nulls_last()] + [
            F.col(c).desc_nulls_last() for c in hot.columns if c not in ("order_id", "updated_at")
        ]
        ranked = hot.withColumn("_rn", F.row_number().over(Window.partitionBy("order_id").orderBy(*order)))
        spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "-1")
        try:
            ranked.filter("_rn = 1").drop("_rn").write.format("noop").mode("overwrite").save()
        finally:
            spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")

    run("window_no_limit", window_dedup)
    run("duplicate_keys", lambda: duplicate_keys(hot).write.format("noop").mode("overwrite").save())
    run("city_revenue", lambda: city_revenue(hot).write.format("noop").mode("overwrite").save())
    run(
        "write_by_month",
        lambda: write_parquet_by_month(
            hot.withColumn("month", F.month("updated_at")).filter("month IS NOT NULL"), scratch_path(spark, "skew")
        ),
    )
    spark.stop()

    stage_group = {}
    reads = defaultdict(list)
    for ev in _events(log_dir):
        kind = ev.get("Event")
        if kind == "SparkListenerJobStart":
            group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
            for sid in ev.get("Stage IDs", []):
                stage_group[sid] = group
        elif kind == "SparkListenerTaskEnd":
            m = ev.get("Task Metrics") or {}
            sr = m.get("Shuffle Read Metrics") or {}
            recs = sr.get("Total Records Read", 0)
            if recs:
                reads[ev["Stage ID"]].append(recs)
    print(f"rows={total} hot_key_rows={hot_rows} ({hot_rows / total:.0%})")
    print(f"{'operator':16s} {'stage':>5s} {'tasks':>5s} {'max_recs':>9s} {'median':>8s} {'sum':>8s}")
    for sid in sorted(reads):
        r = reads[sid]
        print(
            f"{str(stage_group.get(sid)):16s} {sid:5d} {len(r):5d} {max(r):9d} "
            f"{int(statistics.median(r)):8d} {sum(r):8d}"
        )


if __name__ == "__main__":
    main(sys.argv)
