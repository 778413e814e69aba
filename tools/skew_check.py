"""Skew check: one region re-delivered many times holds most of the rows.

Runs the dedup, the monthly rollup and the balance merge on that input and
reads the per-task shuffle-read record counts from Spark's event log (written
to a scratch folder), to show that no reduce task receives the hot region's
rows wholesale.

    python tools/skew_check.py [sf_dir] [copies]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
from functools import reduce

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 40
    from pyspark.sql import DataFrame
    from pyspark.sql import functions as F

    from ampora.constants import BALANCE_KEY
    from ampora.operators.aggregate import daily_to_monthly
    from ampora.operators.dedup import dedup_latest
    from ampora.operators.merge import merge_balance_years
    from ampora.plans import fixtures as fx
    from ampora.session import build_session

    logs = tempfile.mkdtemp(prefix="ampora-eventlog-")
    spark = build_session("local[8]", shuffle_partitions=16, extra_conf={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": logs,
        "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false",
        # measure partitioning as planned, not AQE's merging of tiny partitions
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="ampora-skew-")})
    scratch = tempfile.mkdtemp(prefix="ampora-skew-in-")
    hot = "nation_0"

    flat = fx.balance_flat(spark, sf)
    again = [flat.where(F.col("region_slug") == hot)
             .withColumn("ingestion_timestamp", F.lit(f"2024-03-{i % 28 + 1:02d}T00:00:00+00:00"))
             for i in range(copies)]
    skewed = reduce(DataFrame.unionByName, [flat] + again)
    skewed.write.parquet(f"{scratch}/flat")
    wd = fx.weather_daily(spark, sf)
    reduce(DataFrame.unionByName, [wd] + [wd.where(F.col("region_slug") == hot)] * copies) \
        .write.parquet(f"{scratch}/daily")
    p = fx.balance_payloads(spark, sf).select("region_slug", "year", F.to_json("payload").alias("payload"))
    reduce(DataFrame.unionByName, [p] + [p.where(F.col("region_slug") == hot)] * copies) \
        .write.parquet(f"{scratch}/payloads")
    skewed = spark.read.parquet(f"{scratch}/flat")
    total = skewed.count()
    hot_rows = skewed.where(F.col("region_slug") == hot).count()

    jobs = {}
    spark.sparkContext.setJobGroup("dedup", "dedup")
    d = dedup_latest(skewed, BALANCE_KEY)
    jobs["dedup_rows"] = d.count()
    spark.sparkContext.setJobGroup("monthly", "monthly")
    jobs["monthly_rows"] = daily_to_monthly(spark.read.parquet(f"{scratch}/daily")).count()
    spark.sparkContext.setJobGroup("merge", "merge")
    jobs["merge_rows"] = merge_balance_years(spark.read.parquet(f"{scratch}/payloads"), "payload").count()
    spark.stop()

    # per-task shuffle records read, from the event log
    stage_group, reads = {}, {}
    files = [p for p in glob.glob(f"{logs}/**/*", recursive=True)
             if os.path.isfile(p) and "appstatus" not in p]
    for path in files:
        with open(path, encoding="utf-8") as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    g = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = g
                elif kind == "SparkListenerTaskEnd":
                    m = ev.get("Task Metrics") or {}
                    r = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                    if r:
                        reads.setdefault(ev["Stage ID"], []).append(r)
    summary = {}
    for sid, rs in reads.items():
        g = stage_group.get(sid)
        if g:
            s = summary.setdefault(g, {"max_task_records": 0, "shuffled_records": 0})
            s["max_task_records"] = max(s["max_task_records"], max(rs))
            s["shuffled_records"] += sum(rs)
    print(json.dumps({"input_rows": total, "hot_region_rows": hot_rows,
                      "hot_share": round(hot_rows / total, 3), "copies": copies,
                      "results": jobs, "shuffle": summary}, indent=1))


if __name__ == "__main__":
    main()
