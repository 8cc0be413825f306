"""Per-query input bytes, shuffle bytes, stages and tasks, read from Spark's event log.

Usage: python tools/stage_report.py [sf_dir] [key ...]   -> markdown table on stdout
The event log goes to a fresh scratch folder (mktemp); no UI or server is started.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
from collections import defaultdict

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

DEFAULT = ("department_counts", "basket_by_dow", "dept_dow_share", "top_products_in_top_departments",
           "reorder_rate_extremes", "dim_user_segmented", "customer_reorder_stats", "product_pairs",
           "association_rules", "dq_report", "iqr_outliers")


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    keys = sys.argv[2:] or DEFAULT
    log_dir = tempfile.mkdtemp(prefix="run-eventlog-", dir="/tmp")
    from pyspark.sql import SparkSession

    spark = (SparkSession.builder.master("local[8]").appName("trolley-stages")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", "16").config("spark.sql.session.timeZone", "UTC")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", f"file://{log_dir}")
             .config("spark.eventLog.compress", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from trolley import catalog
    from trolley.plans.warehouse import Warehouse

    wh = Warehouse.get(spark, sf)
    spark.sparkContext.setJobGroup("build", "build")
    wh.build_all()
    reg = catalog.registry()
    for k in keys:
        spark.sparkContext.setJobGroup(k, k)
        reg[k](spark, sf).write.format("noop").mode("overwrite").save()
    spark.stop()

    stage_job = {}
    stats = defaultdict(lambda: {"stages": 0, "tasks": 0, "input": 0, "shuffle_write": 0, "shuffle_read": 0})
    files = sorted(p for p in glob.glob(f"{log_dir}/**/*", recursive=True) if os.path.isfile(p))
    events_all = []
    for path in files:  # rolling logs: a folder of events_<n>_* files
        if os.path.basename(path).startswith("appstatus"):
            continue
        with open(path) as fh:
            events_all += [json.loads(line) for line in fh if line.strip()]
    for events in (events_all,):
        for ev in events:
            if ev["Event"] == "SparkListenerJobStart":
                group = (ev.get("Properties") or {}).get("spark.jobGroup.id", "?")
                for sid in ev.get("Stage IDs", []):
                    stage_job[sid] = group
        for ev in events:
            if ev["Event"] != "SparkListenerStageCompleted":
                continue
            info = ev["Stage Info"]
            group = stage_job.get(info["Stage ID"], "?")
            acc = {a.get("Name"): a.get("Value") for a in info.get("Accumulables", [])}
            s = stats[group]
            s["stages"] += 1
            s["tasks"] += info.get("Number of Tasks", 0)
            s["input"] += int(acc.get("internal.metrics.input.bytesRead", 0) or 0)
            s["shuffle_write"] += int(acc.get("internal.metrics.shuffle.write.bytesWritten", 0) or 0)
            s["shuffle_read"] += int(acc.get("internal.metrics.shuffle.read.remoteBytesRead", 0) or 0) + int(
                acc.get("internal.metrics.shuffle.read.localBytesRead", 0) or 0)
    print(f"Event log: {log_dir}\n")
    print("| query | stages | tasks | input bytes | shuffle write bytes |")
    print("|---|---|---|---|---|")
    # the build's concurrent jobs run on worker threads, which do not inherit the job group
    for k in ("build",) + tuple(keys):
        s = stats.get(k) if k != "build" else stats.get("?")
        s = s or {"stages": 0, "tasks": 0, "input": 0, "shuffle_write": 0}
        print(f"| {k} | {s['stages']} | {s['tasks']} | {s['input']:,} | {s['shuffle_write']:,} |")


if __name__ == "__main__":
    main()
