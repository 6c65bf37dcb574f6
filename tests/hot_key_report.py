"""Tasks of a join with a hot key, plain and spread, from Spark's event log.

``python tests/hot_key_report.py FOLDER`` joins the orders of sf0.1, a third of
them moved to one customer, to the customers by shuffle, once plain and once with
the hot customer's rows spread, and writes the join tasks' lines of both event
logs (shortened to the rows each task read) to FOLDER.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from mercato.operators import enrich  # noqa: E402
from mercato.operators.lookups import hot_keys  # noqa: E402
from mercato.plans.session import build_session  # noqa: E402
from mercato.sources.fixtures import load_sources  # noqa: E402

HOT = 7


def main(folder: str) -> None:
    log = tempfile.mkdtemp(prefix="hot-key-log-", dir="/tmp")
    spark = build_session(
        master="local[4]", shuffle_partitions=64, app_name="hot-key",
        extra={
            "spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{log}", "spark.eventLog.rolling.enabled": "false", "spark.eventLog.compress": "false",
            "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
        },
    )
    src = load_sources(spark, "/root/testdata/sf0.1")
    orders = src.orders.withColumn("customer_id", F.when(F.col("order_id") % 3 == 0, HOT).otherwise(F.col("customer_id")))
    clean = enrich.clean_orders(orders)
    joins = {"plain": {}, "spread": hot_keys(clean, "customer_id")}
    for name, hot in joins.items():
        spark.sparkContext.setJobDescription(name)
        enrich.join_customers(clean, src.customers, hot=hot).write.format("noop").mode("overwrite").save()
    spark.stop()
    stages: dict[int, str] = {}
    lines: dict[str, list] = {name: [] for name in joins}
    (file,) = os.listdir(log)
    for line in open(os.path.join(log, file)):
        e = json.loads(line)
        if e["Event"] == "SparkListenerJobStart":
            name = e["Properties"].get("spark.job.description")
            stages |= {s: name for s in e["Stage IDs"] if name in joins}
        if e["Event"] == "SparkListenerTaskEnd" and e["Stage ID"] in stages:
            read = e["Task Metrics"]["Shuffle Read Metrics"]["Total Records Read"]
            if read:
                lines[stages[e["Stage ID"]]].append({
                    "Event": e["Event"], "Stage ID": e["Stage ID"], "Task Info": {k: e["Task Info"][k] for k in ("Task ID", "Index")},
                    "Task Metrics": {"Shuffle Read Metrics": {"Total Records Read": read}, "Executor Run Time": e["Task Metrics"]["Executor Run Time"]},
                })
    os.makedirs(folder, exist_ok=True)
    for name, events in lines.items():
        last = max(e["Stage ID"] for e in events)  # the join's own stage
        tasks = [e for e in events if e["Stage ID"] == last]
        with open(os.path.join(folder, f"{name}.jsonl"), "w") as out:
            out.writelines(json.dumps(e) + "\n" for e in tasks)
        rows = sorted(e["Task Metrics"]["Shuffle Read Metrics"]["Total Records Read"] for e in tasks)
        print(f"{name}: {len(rows)} tasks read rows, most {rows[-1]}, median {rows[len(rows) // 2]}, of {sum(rows)}")


if __name__ == "__main__":
    main(sys.argv[1])
