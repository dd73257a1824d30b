"""Headline-query benchmark.

Runs the registered queries marked ``bench=True`` over ``$BENCH_SF_DIR``
(default /root/testdata/sf0.1) on ``local[$BENCH_CPUS]`` and prints one JSON
line.  Each query is executed in full through the ``noop`` sink (every row
is produced, nothing is collected to the driver).  Spark's event log for the
run is written under a fresh scratch folder for stage/task timings.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    from ratecraft.session import drop_snapshots, get_session
    extra = {"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")}
    if os.environ.get("BENCH_EVENT_LOG", "1") == "1":
        log_dir = tempfile.mkdtemp(prefix="ratecraft-events-")
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{log_dir}"})
    spark = get_session(f"local[{cpus}]", app="ratecraft-bench",
                        shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")),
                        extra=extra)
    spark.sparkContext.setLogLevel("ERROR")
    from ratecraft.plans.catalog import load_all
    reg = load_all()
    names = only or [n for n, e in reg.items() if e.bench]
    # warm-up: JVM class loading and parquet footers, not timed
    reg["ratings_triples"].fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.time()
        reg[name].fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))
    drop_snapshots(spark)
    spark.stop()


if __name__ == "__main__":
    main()
