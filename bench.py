"""Time the registered queries over ``$BENCH_SF_DIR``; prints one JSON line.

``clean_rides_large`` cleans all rides repeated ``$BENCH_COPIES`` times (4 million rows at sf0.1, about as many as the
month whose cleaning times are published). Each query runs once to warm up and then ``$BENCH_RUNS`` times; the median is reported. Every result
is written to Spark's no-op sink, so that all columns of all rows are computed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pedalgrid.session import build_session  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from pedalgrid.operators import clean  # noqa: E402
from pedalgrid.plans import demand  # noqa: E402
from verification import warehouse  # noqa: E402
from verification.queries import QUERIES  # noqa: E402


def clean_rides_large(spark, folder: str):
    copies = int(os.environ.get("BENCH_COPIES", "40"))
    rides = warehouse.rides(spark, folder).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))).drop("copy")
    return clean.clean_rides(rides, demand.measured_lookup(warehouse.stations(spark, folder)))


TIMED = QUERIES | {"clean_rides_large": clean_rides_large}


def run_once(spark, folder: str, name: str) -> float:
    start = time.perf_counter()
    TIMED[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(TIMED)
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus))
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        run_once(spark, folder, name)
        seconds[name] = round(statistics.median(run_once(spark, folder, name) for _ in range(runs)), 3)
    spark.stop()
    report = {
        "metric": "total of query medians",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(folder).name.removeprefix("sf"),
    }
    print(json.dumps(report))


if __name__ == "__main__":
    main()
