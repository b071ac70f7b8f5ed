"""Times every registered query; prints one JSON line.

``BENCH_SF_DIR`` is the folder of tables, ``BENCH_CPUS`` the cores, ``BENCH_RUNS`` the runs per
query, of which the median counts. Each result goes to the ``noop`` sink. The time includes
building the frame, since streams and some operators do their work there.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from rowloom.operators.inference import batch_infer
from rowloom.plans import QUERIES
from rowloom.session import build_session


def echo(prompts):
    return prompts


def run(function, spark, folder) -> float:
    start = time.perf_counter()
    function(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def inference_rate(spark, folder) -> float:
    """Rows per second of batch inference with a model that costs nothing."""
    from pyspark.sql import functions as F

    events = spark.read.parquet(f"{folder}/events.parquet").repartition(spark.sparkContext.defaultParallelism)
    job = lambda spark, folder: batch_infer(events, F.col("props"), echo)
    rows = events.count()
    return rows / statistics.median(run(job, spark, folder) for _ in range(3))


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    wanted = sys.argv[1:] or list(QUERIES)
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    # The first job pays for starting executors and Python workers.
    inference = inference_rate(spark, folder)
    times = {name: round(statistics.median(run(QUERIES[name], spark, folder) for _ in range(runs)), 3) for name in wanted}
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "runs": runs,
                "batch_infer_rows_per_sec": round(inference),
            }
        )
    )


if __name__ == "__main__":
    main()
