"""Time the headline queries: prints one JSON line.

The tables are first written as one file for each core, as large tables lie in many files; then
each query runs once unmeasured, and the median of three runs counts.
"""

from __future__ import annotations

import json
import os
import time
from statistics import median

from textloom.session import local_session, scratch_path, ship
from workload import cleaning, curves, monitoring, preparation, reporting, sources, tokens
from workload.common import TABLES

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = {
    "prepare": preparation, "sft_text": preparation, "detect_mode": preparation, "retention_by_source": preparation,
    "clean_math": cleaning, "clean_latex": cleaning, "clean_code": cleaning, "clean_general": cleaning,
    "length_profile": tokens, "vocab": tokens, "tokenize": tokens, "pad_batch": tokens, "perplexity": tokens,
    "early_stop": monitoring, "monitor_trace": monitoring, "run_report": reporting, "smooth": curves,
    "analysis": curves, "parse_log": sources,
}
RUNS = 3


def main() -> None:
    spark = local_session(CPUS, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    ship(spark)
    spread = scratch_path(spark, "bench")
    for name in TABLES:
        spark.read.parquet(f"{SF_DIR}/{name}.parquet").repartition(int(CPUS)).write.parquet(f"{spread}/{name}.parquet")
    seconds = {}
    for name, part in HEADLINE.items():
        runs = []
        for _ in range(RUNS + 1):
            start = time.time()
            part.QUERIES[name](spark, spread).write.format("noop").mode("overwrite").save()
            runs.append(time.time() - start)
        seconds[name] = round(median(runs[1:]), 3)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": SF_DIR.rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
