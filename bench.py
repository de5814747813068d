"""Benchmark: headline queries of the job at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.

derivation included; nothing is stored beforehand.  Each query is built and
run to a noop sink (build + execution; building includes the jobs that store a
merge's side); "pipeline_csv" runs the whole job with its three CSV outputs.
All queries run once unmeasured, so that the session is warm for each of them,
then in rounds whose order alternates.  "queries" has the medians, "value" is
their sum, "queries_least" the least time of each.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from dealspark.plans.pipeline import run  # noqa: E402
from dealspark.plans.registry import registry  # noqa: E402
from dealspark.session import ensure_checkpoint_dir, local_session  # noqa: E402
from dealspark.sources.extracts import fixture_view_inputs  # noqa: E402
from dealspark.sources.fixtures import MAIN  # noqa: E402

HEADLINE = ("deal_ledger", "deal_data", "principal_data", "cohort_mix", "fee_isolated_ledger")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    rounds = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cores=cpus, shuffle_partitions=2 * cpus, app="dealspark-bench")
    ensure_checkpoint_dir(spark)
    queries = registry()
    out_root = tempfile.mkdtemp(prefix="dealspark-bench-out-")

    def pipeline() -> None:
        run(spark, fixture_view_inputs(spark, sf_dir), MAIN, out_root, dt.date(2026, 1, 1), fmt="csv")

    def noop(name: str):
        return lambda: queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    work = {**{name: noop(name) for name in HEADLINE}, "pipeline_csv": pipeline}
    times: dict[str, list[float]] = {name: [] for name in work}
    for i in range(rounds + 1):
        for name in list(work)[::1 if i % 2 else -1]:
            t = time.perf_counter()
            work[name]()
            if i:  # the first round warms the session up
                times[name].append(time.perf_counter() - t)
    results = {name: round(statistics.median(t), 3) for name, t in times.items()}

    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_queries_total_sec",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "rounds": rounds,
        "queries_least": {name: round(min(t), 3) for name, t in times.items()},
    }))
    spark.stop()


if __name__ == "__main__":
    main()
