"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query's plan is executed completely with the ``noop`` sink (no driver
collection, no output cost): the median of ``$BENCH_REPEAT`` runs after one
warm-up, with the fastest and slowest run beside it.  Tables are read as they
are given (single files of one row group); ``$BENCH_DEALT=1`` reads a copy
whose fact tables are dealt into one file a core before the clock starts.
``pipeline`` times a full publish of a new version (silver written with its
expectations, gold built from the written silver).  ``dq_report`` checks a
version that is published anew before each of its runs, outside its clock: the
publish is timed as ``pipeline``, not twice.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["sales_detail", "sales_by_time", "sales_by_product", "customer_segments",
            "price_position", "quality_scorecard", "rank_global", "brand_mismatch_exists",
            "dq_report", "period_totals", "revenue_region_category", "top10_customers",
            "sales_by_time_events"]


FACTS = ("lineitem", "orders", "events")


def dealt(spark, sf_dir: str, scratch: str, cpus: int) -> str:
    """A copy of the test tables, fact tables in one file a core."""
    target = os.path.join(scratch, os.path.basename(sf_dir.rstrip("/")))
    from mercato.sources.testdata import TABLES, read
    for name in TABLES:
        df = read(spark, sf_dir, name)
        df.repartition(cpus if name in FACTS else 1).write.parquet(os.path.join(target, f"{name}.parquet"))
    return target


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = sys.argv[1:] or HEADLINE

    from mercato.plans.lakehouse import Lakehouse, published_testdata
    from mercato.plans.queries import QUERIES
    from mercato.session import local_session

    scratch = tempfile.mkdtemp(prefix="mercato-bench-")
    spark = local_session(cores=cpus, shuffle_partitions=cpus, app="mercato-bench",
                          conf={"spark.checkpoint.dir": os.path.join(scratch, "ckpt")})

    data = dealt(spark, sf_dir, scratch, cpus) if os.environ.get("BENCH_DEALT") == "1" else sf_dir

    def timed(action) -> float:
        t = time.perf_counter()
        action()
        return time.perf_counter() - t

    def run(name: str) -> float:
        if name == "dq_report":
            published_testdata(spark, data, anew=True)
        return timed(lambda: QUERIES[name](spark, data).write.format("noop").mode("overwrite").save())

    run("sales_by_time")  # warm-up: JVM, codegen caches, file listing
    runs = {name: sorted(run(name) for _ in range(repeat)) for name in names}
    runs["pipeline"] = sorted(timed(lambda i=i: Lakehouse.from_testdata(spark, data).publish(os.path.join(scratch, f"lake-{i}"))) for i in range(repeat))
    times = {name: round(statistics.median(t), 3) for name, t in runs.items()}

    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_wall_time", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "spread": {n: [round(t[0], 3), round(t[-1], 3)] for n, t in runs.items()}, "sf": float(sf) if sf else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
