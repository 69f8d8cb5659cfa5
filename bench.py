"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line.  Each query is executed in full through the ``noop``
sink (every row computed, nothing collected to the driver).  Before timing,
the whole measured set runs once on the smallest tables ($BENCH_WARM_DIR,
default sf0.001) so the JVM has compiled the generated code - the numbers
are steady-state, as in a long-running job; each query reports the best of
$BENCH_REPEATS (default 2) runs, the job one run.  ``job_run`` is the
whole pipeline on the feed written as mixed-separator text (the files are
written once before timing).  ``verdict_rules_<n>`` measures the verdict with
n rules on the feed (generated-code size check).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
REPEATS = int(os.environ.get("BENCH_REPEATS", "2"))
WARM_DIR = os.environ.get("BENCH_WARM_DIR", os.path.join(os.path.dirname(SF_DIR.rstrip("/")), "sf0.001"))

HEADLINE = ["verdict", "report", "summary_by_rule", "unique_dataset", "unique_dataset_skew",
            "unique_composite", "unique_hot_keys", "unique_text_hashed", "rule_assert", "rules_conversations"]


def _session() -> SparkSession:
    spark = (SparkSession.builder.master(f"local[{CPUS}]").appName("rowgate-bench")
             .config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", str(max(8, CPUS * 2)))
             .config("spark.sql.adaptive.enabled", "true")
             # methods above 8000 bytes are never compiled by the JVM; Spark splits them instead
             .config("spark.sql.codegen.hugeMethodLimit", "8000")
             .config("spark.driver.memory", "8g")
             .config("spark.sql.session.timeZone", "UTC")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def _many_rules(n: int):
    """The feed contract plus n extra generated range/business rules."""
    from rowgate.plans import fixtures as fx

    doc = dict(fx.FEED_CONTRACT)
    extra = [{"name": f"amount_below_{i}", "assert": f"amount < {1_000_000 + i}"} for i in range(n)]
    doc["business_rules"] = list(doc["business_rules"]) + extra
    return fx.feed_contract(**doc)


def main() -> None:
    from rowgate.operators.evaluate import evaluate
    from rowgate.plans import fixtures as fx
    from rowgate.plans.job import run
    from rowgate.plans.queries import queries
    from rowgate.session import fresh_dir

    spark = _session()
    qs = queries()

    def best(build, repeats: int = REPEATS) -> float:
        """Best of ``repeats`` full runs (plan built each time)."""
        out = []
        for _ in range(repeats):
            t = time.perf_counter()
            _run(build())
            out.append(time.perf_counter() - t)
        return round(min(out), 3)

    def measure(sf_dir: str) -> dict[str, float]:
        times: dict[str, float] = {}
        for name in HEADLINE:
            times[name] = best(lambda: qs[name](spark, sf_dir))
        for n in (100, 500):
            times[f"verdict_rules_{n}"] = best(
                lambda: evaluate(fx.dirty_orders(spark, sf_dir), _many_rules(n), as_of=fx.AS_OF))
        feed = fx.write_feed_files(spark, sf_dir, fresh_dir(spark, "bench-feed"))
        t = time.perf_counter()
        measure.result = run(spark, feed, fresh_dir(spark, "bench-run"), fx.feed_contract(), as_of=fx.AS_OF)
        times["job_run"] = round(time.perf_counter() - t, 3)
        return times

    if os.path.isdir(WARM_DIR) and WARM_DIR.rstrip("/") != SF_DIR.rstrip("/"):
        measure(WARM_DIR)  # warm-up pass on the smallest tables, not reported
    times = measure(SF_DIR)
    res = measure.result

    rows = spark.read.parquet(f"{SF_DIR}/orders.parquet").count()
    out = {
        "metric": "total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(SF_DIR.rstrip("/")).replace("sf", ""),
        "cpus": CPUS,
        "feed_rows": rows,
        "job_counts": res.counts,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
