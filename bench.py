"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

The ``activity_x*`` entries replicate the cleaned log k-fold with fresh students, write it, and
time reading and aggregating it, the counterpart of the published single-node series."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from campuslens.operators.documents import lms_activity  # noqa: E402
from campuslens.operators.reshape import replicate  # noqa: E402
from campuslens.plans.catalog import QUERIES  # noqa: E402
from campuslens.plans.document_queries import cleaned  # noqa: E402
from campuslens.plans.testbed import ACTIVITY_PERIODS  # noqa: E402
from campuslens.session import local_session, materialise, spread  # noqa: E402

HEADLINE = ["lms_activity", "clean_events", "rule_ledger", "build_followup_docs",
            "sessions_per_enrolment", "alerts_per_enrolment", "alert_followed_by_session",
            "grade_stats", "fail_rate_by_school", "p1_p3_transition", "fail_rate_by_prior",
            "wide_enrolment", "integrity_report", "categorise_text", "identity_pairs",
            "identity_near_miss", "mann_whitney", "auc_roc_pr", "analytic_dataset"]
TARGET_ROWS = [475_970, 4_759_700, 23_798_500]


def run(df) -> float:
    start = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = local_session("bench", cpus)
    spark.sparkContext.setLogLevel("ERROR")
    run(QUERIES["sessions_per_enrolment"](spark, sf_dir))  # warm the JVM
    times, rates = {}, {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    base = spread(materialise(cleaned(spark, sf_dir).clean, "bench"))
    rows = base.count()
    for target in TARGET_ROWS:
        k = max(1, round(target / rows))
        big = materialise(replicate(base, k, "estudiante_id", 1_000_000_000).drop("copia"), "log")
        seconds = run(lms_activity(big, periods=ACTIVITY_PERIODS))
        times[f"activity_x{k}"] = seconds
        print(f"activity_x{k}", seconds, file=sys.stderr, flush=True)
        rates[f"activity_x{k}"] = {"rows": rows * k, "rows_per_s": round(rows * k / seconds)}
    spark.stop()
    print(json.dumps({"metric": "total seconds of the headline queries",
                      "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
                      "rates": rates, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
