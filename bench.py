"""Times the headline reports and prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from cedeflow.samples.queries import QUERIES
from cedeflow.session import local_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINES = (
    "rollforward_checked",
    "group_reconciliation_95",
    "group_reconciliation_50",
    "treaty_reconciliation",
    "cohorts_monthly_policy",
    "cohorts_policy",
    "cohorts_plan_group",
    "cohorts_migration",
    "triangle_in_force",
    "net_av_dedup",
    "net_av_flat",
    "net_av_flag",
    "life_merged",
    "anti_join_null_aware",
    "anti_join_as_of",
)


def main() -> None:
    spark = local_session(CPUS)
    # one untimed query, so that the first timed one does not pay for the start
    QUERIES["net_av_flat"](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINES:
        start = time.perf_counter()
        QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_reports_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
