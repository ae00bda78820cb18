"""Time the headline queries; prints one JSON line.

Every query starts from the given tables: staged tables of earlier queries are
forgotten first.  The first run warms the JVM, the second is reported.
"""

from __future__ import annotations

import json
import os
import sys
import time

from panelwatch.queries import QUERIES
from panelwatch.queries.registry import forget_staged
from panelwatch.session import build_session, clear_scratch

HEADLINE = [
    "zscore_anomalies",
    "rolling_z_60",
    "rolling_q95",
    "rolling_std_halo",
    "last_n_rows",
    "score_normalise",
    "align_ffill",
    "feature_sets",
    "z_attribution_top5",
    "iforest_scores",
    "changepoints",
    "risk_scores",
    "score_upsert",
    "report_severity",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        for _ in range(2):
            forget_staged()
            start = time.perf_counter()
            QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
            clear_scratch(spark)
    print(
        json.dumps(
            {
                "metric": "headline queries, second run, total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
