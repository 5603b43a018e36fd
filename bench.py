"""Time the headline queries; prints one JSON line. Reads BENCH_SF_DIR and BENCH_CPUS."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from curbline.bindings.catalog import QUERIES  # noqa: E402
from curbline.session import build_session  # noqa: E402

HEADLINE = (
    "stg_latest_version", "cohort_states", "sla_monthly", "sla_by_category", "volume_running",
    "backlog_weekly", "parent_links", "missing_parents", "pull_ledger", "fixture_requests",
    "type_labels", "closed_at_intake", "resolved_requests", "category_dim", "sla_compliance",
    "sla_headline", "sla_by_service", "fy_summary", "exclusion_reasons", "top_bias", "backlog_city",
    "label_drift", "upsert_result", "drift_tally", "reject_reasons", "accepted_requests",
    "replay_classify", "dlq_rate_alerts", "consumer_lag", "kappa", "per_tier", "label_vs_category",
    "dq_latest_version", "dq_denominators", "build_report", "stream_upsert", "stream_dedup",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    conf = {
        "spark.sql.shuffle.partitions": str(cpus),
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        "spark.ui.enabled": "false",
        "spark.log.level": "ERROR",
    }
    spark = build_session(f"local[{cpus}]", "curbline-bench", **conf)
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="curbline-bench-"))
    chosen = sys.argv[1:] or HEADLINE
    QUERIES["stg_latest_version"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds: dict[str, float] = {}
    for name in chosen:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "total wall time of the headline queries, one warm run each",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"),
        "cpus": cpus,
    }))


if __name__ == "__main__":
    main()
