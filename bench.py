"""Times the named queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]`` and prints one JSON line.

Every query is written to the no-op sink, so the whole result is computed and nothing is collected.
``$BENCH_QUERIES`` (comma separated) restricts the run while iterating.
"""

from __future__ import annotations

import json
import os
import re
import time

from binledger.registry import QUERIES
from binledger.session import clear_stage, local_session

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = [
    "invoice_monthly", "service_monthly", "inv_srvc_full_join", "monthly_rate_snapshot", "final_container_table",
    "final_summary", "fee_rates", "revenue_by_method", "retention_campaign", "percentile_strata", "ntile_revenue",
    "campaign_summary", "month_columns_pivot", "rate_change_upload", "price_ladder_itemised", "email_clean",
    "audience_funnel", "engagement_consolidated", "pi_population", "pricing_sheet", "detail_with_subtotals",
    "upload_split", "contract_numbers", "latest_row", "crosstab_totals", "describe_numeric", "word_occurrences",
    "sink_partitioned",
]


def main() -> None:
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = local_session(CPUS, shuffle_partitions=max(8, int(CPUS) if CPUS.isdigit() else 8), app="binledger-bench")
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{FOLDER}/nation.parquet").write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        begin = time.perf_counter()
        QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 3)
        clear_stage(spark)
    scale = re.search(r"sf([0-9.]+)", FOLDER)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(scale.group(1)) if scale else None,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
