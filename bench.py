"""Time the headline queries: one JSON line on stdout.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and
cores. Every query is run to its last row into a sink that discards it.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidemark.plans import catalog  # noqa: E402
from tidemark.session import clear_scratch, local_session  # noqa: E402

HEADLINE = (
    "ts_dataset base_dataset daily_price daily_supply densify_calendar interpolate_linear rolling_std model_features "
    "market_risk outer_merge_locations upsert_keep_last dedupe_by_date quality_report corr_matrix season_ttest "
    "metrics_price diebold_mariano spike_auc walk_forward ts_folds data_drift_psi news_records page_text rss_items "
    "html_table_rows json_columns_to_rows clean_number scan_csv_roundtrip stream_upsert fit_ridge"
).split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    shared = os.environ.get("BENCH_SCRATCH") or tempfile.mkdtemp(prefix="bench-")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), app="bench", **{"spark.checkpoint.dir": shared})
    spark.sparkContext.setLogLevel("ERROR")
    known, seconds = catalog.queries(), {}
    names = sys.argv[1:] or HEADLINE
    known["daily_price"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # start-up
    for name in names:
        start = time.perf_counter()
        known[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        clear_scratch(spark)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": Path(sf_dir).name.removeprefix("sf"), "cpus": os.environ.get("BENCH_CPUS", "8"),
    }))


if __name__ == "__main__":
    main()
