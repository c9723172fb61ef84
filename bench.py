"""Seconds per headline query, printed as one JSON line.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (local cores), BENCH_QUERIES (comma list or "all"),
BENCH_REFERENCE=1 to time the check SQL on a single-node engine as well.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidewell.checks.catalog import load  # noqa: E402
from tidewell.session import build_session  # noqa: E402

HEADLINE = (
    "reco_topn candidate_features station_performance_7d customer_risk_score customer_segment abnormal_transactions risk_daily_report "
    "account_risk_features room_risk_features suspect_clusters rank_clusters behavior_chain comp_performance patch_comp_delta meta_migration "
    "reconcile_orders daily_finance_report sales_kpis sales_by_region sanitize_documents chunk_fixed chunk_documents knn_topk fuse_results "
    "pii_mask_text daily_active retention outlier_zscore_iqr account_graph_components dq_report"
).split()


def reference_times(root: str, names: list[str], oracles: dict[str, str], cpus: int) -> dict[str, float]:
    sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "tests"))
    from compare import connect

    con, out = connect(root), {}
    con.execute(f"SET threads={cpus}")
    for name in names:
        if name in oracles:
            start = time.perf_counter()
            con.execute(oracles[name]).fetchall()
            out[name] = round(time.perf_counter() - start, 3)
    return out


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4)))
    queries, oracles = load()
    picked = os.environ.get("BENCH_QUERIES", "")
    names = list(queries) if picked == "all" else picked.split(",") if picked else list(HEADLINE)
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=str(cpus), spark__tidewell__text__partitions=str(cpus), spark__driver__memory="12g", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name in ("customer_risk_score", "station_performance_7d"):  # load classes and compile code before the clock starts
        queries[name](spark, root).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        queries[name](spark, root).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        if os.environ.get("BENCH_VERBOSE"):
            print(name, times[name], file=sys.stderr, flush=True)
    result = {"metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(root.rstrip("/")), "cpus": cpus}
    if os.environ.get("BENCH_REFERENCE"):
        result["single_node_sql"] = reference_times(root, names, oracles, cpus)
    print(json.dumps(result))


if __name__ == "__main__":
    main()
