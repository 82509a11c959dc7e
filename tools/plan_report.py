"""Run every registered query and summarise its FINAL adaptive plan
(after AQE's runtime re-planning): shuffles, join strategies, windows,
aggregates and whether filters reached the Parquet scan.

usage: python tools/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SKIP = {"ml_score", "ml_importance", "ml_score_a", "ml_importance_a", "ml_validate", "ml_offline_rows",
        "ml_prediction_files", "ml_rounds", "ml_round_rows", "ml_score_a_rows", "src_csv_roundtrip",
        "src_csv_headerless", "src_malformed", "src_quarantine", "src_online"}


def summarise(plan: str) -> dict:
    return {
        "shuffles": len(re.findall(r"Exchange hashpartitioning", plan)),
        "range": len(re.findall(r"Exchange rangepartitioning", plan)),
        "reused": plan.count("ReusedExchange"),
        "single": len(re.findall(r"Exchange SinglePartition", plan)),
        "smj": plan.count("SortMergeJoin"),
        "bhj": plan.count("BroadcastHashJoin"),
        "windows": len(re.findall(r"\bWindow \[", plan)),
        "aggs": len(re.findall(r"(?:Object)?HashAggregate\(", plan)),
        "pushed": len(re.findall(r"PushedFilters: \[[^\]]", plan)),
        "scans": plan.count("FileScan parquet"),
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from redeemflow.plans.queries import QUERIES
    from redeemflow.session import build_session

    # filters are printed in full: Spark cuts long ones to 100 characters
    spark = build_session("local[8]", shuffle_partitions=16,
                          extra={"spark.sql.maxMetadataStringLength": "10000"})
    print(f"# Final physical plans at `{os.path.basename(sf_dir)}` (after AQE)\n")
    print("Generated by `tools/plan_report.py`. shuffles = hash exchanges, single = "
          "exchanges to one partition, smj / bhj = sort-merge / broadcast joins, "
          "pushed = scans with filters pushed into Parquet.\n")
    print("| query | scans | pushed | shuffles | reused | single | smj | bhj | windows | aggregates |")
    print("|---|---|---|---|---|---|---|---|---|---|")
    for name, fn in QUERIES.items():
        if name in SKIP:
            continue
        df = fn(spark, sf_dir)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        plan = plan.split("== Initial Plan ==")[0]  # keep the final (runtime) plan only
        s = summarise(plan)
        print(f"| {name} | {s['scans']} | {s['pushed']} | {s['shuffles']} | {s['reused']} | {s['single']} | "
              f"{s['smj']} | {s['bhj']} | {s['windows']} | {s['aggs']} |")
    spark.stop()


if __name__ == "__main__":
    main()
