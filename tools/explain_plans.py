"""Write the physical plan trees (and scan details) of the headline queries
as markdown. Usage: python -m tools.explain_plans [sf_dir] > PLANS.md
"""

from __future__ import annotations

import sys

KEYS = ("q4_avg_temperature", "q6_daily_top_variation", "q8_strongest_wind", "curated_observation",
        "merge_city", "merge_avg_halving", "surrogate_key", "dq_foreign_key", "table_scan")


def main(argv):
    sys.path.insert(0, ".")
    from cirrus.plans import catalog
    from cirrus.session import build_session
    sf_dir = argv[0] if argv else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=16)
    print(f"# Physical plans (`{sf_dir}`, local[8], before adaptive re-planning)\n")
    print("Generated by `python -m tools.explain_plans`. Tree plus the scan nodes' pushed filters and read schema.\n")
    for key in KEYS:
        df = catalog.QUERIES[key](spark, sf_dir)
        text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        tree, _, details = text.partition("\n\n\n")
        scans = [b for b in details.split("\n\n") if b.strip() and "Scan parquet" in b.strip().splitlines()[0]]
        print(f"## `{key}`\n\n```\n{tree.strip()}\n")
        for block in scans:
            keep = [ln for ln in block.splitlines() if ln.startswith(("(", "PushedFilters", "PartitionFilters",
                                                                      "ReadSchema"))]
            print("\n".join(keep))
        print("```\n")


if __name__ == "__main__":
    main(sys.argv[1:])
