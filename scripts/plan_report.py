"""Physical-plan summary of every registered query (after the layers exist):
hash exchanges, broadcast exchanges, join strategies, windows, sort
aggregates, and per scan the columns read and the filters pushed down.
Writes a Markdown table to stdout."""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lapsewise.plans.pipeline import materialize  # noqa: E402
from lapsewise.plans.queries import AS_OF, REGISTRY  # noqa: E402
from lapsewise.session import local_session  # noqa: E402


def summary(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    scans = []
    for line in plan.splitlines():
        if "FileScan" in line or "Scan parquet" in line:
            loc = re.search(r"lapsewise-layers/[^/]+/[^/]+/([\w/]+)|/(\w+)\.parquet", line)
            name = (loc.group(1) or loc.group(2)) if loc else "?"
            rs = re.search(r"ReadSchema: struct<([^>]*)>", line)
            ncols = rs.group(1).count(":") if rs else 0
            pf = re.search(r"PushedFilters: \[([^\]]*)\]", line)
            scans.append(f"{name}({ncols}{'; ' + pf.group(1)[:60] if pf and pf.group(1) else ''})")
    return {
        "hash_exch": plan.count("Exchange hashpartitioning"),
        "bcast": plan.count("BroadcastExchange"),
        "smj": plan.count("SortMergeJoin"),
        "bhj": plan.count("BroadcastHashJoin"),
        "window": len(re.findall(r"\bWindow\b", plan)),
        "sort_agg": plan.count("SortAggregate"),
        "scans": ", ".join(scans),
    }


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    materialize(spark, sf_dir, AS_OF)
    print("| query | hash exchanges | broadcasts | SMJ | BHJ | windows | sort aggs | scans: layer(columns read; pushed filters) |")
    print("|---|---|---|---|---|---|---|---|")
    for name, fn in REGISTRY.items():
        s = summary(fn(spark, sf_dir))
        print(f"| {name} | {s['hash_exch']} | {s['bcast']} | {s['smj']} | {s['bhj']} | {s['window']} | "
              f"{s['sort_agg']} | {s['scans']} |")


if __name__ == "__main__":
    main()
