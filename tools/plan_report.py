"""Summarise the executed physical plan of every registered query.

Usage: python tools/plan_report.py [sf_dir] > PLANS.md

Each query is collected once (sf0.01 results are small) so that AQE settles
its final plan; the report counts shuffles, broadcasts, windows and aggregates and lists
what every Parquet scan reads and pushes down.
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from candela.plans import catalog  # noqa: E402
from candela.session import local_session  # noqa: E402


def final_section(plan: str) -> str:
    """The ``== Final Plan ==`` part of an adaptive plan string (all of it otherwise)."""
    if "== Final Plan ==" in plan:
        plan = plan.split("== Final Plan ==", 1)[1]
    return plan.split("== Initial Plan ==", 1)[0]


def summarise(plan: str) -> dict:
    plan = final_section(plan)
    lines = plan.splitlines()
    shuffles = [l for l in lines if re.search(r"\bExchange (hashpartitioning|rangepartitioning|RoundRobin|SinglePartition)", l)]
    keys = []
    for l in shuffles:
        m = re.search(r"Exchange (\w+)\(([^)]*)\)", l)
        if m:
            cols = [re.sub(r"#\d+L?", "", c.strip()) for c in m.group(2).split(",")[:-1]]
            keys.append(f"{m.group(1)}({', '.join(cols)})")
        elif "SinglePartition" in l:
            keys.append("SinglePartition")
    scans = []
    for l in lines:
        if "FileScan" in l or "Scan parquet" in l:
            table = re.search(r"/([a-z_]+)\.parquet", l)
            cols = re.search(r"FileScan \w+ \[([^\]]*)\]", l)
            pushed = re.search(r"PushedFilters: \[([^\]]*)\]", l)
            scans.append(
                (
                    table.group(1) if table else "?",
                    len(cols.group(1).split(",")) if cols else "?",
                    (pushed.group(1)[:80] if pushed and pushed.group(1) else "-"),
                )
            )
    return {
        "shuffles": keys,
        "broadcasts": plan.count("BroadcastExchange"),
        "reused": plan.count("ReusedExchange"),
        "windows": len([l for l in lines if re.search(r"\bWindow \[", l)]),
        "aggs": len([l for l in lines if re.search(r"(Hash|Sort|ObjectHash)Aggregate", l)]),
        "sort_aggs": len([l for l in lines if "SortAggregate" in l]),
        "generates": len([l for l in lines if re.search(r"\bGenerate ", l)]),
        "python": any(x in plan for x in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas")),
        "single": "SinglePartition" in plan,
        "scans": scans,
    }


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8, scratch=tempfile.mkdtemp(prefix="candela-plans-"))
    print("# Executed plans of the registered queries\n")
    print(f"Generated by `python tools/plan_report.py {sf}` (local[8], 8 shuffle partitions, AQE on).")
    print("Counts are of the final adaptive plan after the query ran once.")
    print("`scans` lists table: columns read, pushed filters.\n")
    print("Reading notes:")
    print("- `SinglePartition` entries are final global aggregates over partial results (the check")
    print("  queries).")
    print("- Series queries shuffle rows once, by (series, `__cd_seg`). Where no series is long enough to")
    print("  be cut, the counting pass comes out empty and the join with its cuts goes at run time;")
    print("  `load_symbol_hot` has its hot series cut at every scale.")
    print("- Queries over `orders`/`lineitem` include the shuffles of building bars from those tables.\n")
    print("| query | shuffles (partitioning) | bcast | windows | aggs (sort-based) | python | scans |")
    print("|---|---|---|---|---|---|---|")
    for name, fn in catalog.queries().items():
        df = fn(spark, sf)
        df.collect()  # run this DataFrame's own execution, so AQE's final plan is read
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = summarise(plan)
        shuffles = "; ".join(s["shuffles"]) or "none"
        scans = "; ".join(f"{t}: {c} cols, {p}" for t, c, p in s["scans"])
        print(
            f"| `{name}` | {len(s['shuffles'])}: {shuffles} | {s['broadcasts']} | {s['windows']} | "
            f"{s['aggs']} ({s['sort_aggs']}) | {'yes' if s['python'] else 'no'} | {scans} |"
        )


def condensed_tree(df) -> str:
    """Operator tree of the executed plan, one operator per line, details cut."""
    df.collect()
    plan = final_section(df._jdf.queryExecution().executedPlan().toString())
    out = []
    for line in plan.splitlines():
        if not line.strip() or "== " in line:
            continue
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r"\[plan_id=\d+\]", "", line)
        out.append(line[:150].rstrip())
    return "\n".join(out)


def flagship_trees(spark, sf: str) -> None:
    from candela.operators import series
    from candela.plans.adapters import orders_bars

    path = f"{sf.rstrip('/')}/orders.parquet"
    from candela.session import ensure_checkpoint_dir

    bars_path = ensure_checkpoint_dir(spark).rstrip("/") + "/candela-plan-bars-" + spark.sparkContext.applicationId
    orders_bars(spark, sf).write.mode("overwrite").parquet(bars_path)
    bars = spark.read.parquet(bars_path)
    print("\n## Flagship chain (gap fill -> EMA(10) -> SMA(10)) over a bars Parquet table\n")
    print(f"Bars built from `{path}` and written once, so only the operator's own work shows.\n")
    print("### Every series one segment\n")
    print("```")
    print(condensed_tree(series.load_symbol_chain(bars)))
    print("```\n")
    print("### The same plan over series cut into segments of about 1,000 rows\n")
    print("The broadcast side is the counting pass; rows shuffle once, by (symbol, segment).\n")
    print("```")
    print(condensed_tree(series.load_symbol_chain(bars, target_rows=1000)))
    print("```")


if __name__ == "__main__":
    main()
    if "--no-trees" not in sys.argv:
        flagship_trees(local_session(8, scratch=tempfile.mkdtemp(prefix="candela-plans-")), sys.argv[1] if len(sys.argv) > 1 and not sys.argv[1].startswith("--") else "/root/testdata/sf0.01")
