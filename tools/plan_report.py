"""Summarise the physical plans of the registered queries into PLANS.md.

    python tools/plan_report.py [sf_dir] [out.md]

Broadcasts by size are switched off, so small test tables show the joins that
large ones would get.  Rows ``build <table>`` are the plans that build a dds
table; a query that loads tables and reads them back (``dim_*``, ``fct_*``,
``sink_*``, ``stg_*``, the stream) shows the read alone, and the incremental
runs, which are many jobs, are left out.  For each query: exchanges (shuffles), broadcast exchanges, join strategies,
aggregate operators, whether any Python UDF or window runs, and the filters
pushed to the Parquet scans.  The plan is taken after execution, so it is
the final AQE plan.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tabulark.session import local_session  # noqa: E402


def summarise(plan: str) -> dict:
    lines = plan.splitlines()
    ops = [re.sub(r"^[\s:+\-]*(\*\(\d+\)\s*)?", "", ln).split(" ")[0].split("(")[0]
           for ln in lines]
    count = lambda name: sum(1 for o in ops if o == name)
    joins = sorted({o for o in ops if o.endswith("Join")})
    aggs = sorted({o for o in ops if o.endswith("Aggregate")})
    pushed = sorted({m for m in re.findall(r"PushedFilters: \[([^\]]*?)(?:\]|\.\.\.)", plan) if m})
    pruned = sorted({m for m in re.findall(r"PartitionFilters: \[([^\]]*?)(?:\]|\.\.\.)", plan) if m})
    return {
        "shuffles": count("Exchange"),
        "broadcasts": count("BroadcastExchange"),
        "joins": ", ".join(joins) or "-",
        "aggregates": ", ".join(aggs) or "-",
        "python": "yes" if re.search(r"PythonUDF|ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas", plan) else "no",
        "window": "yes" if "Window" in ops else "no",
        "pushed": "; ".join(p[:90] for p in pushed[:2]) or "-",
        "pruned": "; ".join(re.sub(r"#\d+", "", p)[:70] for p in pruned[:1]) or "-",
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    out = sys.argv[2] if len(sys.argv) > 2 else os.path.join(
        os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    from tabulark import catalog
    from tabulark.plans import dims, facts
    from tabulark.plans.dds import materialized_stg
    spark = local_session(8, 8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    rows = []
    stg, t = materialized_stg(spark, sf_dir), catalog.dds(spark, sf_dir)
    builds = {
        "dm_products": lambda: dims.dim_products(stg["restaurants"], t["dm_restaurants"], with_ids=False),
        "dm_timestamps": lambda: dims.dim_timestamps(stg["orders"], with_ids=False),
        "dm_orders": lambda: dims.dim_orders(stg["orders"], t["dm_restaurants"], t["dm_timestamps"],
                                             t["dm_users"], with_ids=False),
        "fct_product_sales": lambda: facts.fct_product_sales(stg["events"], t["dm_orders"], t["dm_products"]),
        "fct_deliveries": lambda: facts.fct_deliveries(stg["deliveries"], t["dm_orders"], t["dm_couriers"]),
    }
    for name, build in builds.items():
        df = build().table
        rows.append((f"build {name}", summarise(df._jdf.queryExecution().executedPlan().toString())))
    for key, fn in sorted(catalog.queries().items()):
        if key.startswith("dds_incremental"):
            continue
        df = fn(spark, sf_dir)
        first = df._jdf.queryExecution().executedPlan().toString()
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        if "AdaptiveSparkPlan" in plan:
            final = df._jdf.queryExecution().executedPlan().finalPhysicalPlan() \
                if hasattr(df._jdf.queryExecution().executedPlan(), "finalPhysicalPlan") else None
            plan = final.toString() if final is not None else plan
        if "Scan parquet" not in plan:
            plan = first  # a period without rows was cut to nothing at run time
        rows.append((key, summarise(plan)))
        print(key, rows[-1][1], flush=True)
    with open(out, "w") as f:
        f.write("# Physical plans of the registered queries\n\n")
        f.write(f"Generated by `tools/plan_report.py` on `{sf_dir}` (local[8], 8 shuffle "
                "partitions, AQE on, no broadcast by size). Plans are read after execution. The mart "
                "queries read the materialised dds tables; `build` rows are the plans that make them "
                "(ids are added by one more range exchange). `dim_*`, `fct_*`, `sink_*`, `stg_*` and "
                "the stream show the read-back alone. Shuffles counts shuffle exchanges "
                "(AQE may have turned a sort-merge join into a broadcast at run time).\n\n")
        f.write("| query | shuffles | broadcasts | joins | aggregates | python | window | pushed filters | partition filters |\n")
        f.write("|---|---|---|---|---|---|---|---|---|\n")
        for key, s in rows:
            f.write(f"| `{key}` | {s['shuffles']} | {s['broadcasts']} | {s['joins']} | {s['aggregates']} "
                    f"| {s['python']} | {s['window']} | {s['pushed']} | {s['pruned']} |\n")
    spark.stop()


if __name__ == "__main__":
    main()
