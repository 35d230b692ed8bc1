"""Write PLANS.md: the executed physical plan tree of every report of the catalogue.

    python tools/explain_all.py [SF_DIR [LARGE_SF_DIR]]

Each query's own plan is executed once (a diagnostic run at a small scale
factor: the rows come back to this process and are dropped), so with AQE on
the plan shown is the final adaptive plan, the one that ran.

With LARGE_SF_DIR, a second section shows the join queries' plans on that
larger data set as planned (not executed): there the dimensions exceed the
broadcast bounds and the pre-aggregate / sort-merge paths are chosen.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallyframe.plans.catalog import QUERIES  # noqa: E402
from tallyframe.plans.inspect import plan_text  # noqa: E402
from tallyframe.session import build_session  # noqa: E402


def final_tree(df) -> str:
    tree = plan_text(df).split("\n\n")[0]
    if "== Final Plan ==" in tree:
        tree = tree.split("+- == Initial Plan ==")[0]
    return tree.rstrip()


# Queries without write side effects whose plan depends on dimension sizes.
SIZE_DEPENDENT = ["revenue_by_country_sql", "revenue_by_country_df", "customer_sales_report", "broadcast_lookup"]


def main(sf_dir: str, large_dir: str | None = None) -> None:
    spark = build_session("local[8]", shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    out = [
        "# Executed plans",
        "",
        f"Generated by `python tools/explain_all.py {sf_dir}` (`local[8]`, 16 starting shuffle partitions, AQE on).",
        "`*` marks operators inside whole-stage code generation. Queries that write intermediates (CSV, Parquet,",
        "streams) show the plan of the final read.",
        "",
    ]
    for name, query in QUERIES.items():
        df = query(spark, sf_dir)
        df.collect()  # runs df's own adaptive plan; a noop write would run a separate plan
        out += [f"## {name}", "", "```", final_tree(df), "```", ""]
    if large_dir:
        out += [
            f"# Planned, not executed, on `{large_dir}`",
            "",
            "Dimensions above the broadcast bounds: pre-aggregation before the join and sort-merge joins.",
            "",
        ]
        for name in SIZE_DEPENDENT:
            df = QUERIES[name](spark, large_dir)
            out += [f"## {name} (large)", "", "```", final_tree(df), "```", ""]
    spark.stop()
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1", sys.argv[2] if len(sys.argv) > 2 else None)
