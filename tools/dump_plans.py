"""Write PLANS.md: final (adaptive) physical plans of the headline operators.

usage: python tools/dump_plans.py [--sf /root/testdata/sf0.1]

Each DataFrame is collected first, so the plan shown is AQE's final plan (run
it on a small scale factor); only the operator tree and
the scan lines (pushed filters, partition filters, read schema) are kept.
"""

from __future__ import annotations

import argparse
import contextlib
import io
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def final_plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    tree = text.split("\n\n")[0]
    scans = re.findall(r"\(\d+\) Scan \w+.*?(?=\n\(\d+\)|\Z)", text, flags=re.S)
    keep = []
    for s in scans:
        lines = [ln for ln in s.splitlines()
                 if ln.startswith(("(", "PushedFilters", "PartitionFilters", "ReadSchema", "Location"))]
        keep.append("\n".join(lines))
    return tree + "\n\n" + "\n\n".join(keep)


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    ap.add_argument("--out", default=os.path.join(ROOT, "PLANS.md"))
    args = ap.parse_args()

    from tripkpi.operators import kpis
    from tripkpi.plans import fixtures
    from tripkpi.plans.queries import QUERIES
    from tripkpi.session import get_spark
    from tripkpi.sources import parquet

    spark = get_spark("local[8]", app_name="tripkpi-plans")
    sf = args.sf
    clean_path = fixtures.write_clean_table(spark, sf)
    clean = parquet.read_clean_trips(spark, clean_path, validate=False)
    cases = [
        ("KPI report (wide), from the partitioned clean table",
         "One scan reading 8 columns, GROUPING SETS (Expand + partial aggregate), rank window "
         "behind a partial WindowGroupLimit, share totals, final aggregate on the reused "
         "(year, month) partitioning. No joins.",
         kpis.kpi_report_wide(clean)),
        ("KPI report (long), from the partitioned clean table", "Same shape without the final pivot.",
         kpis.kpi_report_long(clean)),
        ("Top-k bikes (single KPI)", "Partial WindowGroupLimit before the shuffle.",
         kpis.top_bikes(kpis.kpi_base(clean))),
        ("Month slice", "PartitionFilters prune to one year=/month= folder.",
         parquet.read_month(spark, clean_path, 1996, 3)),
        ("Clean trips from the benchmark tables",
         "lineitem JOIN orders, then two left joins to the station master; "
         "one codegen stage after the joins.",
         QUERIES["clean_trips"](spark, sf)),
        ("Clean trips from new-layout CSV", "Staged raw lines, each bound by its own file's header.",
         QUERIES["clean_new_layout"](spark, sf)),
        ("Unmatched stations", "One pass over the trips; anti join and distinct in the order Spark chooses.",
         QUERIES["unmatched_stations"](spark, sf)),
        ("Reject reasons", "One pass, count_if per conjunct, partial aggregation.",
         QUERIES["reject_reasons"](spark, sf)),
    ]
    out = [f"# Physical plans (final adaptive plans, {os.path.basename(sf)}, local[8])\n",
           "Generated by `tools/dump_plans.py`. `*` marks whole-stage-codegen operators.\n"]
    for title, note, df in cases:
        df.collect()                    # run this DataFrame itself, so AQE's final plan is shown
        out.append(f"## {title}\n\n{note}\n\n```\n{final_plan(df)}\n```\n")
    with open(args.out, "w") as f:
        f.write("\n".join(out))
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
