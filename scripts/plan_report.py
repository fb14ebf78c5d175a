"""Write PLANS.md: the physical-plan shape of the headline queries
(exchanges, join strategies, window group limits, scans with pushed filters),
captured with the public `DataFrame.explain()`.

usage: python scripts/plan_report.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from bench import HEADLINE  # noqa: E402
from ledgerline.plans import load_all  # noqa: E402
from ledgerline.plans.pipeline import Pipeline  # noqa: E402
from ledgerline.session import local_session  # noqa: E402

KEYS = ("Exchange", "BroadcastHashJoin", "SortMergeJoin", "BroadcastNestedLoopJoin", "WindowGroupLimit",
        "Window [", "FileScan", "CartesianProduct")


def summarise(plan: str) -> list[str]:
    out = []
    for line in plan.splitlines():
        s = line.strip().lstrip(":+- ").strip()
        if not s.startswith(KEYS):
            continue
        if s.startswith("FileScan"):
            loc = re.search(r"Location: \w+\(\d+ paths\)\[([^\]]+)\]", s)
            pf = re.search(r"PartitionFilters: (\[[^\]]*\])", s)
            pushed = re.search(r"PushedFilters: (\[[^\]]*\])", s)
            cols = re.search(r"FileScan parquet \[([^\]]*)\]", s)
            name = os.path.basename(loc.group(1).rstrip("/")) if loc else "?"
            if re.fullmatch(r"[0-9a-f]{32}", name):
                name = "materialised table"
            ncols = "?"
            if cols:
                more = re.search(r"\.\.\. (\d+) more fields", cols.group(1))
                parts = [c for c in cols.group(1).split(",") if "more fields" not in c]
                ncols = len(parts) + (int(more.group(1)) if more else 0)
            out.append(f"scan {name}: {ncols} cols, "
                       f"pushed {pushed.group(1) if pushed else '[]'}"
                       + (f", partition filters {pf.group(1)}" if pf and pf.group(1) != '[]' else ""))
        else:
            out.append(re.sub(r"#\d+L?", "", s)[:160])
    return out


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(extra={"spark.sql.maxMetadataStringLength": "4000", "spark.sql.debug.maxToStringFields": "400"})
    reg = load_all()
    Pipeline._table = lambda self, name, df: df      # show the staged tables' own plans in place
    names = HEADLINE + ["signals_salted_join", "taxonomy_join", "queue_detail", "total_rolling", "case_by_id", "distinct_ids_by_bitmap",
                        "repeated_ids_by_bitmap", "snapshot_changes", "trends_after_delta", "top_values_by_summary", "profile_drift", "rule_lattice"]
    lines = ["# PLANS — physical plan shape of the headline queries", "",
             "Generated by `scripts/plan_report.py` from `DataFrame.explain()`: the initial plan, before adaptive",
             "execution, with the tables that a run stages (volume, trends, ops) expanded in place, so their",
             "exchanges and windows are counted in every query that reads them.", ""]
    for name in names:
        df = reg[name].build(spark, sf)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()
        summary = summarise(buf.getvalue())
        ex = sum(1 for s in summary if s.startswith("Exchange hashpartitioning") or s.startswith("Exchange rangepartitioning")
                 or s.startswith("Exchange RoundRobin") or s.startswith("Exchange SinglePartition"))
        lines += [f"## {name}", "", f"shuffle exchanges: {ex}", "", "```"] + summary + ["```", ""]
    open(os.path.join(ROOT, "PLANS.md"), "w").write("\n".join(lines))
    print("wrote PLANS.md")


if __name__ == "__main__":
    main()
