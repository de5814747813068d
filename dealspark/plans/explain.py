"""Write the final (adaptive) physical plans of the headline queries to a
Markdown file: the operator tree plus each scan's pruning and pushdown.

    python -m dealspark.plans.explain /root/testdata/sf0.01 PLANS.md
"""

from __future__ import annotations

import contextlib
import io
import sys

from ..session import local_session
from .registry import registry

HEADLINE = ("deal_ledger", "deal_data", "principal_data", "cohort_mix", "fee_isolated_ledger", "deal_ledger_incremental",
            "deal_aep_outer_colocated", "deal_data_colocated")
SCAN_FIELDS = ("Location", "PartitionFilters", "PushedFilters", "ReadSchema")


def condensed_plan(df) -> str:
    """Operator tree of the executed plan plus scan details (after an action,
    so adaptive execution shows its final plan)."""
    df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    blocks = [b.strip() for b in buf.getvalue().split("\n\n") if b.strip()]
    tree = blocks[0]
    scans = []
    for b in blocks[1:]:
        lines = b.splitlines()
        if lines and "Scan parquet" in lines[0]:
            keep = [lines[0]] + [ln for ln in lines[1:] if ln.split(":")[0].strip() in SCAN_FIELDS]
            scans.append("\n".join(ln.split("[file:")[0] + ("[...]" if "[file:" in ln else "") for ln in keep))
    return tree + "\n\n" + "\n\n".join(scans)


def main(sf_dir: str, out_path: str) -> None:
    spark = local_session(cores=8, shuffle_partitions=16, app="dealspark-explain")
    parts = [f"# Physical plans (final adaptive plans at `{sf_dir}`)\n",
             "Generated by `python -m dealspark.plans.explain`. Operator tree, then each scan's partition "
             "filters, pushed filters and read schema.\n"]
    for name in HEADLINE:
        parts.append(f"## {name}\n\n```\n{condensed_plan(registry()[name](spark, sf_dir))}\n```\n")
    with open(out_path, "w") as f:
        f.write("\n".join(parts))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2])
