"""Print the formatted physical plan of registered queries.

    python tools/explain.py [sf_dir] name [name ...]

Use it after changing an operator: check that filters reach the scan
(``PushedFilters``), that scans read only needed columns (``ReadSchema``),
which joins broadcast, and how many exchanges the plan has.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillstream.plans.queries import QUERIES  # noqa: E402
from tillstream.session import build_session  # noqa: E402


def main() -> None:
    args = sys.argv[1:]
    sf = args.pop(0) if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    spark = build_session()
    for name in args or sorted(QUERIES):
        df = QUERIES[name](spark, sf)
        plan = df._jdf.queryExecution().executedPlan().toString()
        n_ex = plan.count("Exchange hashpartitioning") + plan.count("Exchange SinglePartition")
        n_bc = plan.count("BroadcastExchange")
        print(f"===== {name}: {n_ex} shuffle exchanges, {n_bc} broadcasts")
        df.explain("formatted")


if __name__ == "__main__":
    main()
