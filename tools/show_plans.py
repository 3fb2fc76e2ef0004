"""Print the final (adaptive) physical plans of registered queries after running them.

    python tools/show_plans.py [sf_dir] name [name ...] > docs/PLANS.md
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(argv: list[str]) -> None:
    from liftlens.plans.catalog import QUERIES
    from liftlens.session import build_session
    sf = argv[0] if argv and argv[0].startswith("/") else "/root/testdata/sf0.1"
    names = [a for a in argv if not a.startswith("/")]
    spark = build_session(cpus=8)
    print(f"# Final physical plans ({os.path.basename(sf)}, local[8], after execution)\n")
    for n in names:
        df = QUERIES[n](spark, sf)
        df.collect()   # the action runs this DataFrame's own (adaptive) plan
        plan = df._jdf.queryExecution().executedPlan().toString()
        print(f"## {n}\n\n```\n{plan.strip()}\n```\n")


if __name__ == "__main__":
    main(sys.argv[1:])
