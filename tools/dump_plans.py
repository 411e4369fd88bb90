"""Print the final (adaptive) physical plans of the flagship query under each strategy.

    python tools/dump_plans.py /root/testdata/sf0.01 > /tmp/plans.txt
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from drivestats.plans.grains import HOURLY  # noqa: E402
from drivestats.plans.stats import build_stats  # noqa: E402
from drivestats.session import build_session  # noqa: E402
from drivestats.sources.fixtures import positions_e  # noqa: E402


def final_plan(df) -> str:
    df.collect()  # run this DataFrame's own execution so the adaptive plan is final
    text = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    text = re.sub(r"#\d+L?", "", text)  # expression ids
    return "\n".join(line[:160] for line in text.splitlines())


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", **{"spark.ui.showConsoleProgress": "false"})
    for strategy in ("blocks", "window", "sorted"):
        df = build_stats(positions_e(spark, sf_dir), HOURLY, strategy=strategy)
        print(f"## hourly_stats, strategy={strategy}\n")
        print(final_plan(df))
        print()


if __name__ == "__main__":
    main()
