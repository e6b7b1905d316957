"""Key operators of the executed plans of the headline queries, as PLANS.md shows them.

Usage: python tests/plan_summary.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tillroll import local_session  # noqa: E402
from tillroll.operators import features as FE  # noqa: E402
from tillroll.operators import gold as G  # noqa: E402
from tillroll.plans.registry import AS_OF, clean_df  # noqa: E402
from tillroll.session import materialize  # noqa: E402
from tillroll.sources import layouts as LY  # noqa: E402

SHOWN = re.compile(r"Exchange|Join|Window|FileScan|TakeOrdered|MapInArrow|HashAggregate\(keys")
HIDDEN = re.compile(r"QueryStage|AQEShuffleRead|Coalesced")


def key_operators(df) -> str:
    """Data movement, joins, windows, aggregates and scans of the final plan."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    lines = [ln for ln in text.split("\n") if SHOWN.search(ln) and not HIDDEN.search(ln)]
    lines = [re.sub(r"#\d+L?|, \[plan_id=\d+\]|Location: \S+ \([^)]*\)\[[^\]]*\], ", "", ln) for ln in lines]
    return "\n".join(ln[:180] for ln in lines)


def main(sf_dir: str) -> None:
    spark = local_session(shuffle_partitions=8)
    lines = materialize(clean_df(spark, sf_dir), "plans_clean")
    c360 = materialize(G.customer_360(lines, as_of=AS_OF), "plans_c360")
    folder = f"{spark.sparkContext.getCheckpointDir()}/bucketed"
    LY.write_bucketed(lines, "plans_lines", folder)
    known = LY.known_lines(spark, "plans_lines")
    shown = {
        "transactions_clean": clean_df(spark, sf_dir),
        "customer_360 (from stored lines; the last step, over stored rankings)": G.customer_360(lines, as_of=AS_OF),
        "product_metrics": G.product_metrics(lines),
        "daily_aggregates": G.daily_aggregates(lines),
        "customer_features": FE.customer_features(lines, as_of=AS_OF, c360=c360),
        "customer_features over bucketed lines": FE.customer_features(known, as_of=AS_OF, c360=c360),
        "transaction_features": FE.transaction_features(lines),
        "transaction_features over bucketed lines": FE.known_transaction_features(known),
    }
    print("# PLANS — executed physical plans (key operators)\n")
    print("Written by `python tests/plan_summary.py` at sf0.01 on local[*] (AQE on, 8 shuffle partitions): the lines of the")
    print("final adaptive plan that move, join, aggregate or read data. Steps that a query stores are scans here.\n")
    for name, df in shown.items():
        print(f"## {name}\n\n```\n{key_operators(df)}\n```\n")
    spark.sql("DROP TABLE plans_lines")


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01")
