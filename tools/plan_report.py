"""Write the executed (post-AQE) physical plans of some queries to a markdown file.

    python tools/plan_report.py /root/testdata/sf0.1 PLANS.md matchup_counts batch_outcomes ...

Each query is run once to the ``noop`` sink; the plan printed is the final
adaptive plan, with expression ids removed for reading.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from crease.plans import catalog as C  # noqa: E402
from crease.session import build_session, scale_conf  # noqa: E402


def final_plan(df) -> str:
    qe = df._jdf.queryExecution()
    qe.toRdd().count()                      # runs this very plan, so AQE finalises it
    text = qe.executedPlan().toString()
    text = text.split("+- == Initial Plan ==")[0]
    text = re.sub(r"#\d+L?", "", text)
    text = re.sub(r", \[plan_id=\d+\]", "", text)
    return "\n".join(line[:220] for line in text.splitlines())


def main() -> None:
    sf_dir, out, names = sys.argv[1], sys.argv[2], sys.argv[3:]
    size = sum(os.path.getsize(os.path.join(sf_dir, f)) for f in os.listdir(sf_dir))
    conf = scale_conf(size, 8)
    spark = build_session(shuffle_partitions=int(conf.pop("spark.sql.shuffle.partitions")), extra=conf)
    parts = [f"# Executed plans at {os.path.basename(sf_dir)}\n",
             "Written by `tools/plan_report.py`: the final adaptive plan of each query after one run, expression "
             "ids removed. `ShuffleQueryStage` = an exchange that ran; `BroadcastQueryStage` = a side AQE measured "
             "small and broadcast; `ReusedExchange` = a shuffle read by two consumers.\n"]
    for n in names:
        parts.append(f"## `{n}`\n\n```\n{final_plan(C.QUERIES[n](spark, sf_dir))}\n```\n")
    with open(out, "w") as f:
        f.write("\n".join(parts))
    spark.stop()


if __name__ == "__main__":
    main()
