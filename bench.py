"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is run once to warm up, then timed ``$BENCH_REPEATS`` times (the
query that fits MLlib models, once); the median is reported.  ``score_fitted`` is what
``score_predicted`` was in round 2; ``elbow_curve`` was 13 MLlib fits until then.  A run
writes to the ``noop`` sink, so the whole plan executes and nothing is
collected to the driver.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from crease.plans import catalog as C  # noqa: E402
from crease.session import build_session, scale_conf  # noqa: E402

HEADLINE = ["matchup_counts", "multiway_join", "matchup_probs", "batch_outcomes",
            "batting_career", "bowling_career", "innings_cutoff", "dismissal_points",
            "strike_reconstruct", "scorecard", "over_features", "assign_clusters",
            "elbow_curve", "score_predicted", "win_share", "score_fitted"]
MODEL = {"score_fitted"}


def run(spark, name: str, sf_dir: str) -> float:
    t = time.perf_counter()
    C.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    size = sum(os.path.getsize(os.path.join(sf_dir, f)) for f in os.listdir(sf_dir))
    conf = scale_conf(size, cpus)
    spark = build_session(master=f"local[{cpus}]", app="crease-bench",
                          shuffle_partitions=int(conf.pop("spark.sql.shuffle.partitions")), extra=conf)
    times: dict[str, float] = {}
    for name in only or HEADLINE:
        if name not in MODEL:
            run(spark, name, sf_dir)
        n = 1 if name in MODEL else repeats
        times[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(n)), 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": cpus, "repeats": repeats, "spark": spark.version}))
    spark.stop()


if __name__ == "__main__":
    main()
