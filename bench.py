"""Headline timings at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS]. Prints one JSON line.

Every query runs to completion through the ``noop`` sink (the full plan
executes, nothing is collected). ``preprocess`` is the whole cleaning run
(dedup, profile before, clip, impute, floor, log, correlation drop,
variance filter, profile after); ``task_regression`` is one modelling task
with a reduced search budget (see README)."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "describe_table", "outlier_counts", "clip_iqr", "impute_median", "corr_matrix",
    "variance_filter", "split_stratified", "standardize", "results_table", "roc_curve",
    "chart_kde", "chart_box", "smote_rows", "profile_compare",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from tabmill.session import get_session
    spark = get_session(master=f"local[{cpus}]", shuffle_partitions=max(cpus * 2, 8), app="tabmill-bench")
    from tabmill.plans.catalog import QUERIES
    from tabmill.plans import pipeline as P
    from tabmill.plans import study
    from tabmill.plans.tasks import TASK_BY_NAME
    from tabmill.operators import profile
    from tabmill.sources.assay import ASSAY_SPEC

    times: dict[str, float] = {}

    t0 = time.time()
    raw = P.assay_raw(spark, sf_dir)
    pre = P.preprocess(raw, ASSAY_SPEC, cut_lineage=True, profile_before=True)
    run(pre.info_before)
    after = profile.profile_info(pre.table, "after", pre.spec.targets)
    run(after)
    run(pre.table)
    times["preprocess"] = round(time.time() - t0, 3)

    for key in HEADLINE:
        t0 = time.time()
        run(QUERIES[key](spark, sf_dir))
        times[key] = round(time.time() - t0, 3)

    t0 = time.time()
    tr = study.run_task(pre, TASK_BY_NAME["regression_log_cc50"], n_draws=4, n_folds=3,
                        light=True, parallelism=4)
    run(tr.results)
    times["task_regression"] = round(time.time() - t0, 3)

    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "total_wall_time", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
