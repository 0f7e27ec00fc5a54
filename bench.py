"""Time the headline queries on local[$BENCH_CPUS] over $BENCH_SF_DIR; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tabforge.catalog import QUERIES  # noqa: E402
from tabforge.session import local_session  # noqa: E402

HEADLINE = (
    "table_snapshot", "profile_columns", "numeric_summary", "value_counts_topn", "corr_pearson_top", "corr_spearman",
    "corr_kendall", "select_features", "dedup_rows", "histogram", "kde_grid", "box_stats", "box_by_group", "hexbin",
    "qq_fit", "roc_auc", "unify_text", "clip_constraint", "impute_median", "impute_mode", "impute_ffill",
    "outlier_sequential", "outlier_iforest", "scale_standard", "scale_robust", "encode_onehot", "encode_many_levels",
    "union_split", "kfold_counts", "tabular_fit_apply", "regression_metrics", "poly_ridge", "random_forest", "extra_trees",
    "boosted_trees", "score_file",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus)
    # start the executor threads and Python workers outside the measured time
    for name in ("regression_metrics", "outlier_iforest"):
        QUERIES[name](spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    scale = folder.rstrip("/").rsplit("sf", 1)[-1]
    report = {
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
    }
    print(json.dumps(report))
    spark.stop()


if __name__ == "__main__":
    main()
