"""Times the headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Prints one JSON line. Every query runs to its last row into a sink that drops the rows;
a first untimed query warms up the session.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from parcelion.operators import models  # noqa: E402
from parcelion.plans import analysis, base  # noqa: E402
from parcelion.plans.queries import QUERIES  # noqa: E402
from parcelion.session import local_session, stage_table  # noqa: E402

HEADLINE = [
    "bronze_rows", "silver_rows", "gold_detail", "gold_stats_par_commune", "cube_ventes",
    "kpi_headline", "kpi_top5", "profile_columns", "lookup_commune", "graph_path_counts",
    "graph_path_type", "segment_cleaning", "segment_summary", "dept_stats", "histogram_100",
    "box_price", "ols_surface_price", "feature_frame", "train_dept_stats", "linear_surface",
    "stream_bronze", "prepared_lots", "fit_linear", "fit_ridge", "fit_forest", "fit_boosting",
]

# Fits of the published learners on all prepared features of a segment, timed by themselves: the
# frame is prepared and stored before the clock starts.
FITS = {"fit_linear": "Linear Regression", "fit_ridge": "Ridge", "fit_forest": "Random Forest", "fit_boosting": "Gradient Boosting"}
SEGMENT = 2


_READY: list = []


def prepared(spark, sf_dir):
    """The prepared segment and its training rows, once."""
    if not _READY:
        ready = analysis.prepare(base.stored_segments(spark, sf_dir).where(f"segment = {SEGMENT}"))
        _READY.extend([ready, stage_table(ready.train, "train")])
    return _READY


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    spark = local_session("bench", cores=cpus, partitions=int(cpus))
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["kpi_headline"](spark, sf_dir).collect()
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        if name in FITS:
            ready, train = prepared(spark, sf_dir)
            learner = {"Linear Regression": models.linear_regression, "Ridge": lambda: models.ridge(train),
                       "Random Forest": models.random_forest, "Gradient Boosting": models.boosted_trees}[FITS[name]]
        begun = time.perf_counter()
        if name in FITS:
            models.fit(FITS[name], learner(), train, ready.columns)
        else:
            # Each query pays for the layers it reads.
            base._STORED.clear()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begun, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "headline queries, total", "value": total, "unit": "sec", "queries": seconds, "sf": scale,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
