"""Benchmark: run the catalogue's headline queries and print one JSON line.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS``
(default 8), ``BENCH_QUERIES`` (comma list, default the headline set),
``BENCH_EVENT_LOG_DIR`` (write Spark's event log there, for stage and task
times without the UI).
Each query is executed in full with a ``noop`` write (no rows are collected
to the driver); the time includes any jobs it runs while planning (moment
fits, index fits, training).
"""

from __future__ import annotations

import json
import logging
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "feature_columns",
    "prepare_training",
    "column_moments",
    "labeled_features",
    "keyed_features",
    "sql_functions",
    "standardize",
    "string_index_transform",
    "index_pipeline",
    "constant_fill_export",
    "csv_scan_infer",
    "csv_sink_header",
    "hash_split",
    "random_split",
    "classification_report",
    "preview_head",
    "string_index_wide",
    "split_copies",
    "mlp_train_score",
    "batch_score_export",
    "mlp_cv",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE

    from percepta.plans.catalog import QUERIES
    from percepta.session import build_session

    conf = {"spark.driver.memory": "16g"}
    event_dir = os.environ.get("BENCH_EVENT_LOG_DIR")
    if event_dir:
        os.makedirs(event_dir, exist_ok=True)
        conf.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": event_dir})
    spark = build_session(
        f"local[{cpus}]", app_name="percepta-bench", shuffle_partitions=cpus, conf=conf
    )
    # Warm the JVM (class loading, codegen caches) on the smallest table.
    small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(small):
        QUERIES["feature_columns"](spark, small).write.format("noop").mode("overwrite").save()

    # The steps of each single fit, as the training logs them.
    steps: list[int] = []
    log = logging.getLogger("percepta.operators.model")
    log.setLevel(logging.INFO)
    log.addFilter(lambda record: steps.append(record.args[0]) if record.msg.startswith("steps") else True)
    fits: dict[str, list[int]] = {}
    times: dict[str, float | None] = {}
    errors: dict[str, str] = {}
    for name in names:
        t0 = time.perf_counter()
        steps.clear()
        try:
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - t0, 3)
            if steps:
                fits[name] = list(steps)
        except Exception as exc:  # one failing query must not lose the others' times
            times[name] = None
            errors[name] = f"{type(exc).__name__}: {str(exc)[:300]}"

    m = re.search(r"sf([0-9.]+)", sf_dir)
    record = {
        "metric": "catalogue_total_time",
        "value": round(sum(t for t in times.values() if t is not None), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
    }
    if fits:
        record["training_steps"] = fits
    if errors:
        record["errors"] = errors
    print(json.dumps(record))


if __name__ == "__main__":
    main()
