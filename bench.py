"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Each query result is fully computed through the ``noop`` sink, so nothing is
collected to the driver and the time is the distributed work only. Ingestion and
streaming queries include their writes (index, checkpoint, failure log, sink).
Times are steady-state: before timing, every selected query runs once on the
smallest scale factor next to ``$BENCH_SF_DIR`` (JIT, generated-code compilation
and Python workers are then warm), so no query is charged for start-up.
``BENCH_WARMUP=0`` turns that pass off. Each query is timed ``$BENCH_REPEAT``
times (default 3) and its median is reported, so one slow run (a GC pause, a
busy machine) does not decide the number.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
REPEAT = max(1, int(os.environ.get("BENCH_REPEAT", "3")))

# Headline keys, then the rest of the inventory.
HEADLINE = [
    "json_decode",
    "avro_decode",
    "clean_text",
    "pending_documents",
    "index_documents",
    "vector_topk",
    "keyword_search",
    "stream_append",
]


def _sf_of(path: str) -> str:
    base = os.path.basename(path.rstrip("/"))
    return base[2:] if base.startswith("sf") else base


def _smallest_sibling(path: str) -> str:
    """The ``sf*`` folder next to ``path`` with the smallest scale factor (``path`` itself if none)."""
    parent = os.path.dirname(path.rstrip("/"))
    best = (float("inf"), path)
    for name in os.listdir(parent) if os.path.isdir(parent) else []:
        try:
            sf = float(name[2:]) if name.startswith("sf") else None
        except ValueError:
            sf = None
        if sf is not None and os.path.isdir(os.path.join(parent, name)):
            best = min(best, (sf, os.path.join(parent, name)))
    return best[1]


def main() -> None:
    from quayside.session import build_session
    from quayside.plans.registered import QUERIES

    keys = sys.argv[1:] or HEADLINE
    if keys == ["all"]:
        keys = list(QUERIES)
    spark = build_session(master=f"local[{CPUS}]", shuffle_partitions=max(8, 2 * CPUS), app="quayside-bench")

    # warm-up: each query once on the smallest sibling scale factor (not timed)
    if os.environ.get("BENCH_WARMUP", "1") != "0":
        warm_dir = _smallest_sibling(SF_DIR)
        for key in keys:
            QUERIES[key](spark, warm_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for key in keys:
        runs = []
        for _ in range(REPEAT):
            t0 = time.perf_counter()
            QUERIES[key](spark, SF_DIR).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        times[key] = round(statistics.median(runs), 3)
        print(f"# {key}: {times[key]}s (runs: {', '.join(f'{r:.2f}' for r in runs)})", file=sys.stderr)

    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": _sf_of(SF_DIR),
        "cpus": CPUS,
        "shuffle_partitions": max(8, 2 * CPUS),
        "repeat": REPEAT,
        "statistic": "median",
    }))
    spark.stop()


if __name__ == "__main__":
    main()
