"""Benchmark: run the catalogue queries end to end and print ONE JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is built (including any round-trip writes it does) and fully
executed with the ``noop`` sink, so every row is produced and nothing is
collected to the driver.  ``value`` is the sum of per-query seconds.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tessera.plans import COVERS, QUERIES  # noqa: E402
from tessera.session import get_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    event_dir = tempfile.mkdtemp(prefix="tessera-events-")
    spark = get_session(f"local[{cpus}]", app_name="tessera-bench", shuffle_partitions=cpus,
                        extra_conf={"spark.driver.memory": "16g",
                                    "spark.eventLog.enabled": "true",
                                    "spark.eventLog.dir": event_dir})
    # one untimed warm-up run of the flagship on the smoke tables (JIT, class loading)
    smoke = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(smoke):
        QUERIES["feature_table"](spark, smoke).write.format("noop").mode("overwrite").save()

    times, errors = {}, {}
    for name, fn in QUERIES.items():
        if only and name not in only:
            continue
        spark.sparkContext.setJobDescription(name)
        t0 = time.perf_counter()
        try:
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        except Exception as e:  # keep measuring the others; report the failure
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
            print(f"# {name}: FAILED {errors[name]}", file=sys.stderr)
            continue
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr)
    spark.stop()
    sf = os.path.basename(os.path.normpath(sf_dir)).replace("sf", "")
    out = {"metric": "total_query_sec", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": sf, "cpus": cpus, "groups": groups(times),
           "event_log": event_dir}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))


ML_OPS = {"M7", "M8", "M9", "M11", "M13"}


def groups(times: dict) -> dict:
    """Seconds per kind of query: model fits, source/sink round trips, the rest."""
    out = {"model_fits": 0.0, "sources_sinks": 0.0, "relational": 0.0}
    for name, sec in times.items():
        ops = set(COVERS.get(name, "").split())
        if ops & ML_OPS:
            kind = "model_fits"
        elif any(op[0] in "SKT" for op in ops):
            kind = "sources_sinks"
        else:
            kind = "relational"
        out[kind] = round(out[kind] + sec, 3)
    return out


if __name__ == "__main__":
    main()
