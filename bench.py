"""Benchmark: the full-refresh ETL and the four questions on both models.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 3; the best run of each question is reported), BENCH_TIMINGS
(folder of the table that timings are appended to; default: one of this run).
Prints one JSON line. Steps:
  1. derive the OLTP tables from the driver tables and write them as parquet (``oltp_load``)
  2. run the pipeline OLTP -> star with checks and audit (``etl``)
  3. time each question on the OLTP tables and on the published star
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid
from concurrent.futures import ThreadPoolExecutor

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from carestar.plans import questions as Q  # noqa: E402
from carestar.plans.compare import compare, read_timings, record_timings  # noqa: E402
from carestar.plans.pipeline import run_pipeline  # noqa: E402
from carestar.plans.star import TEST_PARAMS  # noqa: E402
from carestar.session import checkpoint_dir, get_session  # noqa: E402
from carestar.sources import sinks  # noqa: E402
from carestar.sources.adapter import oltp_from_driver  # noqa: E402
from carestar.schemas import OLTP  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = get_session(f"local[{cpus}]", app="carestar-bench", shuffle_partitions=cpus * 2,
                        extra={"spark.sql.files.maxPartitionBytes": str(64 << 20)})
    # scratch under the shared checkpoint folder (a local temp folder only when none is configured)
    base = os.path.join(checkpoint_dir(spark), f"carestar-bench-{uuid.uuid4().hex[:8]}")
    timings: dict[str, float] = {}

    t0 = time.time()
    src = oltp_from_driver(spark, sf_dir)
    oltp_dir = os.path.join(base, "oltp")
    with ThreadPoolExecutor(max_workers=len(src)) as pool:      # independent writes as concurrent jobs
        list(pool.map(lambda kv: sinks.write_table(kv[1].select(*OLTP[kv[0]].fieldNames()),
                                                   os.path.join(oltp_dir, kv[0])), src.items()))
    timings["oltp_load"] = time.time() - t0
    oltp = {n: spark.read.parquet(os.path.join(oltp_dir, n)) for n in OLTP}

    t0 = time.time()
    result = run_pipeline(spark, oltp, os.path.join(base, "star"), TEST_PARAMS, batch_id="BENCH", publish_failed=True)
    timings["etl"] = time.time() - t0
    star = {n: sinks.read_star(spark, os.path.join(base, "star"), n) for n in
            ["dim_date", "dim_patient", "dim_provider", "dim_specialty", "dim_department", "dim_encounter_type",
             "dim_diagnosis", "dim_procedure", "fact_encounters", "bridge_encounter_diagnoses",
             "bridge_encounter_procedures"]}

    p = TEST_PARAMS
    plans = {
        "q1_oltp": lambda: Q.q1_oltp(oltp, p.since), "q1_star": lambda: Q.q1_star(star, p.since_year),
        "q2_oltp": lambda: Q.q2_oltp(oltp), "q2_star": lambda: Q.q2_star(star),
        "q3_oltp": lambda: Q.q3_oltp(oltp, p.since), "q3_star": lambda: Q.q3_star(star, p.since_year),
        "q4_oltp": lambda: Q.q4_oltp(oltp, p.since), "q4_star": lambda: Q.q4_star(star, p.since_year),
    }
    for name, make in plans.items():
        best = None
        for _ in range(max(1, repeat)):
            t0 = time.time()
            make().collect()
            el = time.time() - t0
            best = el if best is None else min(best, el)
        timings[name] = best

    questions = sum(v for k, v in timings.items() if k.startswith("q"))
    recorded = os.environ.get("BENCH_TIMINGS", os.path.join(base, "query_timings"))
    record_timings(spark, recorded, timings)
    report = {r["question"]: r["speedup"] for r in compare(read_timings(spark, recorded)).collect()}   # N5
    out = {
        "metric": "four_questions_both_models_total", "value": round(questions, 3), "unit": "sec",
        "queries": {k: round(v, 3) for k, v in timings.items()},
        "sf": sf_dir.rstrip("/").split("sf")[-1], "cpus": cpus,
        "etl_status": result.status, "fact_rows": result.counts.get("fact_encounters"),
        "star_rows": {k: v for k, v in result.counts.items() if not k.startswith("_work")},
        "oltp_total": round(sum(v for k, v in timings.items() if k.endswith("_oltp")), 3),
        "star_total": round(sum(v for k, v in timings.items() if k.endswith("_star")), 3),
        "speedup_oltp_over_star": report,
    }
    print(json.dumps(out))


if __name__ == "__main__":
    main()
