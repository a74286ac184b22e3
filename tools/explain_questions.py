"""Print ``explain("formatted")`` of the eight questions on a written star.

usage: python tools/explain_questions.py [sf_dir] [question ...]

Builds the OLTP tables from the driver tables and runs the pipeline into a
scratch folder under ``spark.checkpoint.dir``, then prints the final adaptive
plan of each question (run once first so AQE has re-planned).
"""

from __future__ import annotations

import os
import sys
import uuid

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from carestar.plans import questions as Q  # noqa: E402
from carestar.plans.pipeline import run_pipeline  # noqa: E402
from carestar.plans.star import TEST_PARAMS as P  # noqa: E402
from carestar.schemas import OLTP, STAR  # noqa: E402
from carestar.session import checkpoint_dir, get_session  # noqa: E402
from carestar.sources import sinks  # noqa: E402
from carestar.sources.adapter import oltp_from_driver  # noqa: E402


def main() -> None:
    args = sys.argv[1:]
    sf = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    wanted = [a for a in args if not os.path.isdir(a)]
    spark = get_session("local[8]", shuffle_partitions=16)
    base = os.path.join(checkpoint_dir(spark), f"carestar-explain-{uuid.uuid4().hex[:8]}")
    for name, df in oltp_from_driver(spark, sf).items():
        sinks.write_table(df, os.path.join(base, "oltp", name))
    oltp = {n: spark.read.parquet(os.path.join(base, "oltp", n)) for n in OLTP}
    run_pipeline(spark, oltp, os.path.join(base, "star"), P, batch_id="EXPLAIN", publish_failed=True)
    star = {n: sinks.read_star(spark, os.path.join(base, "star"), n) for n in STAR}
    plans = {"q1_oltp": lambda: Q.q1_oltp(oltp, P.since), "q1_star": lambda: Q.q1_star(star, P.since_year),
             "q2_oltp": lambda: Q.q2_oltp(oltp), "q2_star": lambda: Q.q2_star(star),
             "q3_oltp": lambda: Q.q3_oltp(oltp, P.since), "q3_star": lambda: Q.q3_star(star, P.since_year),
             "q4_oltp": lambda: Q.q4_oltp(oltp, P.since), "q4_star": lambda: Q.q4_star(star, P.since_year)}
    for name, make in plans.items():
        if wanted and name not in wanted:
            continue
        df = make()
        df.collect()
        print(f"===== {name}")
        df.explain("formatted")


if __name__ == "__main__":
    main()
