"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs to completion into the no-op sink (full computation, nothing
collected).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from feedlens.plans import registry  # noqa: E402
from feedlens.session import build_session  # noqa: E402

HEADLINE = [
    "articles_documents",      # adapter: clean 100% of the text
    "merge_by_key",            # E1
    "number_articles",         # E1 + F1
    "profile_period",          # M2
    "impact_scores_corpus",    # I1 + I2
    "selection",               # M3 table
    "render_script",           # R1
    "link_post",               # R5 + E14 + D1 + R4
    "flag_duplicates_exact",   # J2
    "flag_duplicates",         # J3 (with the similarity join)
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2,
                          app_name="feedlens-bench")
    # warm-up: JVM, Python workers, parquet footers
    registry.QUERIES["occurrence_histogram"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.perf_counter()
        registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_wall_clock", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
