"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line: {"metric", "value" (total sec), "unit", "queries", "sf"}.
Each query is executed to completion with the no-op sink (full computation,
no driver collect).  Before timing, one query per family runs once on the
tiny sf0.001 tables (untimed) so class loading and JIT warm-up are not
charged to whichever query happens to run first.
"""
from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rostrum.plans.catalog import QUERIES  # noqa: E402
from rostrum.session import get_session  # noqa: E402

HEADLINE = [
    "age_a1_label_map", "age_a2_phrase", "age_a3_phrase_hdr", "age_a4_band_subcat", "age_a5_two_col",
    "age_a6_simple120",
    "name_n1_degree_caps", "name_n2_degree_dict", "name_n3_credential_org", "name_n4_credential_list",
    "name_n5_credential_clean", "name_n6_format_detect",
    "roster_dedupe_four_list", "roster_audit_four_list", "roster_dedupe_three",
    "file_exclude", "path_prefix", "path_listing",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(f"local[{cpus}]", int(cpus))
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in QUERIES]
    # warm-up of each code path on the smallest tables -- not timed
    warm_dir = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if not os.path.isdir(warm_dir):
        warm_dir = sf_dir
    for name in ["age_a3_phrase_hdr", "name_n5_credential_clean", "roster_dedupe_three", "path_listing"]:
        try:
            QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
        except Exception:
            pass
    times, failed = {}, {}
    for name in names:
        t0 = time.perf_counter()
        try:
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        except Exception as exc:  # keep measuring the others; report the failure
            failed[name] = type(exc).__name__
            continue
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(m.group(1)) if m else sf_dir}
    if failed:
        out["failed"] = failed
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
