"""Time the headline queries; prints one JSON line.

Environment: ``BENCH_SF_DIR`` (data folder), ``BENCH_CPUS`` (cores), ``BENCH_QUERIES`` (a comma
list, or ``all``), ``BENCH_RUNS`` (timed runs per query; the best counts).
"""

from __future__ import annotations

import json
import os
import re
import time

from quayside.plans.catalog import QUERIES
from quayside.session import local_session

HEADLINE = (
    "ranged_scan typed_load coerce_rejects coerce_timestamp align_columns upsert_mirror upsert_changes "
    "insert_ignore insert_replace assign_identity unique_violations fk_violations verify_counts "
    "topn_per_key group_concat json_group_array strftime julianday json_extract json_contains "
    "insert_ignore_keys insert_ignore_chain catch_up_stream coerce_integer coerce_double inverted_index search_and search_rank search_by_index search_phrase_by_index search_rank_by_index group_concat_parts copy_upsert publish_followed offset_page_deep present_iso"
).split()


def once(spark, sf_dir: str, name: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "quayside-bench")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark.range(1000).selectExpr("sum(id)").collect()  # start the executor
    times = {n: round(min(once(spark, sf_dir, n) for _ in range(runs)), 3) for n in names}
    scale = re.search(r"sf([\d.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total of headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale[1]) if scale else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
