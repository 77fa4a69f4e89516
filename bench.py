"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to warm up and once on the clock, into a sink that reads
every row and writes nothing. BENCH_QUERIES (names, or 'all') picks others.
"""

from __future__ import annotations

import json
import os
import sys
import time

from voltmesh.plans.catalogue import all_queries
from voltmesh.session import get_session

HEADLINE = """
available_by_region prefix_join_counts merge_status buffer_upsert insert_ignore latest_per_key
enrich_region_left reverse_geocode geocode_address repair_region nearby_pairs nearby_counts
spread_overlaps station_representative nearest_station_search bbox_stations company_dim
review_page_all review_page keyset_page review_summary delete_review upsert_users
bookmark_state recent_search_state filter_state flag_array_state json_roundtrip
decode_attachments render_notice replace_table scan_station_xml stream_merge_status
stream_latest_state stream_user_state
""".split()


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    queries = all_queries()
    if names == ["all"]:
        names = list(queries)
    spark = get_session("bench", cpus=cpus, spark__sql__shuffle__partitions=cpus)
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        run(queries[name](spark, folder))
        began = time.perf_counter()
        run(queries[name](spark, folder))
        seconds[name] = round(time.perf_counter() - began, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries, warm",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
