"""Headline queries on ``$BENCH_SF_DIR`` with ``$BENCH_CPUS`` cores; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from bandstand.checks import QUERIES
from bandstand.runtime import local_session

HEADLINE = [
    "p2_stage_artists",
    "p3_stage_albums",
    "mart_subgenre_health",
    "mart_album_legacy",
    "mart_artist_features",
    "p1_flatten_artists",
    "a9_dedupe_artists",
    "j1_merge_metadata",
    "e_a4_weekly_rows",
    "j8_match_landed_candidates",
    "j8_link_names",
    "j11_expand_tracks",
    "x1_tag_intervals",
    "x5_change_around_releases",
    "a14_medians_of_orders",
    "m4_stratified_split",
    "m9_roc_auc",
    "v2_engagement_points",
    "w7_underground_ranking",
]


def run(spark, name: str, d: str) -> float:
    begin = time.perf_counter()
    QUERIES[name](spark, d).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin


def main() -> None:
    d = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("bandstand-bench", os.environ.get("BENCH_CPUS", "8"))
    # A first run of each query starts compilers and Python workers and is not counted.
    first = {name: round(run(spark, name, d), 3) for name in HEADLINE}
    times = {name: round(run(spark, name, d), 3) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "first_run": first,
                "sf": os.path.basename(d.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
