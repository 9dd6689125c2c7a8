"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (data directory), BENCH_CPUS (local cores), BENCH_KEYS (comma
separated names, or ``all``), BENCH_RUNS (runs of each query; the median counts). Results
go to Spark's no-op sink, so every row is computed and nothing is collected. With
BENCH_STORED the derived tables are then written once and all queries timed again from them.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import time

from limelight.registry.queries import fixture, flagship, queries
from limelight.session import build_session, clear_scratch, scratch_dir

HEADLINE = (
    "merge_sources", "scored_artists", "score_zero_filled", "top_underrated", "high_growth",
    "genre_summary", "growth_summary", "overview_metrics", "key_insights", "describe_scores",
    "histogram", "platform_normalised", "display_rows", "dashboard_view", "option_lists",
    "parse_artist_info", "first_hit_per_artist", "discover_artists", "latest_per_artist",
    "append_batch", "latest_posts", "post_engagement", "extract_handles", "verify_handles",
    "resolve_handle", "social_profiles", "artist_channel_candidates", "best_channel",
    "recent_video_mean", "video_channels", "track_video", "release_posts", "song_records",
    "song_catalogue", "quota_prefix", "source_row_counts", "rate_limit_seen", "stream_upsert",
)


#: Derived tables that BENCH_STORED keeps, so that operators are timed from them on.
SOURCES = (
    "listening", "social", "video", "raw", "profiles", "posts", "channels", "channel_search",
    "videos", "chart", "tracks", "video_search", "batches", "log_lines", "attempts",
    "tag_payloads", "chart_payloads", "info_payloads",
)


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(keys, available, spark, sf_dir: str, runs: int, after) -> dict[str, float]:
    """Median seconds of each query; ``after`` runs between runs, unmeasured."""
    seconds = {}
    for key in keys:
        taken = []
        for _ in range(runs):
            start = time.perf_counter()
            run(available[key](spark, sf_dir))
            taken.append(time.perf_counter() - start)
            after()
        seconds[key] = round(statistics.median(taken), 3)
    return seconds


def store_sources(spark, sf_dir: str) -> None:
    """Write the derived tables once and let the queries read them."""
    derived = fixture(spark, sf_dir)
    for name in SOURCES:
        path = scratch_dir(spark, name)
        getattr(derived, name).write.parquet(path)
        setattr(derived, name, spark.read.parquet(path))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_KEYS", "")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    available = queries()
    keys = available if wanted == "all" else (wanted.split(",") if wanted else HEADLINE)
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": str(4 * int(cpus)), "spark.driver.memory": "12g"},
    )
    run(flagship(spark, sf_dir))  # warm-up: class loading and code generation
    seconds = timed(keys, available, spark, sf_dir, runs, lambda: clear_scratch(spark))
    more = {}
    if os.environ.get("BENCH_STORED"):
        store_sources(spark, sf_dir)
        more["from_stored"] = timed(keys, available, spark, sf_dir, runs, lambda: None)
    scale = re.search(r"sf([\d.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(scale.group(1)) if scale else None, "cpus": int(cpus), **more,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
