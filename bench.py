"""Headline query times; prints one JSON line.

Reads BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8).
Every query runs in full into a sink that discards the rows. Names may be given
as arguments to time only those.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from foghorn.catalog import QUERIES  # noqa: E402
from foghorn.session import build_session  # noqa: E402

HEADLINE = [
    "interest_score", "score_summary_by_stratum", "top10_by_stratum", "targeted_prospects",
    "append_keep_last", "company_rollup", "recency_ranking", "country_industry_heat",
    "timeline_two_stage", "monthly_top_segments", "industry_indicators", "coverage_gaps",
    "coverage_summary", "signal_mix", "qa_coverage", "exact_group_quantiles", "pillar_index",
    "bootstrap_interval", "entity_merge", "stratified_sample", "price_move",
    "theme_cooccurrence", "enrich_strength", "classify_rules", "term_frequency",
    "mention_join", "short_mentions", "exact_then_token_match", "registry_matches",
    "page_text", "json_articles", "streaming_volume",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", cpus)
    # one untimed query: the JVM and its Python workers start before the clock runs
    QUERIES["strata_counts"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        begin = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - begin, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
