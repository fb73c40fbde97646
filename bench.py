"""Time the headline jobs; prints one JSON line.

Each job first runs on the smallest tables beside the wanted ones (so the JVM is
warm), then ``BENCH_RUNS`` times (default 1) into a sink that discards the rows; the
best time counts.
"""

from __future__ import annotations

import json
import os
import time

from protolith.plans import JOBS
from protolith.session import configure, local_session

HEADLINE = (
    "wide_summary", "rank_order", "agg_evidence_list", "agg_median_overlap",
    "load_results", "decode", "find_remaining", "select_target", "rank_view",
    "dedup_encode", "seq_checksum", "motif_scan", "motif_scan_multi", "run_length",
    "project_plus", "project_features", "bedgraph_max", "bedgraph_mean", "bedgraph_median",
    "features_from_results", "src_lines", "src_blocks", "snk_gff", "gff_order",
    "score_effector", "project_generic", "map_to_genome_gff", "src_xml", "track_split", "descendants",
    "analysis_tables",
)


def run(spark, name: str, sf_dir: str) -> float:
    began = time.perf_counter()
    JOBS[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    wanted = os.environ.get("BENCH_ONLY", "").split() or HEADLINE
    spark = configure(local_session(cores, "bench"))
    times: dict[str, float] = {}
    small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    for name in wanted:
        if os.path.isdir(small):
            run(spark, name, small)
        times[name] = round(min(run(spark, name, sf_dir) for _ in range(runs)), 3)
    print(json.dumps({
        "metric": "headline jobs, total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
