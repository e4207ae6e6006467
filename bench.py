"""Time the headline queries; print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_QUERIES (comma list).

A table of the input is one row group, which only one task can read, however many cores there are. Tables of large
data are many files; so `documents` and `pages` are laid out in one file a core before the clock starts
(`input_files` in the output; BENCH_FILES=1 leaves them as they are).
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from hooklens.plans import catalog  # noqa: E402
from hooklens.session import build_session  # noqa: E402

HEADLINE = (
    "q_message_scan", "q_text_projection", "q_corpus_merge", "q_stratified_split", "q_synth_headers",
    "q_adversarial_expand", "q_url_table", "q_url_signals", "q_url_features", "q_list_join",
    "q_header_domains", "q_link_table", "q_flags_suffix", "q_flags_prefix", "q_mask_domains",
    "q_rule_hits", "q_rule_details", "q_risk_score", "q_hybrid_decision", "q_stream_decisions",
    "q_pr_curve", "q_threshold", "q_metrics_summary", "q_robustness", "q_error_typology",
    "q_error_examples", "q_term_df", "q_tfidf_terms", "q_e0_scores", "q_e5_scores",
)


LAID_OUT = ("documents", "pages")


def laid_out(spark, sf_dir: str, files: int) -> str:
    """A folder with the tables of `sf_dir`, those of LAID_OUT in so many files."""
    if files < 2:
        return sf_dir
    folder = tempfile.mkdtemp(prefix="run-")
    for name in sorted(os.listdir(sf_dir)):
        if name.removesuffix(".parquet") in LAID_OUT:
            spark.read.parquet(f"{sf_dir}/{name}").repartition(files).write.parquet(f"{folder}/{name}")
        else:
            os.symlink(f"{sf_dir}/{name}", f"{folder}/{name}")
    return folder


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    spark = build_session(cpus, shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    runs = catalog.queries()
    files = int(os.environ.get("BENCH_FILES", cpus))
    data = laid_out(spark, sf_dir, files)
    # start the executor threads and the readers before the clock
    spark.read.parquet(f"{data}/documents.parquet").selectExpr("sum(length(text))").collect()
    seconds: dict[str, float] = {}
    for name in chosen.split(",") if chosen else HEADLINE:
        start = time.perf_counter()
        runs[name](spark, data).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(scale.group(1)) if scale else None,
        "input_files": files,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
