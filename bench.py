"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query runs over the whole tables and its full result is produced (no-op sink). The first query
is run once beforehand, untimed, to start the JVM and load classes.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "json_bad", "speech_rows", "split_stream", "active_speakers", "author_ids",
    "ngrams_pass1", "term_stats", "author_term_counts", "vocab_ids", "dtm_counts", "deoverlap", "packed_docs",
    "candidates", "procedural_score", "without_procedural", "ordered_subset", "prepare_tables",
    "topic_top_terms", "pair_cooccurrence", "npmi", "topic_overlap_score", "topic_metrics",
    "pf_init", "pf_doc_step", "pf_topic_step", "pf_elbo", "pf_fit", "pf_multi_seed", "scaled_theta",
    "lda_online", "lda_em", "topic_init",
    "csv_chunks", "ordered_subset_greedy", "lda_gibbs", "lda_eval_theta",
]


def main() -> None:
    from catalog import QUERIES
    from pyspark.sql import SparkSession

    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("rostrum-bench")
             .config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "16g")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    run = lambda name: QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    names = sys.argv[1:] or HEADLINE
    run(names[0])
    took = {}
    for name in names:
        t0 = time.time()
        run(name)
        took[name] = round(time.time() - t0, 3)
        print(f"{name} {took[name]}", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "headline_total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took,
                      "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
