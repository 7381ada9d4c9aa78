"""Headline queries over $BENCH_SF_DIR on local[$BENCH_CPUS]; one JSON line."""

from __future__ import annotations

import json
import os
import time

from loomwright import catalog
from loomwright.session import local_session

HEADLINE = ("link_status", "link_summary", "html_strip_pages", "signal_density", "chunk_paragraphs", "tfidf_related", "tfidf_search", "strategy_score", "card_text", "topk_per_key", "changed_files_agg", "pack_parts_size", "diagnostic_cards", "resolver_cards")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, int(cpus) if cpus.isdigit() else 8, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    queries, took = catalog.queries(), {}
    spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    for name in HEADLINE:
        began = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - began, 3)
    print(json.dumps({"metric": "headline queries, total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(sf_dir.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
