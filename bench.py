"""Benchmark the headline queries; prints ONE JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 3; median after one warm-up run).
Every query is fully materialised with the ``noop`` sink (no collect).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from seqintel.plans import queries as Q  # noqa: E402
from seqintel.session import local_session, table  # noqa: E402

HEADLINE = [
    # (bench key, registered query, unit rows come from)
    ("anonymize_b8_b10", "B10_anonymize_record", "documents"),
    ("clean_b12", "B12_clean_text", "documents"),
    ("clean_anonymize_export", "B16_export_projection", "documents"),
    ("fingerprint_dedup", "D1_dedup_first", "documents"),
    ("dictionary_match", "C1_term_match", "documents"),
    ("enrich_posts", "K14_enrich_posts", "documents"),
    ("sequence_building", "D8_phase_sequences", "events"),
    ("author_sequences", "D5_author_sequences", "events"),
    ("decode_predict", "K10_author_analysis", "events"),
    ("decode_chunked", "K8_decode_chunked", "events"),
    ("positions", "E1_chronological_position", "events"),
    ("holdout_eval_stats", "D15_global_metrics", "events"),
    ("page_extraction", "K2_extract_posts", "pages"),
    ("link_extraction", "K3_link_extraction", "pages"),
    ("reachability", "K1_reachable_urls", "orders"),
    ("streaming_dedup", "S1_resumable_ingest", "documents"),
]


def run(spark, name, sf):
    t0 = time.perf_counter()
    Q.QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = local_session(cpus, int(cpus) if cpus.isdigit() else 8, app="seqintel-bench")
    rows = {t: table(spark, sf, t).count() for t in {u for _, _, u in HEADLINE}}
    n_authors = table(spark, sf, "events").select("user_id").distinct().count()
    out: dict[str, float] = {}
    rates: dict[str, float] = {}
    for key, name, unit in HEADLINE:
        run(spark, name, sf)  # warm-up
        times = [run(spark, name, sf) for _ in range(repeat)]
        out[key] = round(statistics.median(times), 3)
        rates[f"{key}_{unit}_per_s"] = round(rows[unit] / out[key], 1) if out[key] > 0 else None
    for key in ("decode_predict", "decode_chunked"):
        rates[f"{key}_authors_per_s"] = round(n_authors / out[key], 1)
    # training: one full fit, seconds per EM iteration and iterations
    from seqintel.operators import hmm as H
    seqs = Q._chunks(spark, sf)
    t0 = time.perf_counter()
    m = H.fit_hmm(seqs)
    fit = time.perf_counter() - t0
    out["hmm_fit"] = round(fit, 3)
    rates["hmm_iterations"] = len(m.history)
    rates["hmm_sec_per_iteration"] = round(fit / max(len(m.history), 1), 3)
    sf_val = re.search(r"sf([0-9.]+)", sf)
    print(json.dumps({"metric": "total_headline_sec", "value": round(sum(out.values()), 3), "unit": "sec",
                      "queries": out, "rates": rates, "sf": float(sf_val.group(1)) if sf_val else sf,
                      "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
