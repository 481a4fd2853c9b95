"""Benchmark of the headline queries.

Runs each query at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]``: one warm-up, then the median of ``$BENCH_RUNS`` runs.
Each run executes the whole plan into Spark's ``noop`` sink, so nothing is
collected to the driver. Prints one JSON line: seconds per query
(``queries``), their total (``value``), and output rows and rows per second per
query, and tokens per second where tokens are made (counted once, outside the timed runs).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "encode_masked", "vocab", "token_profile", "subset_pct", "shuffle_index",
    "batch_padding", "history_prompt", "render_alpaca", "clean_text",
    "field_profile", "token_f1", "accuracy_rollup", "retrieve_topk", "training_set",
]
LATER = ["training_set_all", "token_view", "mix_sources", "decode_tokens", "history_stream"]
# queries whose output holds the tokens they made, and the column that counts them
TOKENS = {"encode_masked": "n_tokens"}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from tunemill.plans.catalog import QUERIES
    from tunemill.session import get_session

    spark = get_session(f"local[{cpus}]", shuffle_partitions=max(cpus, 8), app="tunemill-bench")
    # The test files are one row group each: spread them, as the many files of a large table are.
    spark.conf.set("tunemill.load.partitions", str(cpus))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    times: dict[str, float] = {}
    rows: dict[str, int] = {}
    rate: dict[str, float | None] = {}
    tokens: dict[str, float] = {}
    for name in only or HEADLINE + LATER:
        fn = QUERIES[name]

        def once() -> float:
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0
        once()  # warm-up
        times[name] = round(statistics.median(once() for _ in range(runs)), 3)
        n = fn(spark, sf_dir).count()  # output rows, counted outside the timing
        rows[name] = n
        rate[name] = round(n / times[name], 1) if times[name] else None
        if name in TOKENS:
            total = fn(spark, sf_dir).agg({TOKENS[name]: "sum"}).first()[0]
            tokens[name] = round(total / times[name], 1)

    # the total is over the queries of the first round, so that rounds compare
    total = round(sum(t for n, t in times.items() if n not in LATER), 3)
    print(json.dumps({"metric": "headline_total_median_sec", "value": total, "unit": "sec",
                      "total_with_later_queries": round(sum(times.values()), 3),
                      "queries": times, "sf": sf, "cpus": cpus, "runs": runs,
                      "rows": rows, "rows_per_sec": rate, "tokens_per_sec": tokens}))
    spark.stop()


if __name__ == "__main__":
    main()
