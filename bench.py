"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

``python bench.py all`` times every registered query, ``python bench.py name ...`` the named ones. Each query
runs once cold, in the order of the list ("queries"), and then ``BENCH_WARM`` times more (1); "warm" holds the
least of these.
"""

from __future__ import annotations

import json
import os
import sys
import time

from rollweave.plans import registry
from rollweave.session import local_session

HEADLINE = (
    "sft_statistics",
    "turns_to_messages",
    "rendered_chats",
    "vocabulary",
    "encoded_documents",
    "assistant_only_rows",
    "preference_rows",
    "sft_filter",
    "resized_sources",
    "mixed_fractions",
    "shuffled_positions",
    "epoch_permutation",
    "packed_sequences",
    "pair_batches_padded",
    "length_buckets",
    "joined_rollouts",
    "scored_rewards",
    "token_f1",
    "latex_answers",
    "group_advantages",
    "zero_variance_groups",
    "step_metrics",
    "tool_statistics",
    "length_percentiles",
    "best_and_worst",
    "majority_votes",
    "candidate_pairs",
    "context_fit",
    "pruned_rubrics",
    "registry_constraint_rules",
)


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    queries = registry.queries()
    wanted = sys.argv[1:]
    names = list(queries) if wanted == ["all"] else wanted or [n for n in HEADLINE if n in queries]
    spark = local_session(cores)
    spark.read.parquet(f"{root}/region.parquet").count()

    def timed(name: str) -> float:
        begin = time.perf_counter()
        queries[name](spark, root).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - begin, 3)

    again = int(os.environ.get("BENCH_WARM", "1"))
    times, warm = {}, {}
    for name in names:
        times[name] = timed(name)
        warm[name] = min((timed(name) for _ in range(again)), default=times[name])
        print(f"{name} {times[name]} {warm[name]}", file=sys.stderr, flush=True)
    line = {"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times}
    line |= {"warm": warm, "warm_total": round(sum(warm.values()), 3)}
    print(json.dumps({**line, "sf": root.rstrip("/").split("/")[-1], "cores": int(cores)}))
    spark.stop()


if __name__ == "__main__":
    main()
