"""Bench: run the headline plans at $BENCH_SF_DIR on local[$BENCH_CPUS] and
print one JSON line with per-query seconds.

Each plan is executed in full through the ``noop`` sink (every row computed,
nothing collected to the driver).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "top9_plus_rest",
    "day_hour_grid",
    "null_profile",
    "undersample_majority",
    "sequential_split",
    "word_ngrams",
    "tfidf_vectors",
    "nb_score",
    "lexicon_score_rules",
    "build_postings",
    "retrieve_tfidf",
    "gold_pairs",
    "interpolated_precision_avg",
    "largest_cluster_top_genres",
    "als_fit",
    "two_part_model",
]
# The heaviest plans: the first three always run and are listed with the others, outside the headline total; the two
# grids of 135 fits each run only with BENCH_HEAVY=1.
HEAVY = ["concat_feature_spaces", "kmeans_user_factors", "als_grid"]
GRIDS = ["cross_validate_grid", "scale_up_refit"]
TABLES = ("events", "part", "documents", "embeddings", "labels", "benchmark", "lineitem", "orders")


def split_tables(spark, sf_dir: str, parts: int) -> str:
    """The tables as several files each, as a table of any size is stored; the generated ones have one row group,
    which is one task. Written once, outside the timed part."""
    from kestrel.session import scratch_path

    out = scratch_path(spark, "bench-input")
    for name in TABLES:
        df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        df.repartition(parts if df.count() > 1000 else 1).write.parquet(f"{out}/{name}.parquet")
    return out



def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from kestrel.plans import all_queries
    from kestrel.session import get_session

    spark = get_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2, app="kestrel-bench")
    qs = all_queries()
    names = sys.argv[1:] or HEADLINE + HEAVY + (GRIDS if os.environ.get("BENCH_HEAVY") else [])
    # warm the JVM and the file listing cache once
    spark.read.parquet(f"{sf_dir}/region.parquet").write.format("noop").mode("overwrite").save()
    where = split_tables(spark, sf_dir, int(cpus))
    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        df = qs[name](spark, where)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"{name}: {times[name]}s", file=sys.stderr)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_total", "value": round(sum(v for k, v in times.items() if sys.argv[1:] or k in HEADLINE), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))


if __name__ == "__main__":
    main()
