"""Headline queries timed on local[$BENCH_CPUS] at $BENCH_SF_DIR; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from catalog import QUERIES  # noqa: E402
from textree.operators.features import dense_matrix  # noqa: E402
from textree.plans import tree as tr  # noqa: E402
from textree.storage import local_session, store  # noqa: E402
from catalog.base import FEATURES, lines  # noqa: E402

HEADLINE = [
    "build_corpus",
    "clean_chain",
    "term_counts",
    "tfidf",
    "tfidf_stemmed",
    "class_counts",
    "histogram",
    "best_split",
    "candidates_ranged",
    "balanced_sample",
    "except_all",
    "row_index",
    "tree_text_fit",
    "report",
]


def timed(run) -> float:
    started = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - started, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, os.environ.get("BENCH_MEMORY", "16g"))
    QUERIES["best_split"](spark, sf_dir).collect()  # start the JVM's code paths once
    seconds = {}
    for name in HEADLINE:
        seconds[name] = timed(lambda name=name: QUERIES[name](spark, sf_dir))
    table = lines(spark, sf_dir)
    seconds["tree_fit_depth5"] = timed(lambda: tr.fit(dense_matrix(table, FEATURES, "y"), max_depth=5))
    tree = store(tr.fit(dense_matrix(table, FEATURES, "y"), max_depth=5), "bench-tree").df
    seconds["tree_predict"] = timed(lambda: tr.predict(table, tree))
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
