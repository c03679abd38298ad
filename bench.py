"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parent
sys.path.insert(0, str(ROOT))

from affinary.catalog import QUERIES  # noqa: E402
from affinary.session import build_session  # noqa: E402

HEADLINE = [
    "interactions",
    "filter_strings",
    "distinct_first",
    "resolve_label_conflicts_orders",
    "assemble_features",
    "downsample_negatives_orders",
    "batch_index_orders",
    "rank_scored_orders",
    "rank_metrics_orders",
    "slice_report_orders",
    "auc_orders",
    "log_loss_orders",
    "min_max_scaled",
    "candidates_per_user",
    "top_items_per_user",
    "rank_of_pairs",
    "cosine_top_items",
    "offline_evaluation",
    "upsample_negatives",
    "training_batches",
    "stored_training_set",
    "train_score_evaluate",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.driver.memory": "16g",
            "spark.sql.shuffle.partitions": cpus,
            # the tables are small here: let adaptive execution keep all cores busy
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # start the JVM, the reader and the writer before the clock runs
    QUERIES["interactions"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    wanted = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in wanted:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
