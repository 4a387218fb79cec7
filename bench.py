"""Time the headline queries: prints one JSON line.

Reads $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS]. The lake, that is the
raw, clean, gold and warehouse tables the reports read, is built first and timed as
`build_lake`. Then one day is run that ships whole tables: `clean_day`, `gold_day`, `load_day`.
Every query then runs once to warm up and three times for its median; its whole result is
computed, but not collected. Written tables go below $BENCH_SCRATCH, a new folder if unset.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F

from daygrain.plans.warehouse import Warehouse
from daygrain.registry import QUERIES, runs
from daygrain.registry.star import Star
from daygrain.session import build_session, shared_dir
from daygrain.sinks.partitions import write_gold

HEADLINE = (
    # The four scan and join queries on text files and on the clean zone.
    "b1_raw", "b1_events_by_type", "b2_raw", "b2_sessions_by_type",
    "b3_raw", "b3_mobile_per_day", "b4_raw", "b4_revenue_by_status",
    # Reports on the warehouse.
    "kpi1_funnel", "kpi2_revenue", "kpi3_on_time", "kpi4_sellers",
    # The steps of a day's run over all days at once.
    "q9_unique", "q10_apply_rules", "q12_summary", "g6_sessions", "g6_sessions_of_day",
    "g7_customer_feed", "g8_fact_orders", "g9_fact_items", "g10_dim_product",
    "m1_upsert_product", "m3b_scd2_history", "j5_point_in_time", "m5_fact_orders_merge",
    "v4_overlap", "v6_totals", "v8_wrong_version", "r1_three_way", "r5_session_diff",
    # Profiling of the source.
    "p14_best_window", "p21_duplicate_keys", "p35_payment_mismatch", "p36_moved_people",
)
RUNS = 3


def lake(star: Star) -> None:
    star.warehouse
    star.raw_events, star.raw_orders, star.raw_items


def load_day(star: Star) -> None:
    """The gold day into an empty warehouse, with the sellers and first addresses it needs."""
    folder, _ = runs.gold_day(star)
    write_gold(star.spark, star.dim_seller, folder, "dim_seller", runs.DAY)
    feed = star.feed.groupBy("customer_unique_id").agg(
        F.min_by(F.struct("zip", "city", "state", "effective_date"), "effective_date").alias("a")
    )
    feed = feed.select("customer_unique_id", "a.*")
    write_gold(star.spark, feed, folder, "customer_feed", runs.DAY)
    warehouse = Warehouse(
        star.spark, shared_dir(star.spark, "warehouse"), calendar=star.dim_date, grain="year"
    )
    warehouse.load_day(runs.DAY, folder)


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.driver.memory": "16g",
            "spark.sql.shuffle.partitions": cpus,
            "spark.checkpoint.dir": os.environ.get("BENCH_SCRATCH") or tempfile.mkdtemp(),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    star = Star(spark, folder)
    seconds = {"build_lake": timed(lambda: lake(star))}
    runs.ship(star)
    seconds["clean_day"] = timed(lambda: runs.clean_day(star))
    seconds["gold_day"] = timed(lambda: runs.gold_day(star))
    seconds["load_day"] = timed(lambda: load_day(star))
    for name in HEADLINE:

        def run() -> None:
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()

        run()
        seconds[name] = statistics.median(timed(run) for _ in range(RUNS))
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "sum of median query times, lake build included",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {name: round(s, 3) for name, s in seconds.items()},
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
