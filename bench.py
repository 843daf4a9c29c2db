"""Headline timings: ``BENCH_SF_DIR`` (default sf0.1) on ``local[BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from changeweir.operators.apply import with_meta
from changeweir.operators.lake import LakeTable
from changeweir.plans.registry import QUERIES
from changeweir.schemas import SALES
from changeweir.session import build_session, scratch_folder
from changeweir.sources import fixtures as fx

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))

HEADLINE = [
    "customer_order_summary",
    "high_value_orders",
    "order_status_dashboard",
    "daily_order_metrics",
    "customer_spending_tier",
    "recent_orders",
    "recent_orders_top5",
    "tier_rollup",
    "pivot_status_revenue",
    "customer_spend_rank",
    "cumulative_revenue",
    "moving_avg_revenue",
    "amount_percent_rank",
    "top2_per_customer",
    "customers_above_avg_spend",
    "orders_above_own_avg",
    "customers_without_orders",
    "self_join_same_amount",
    "latest_per_key",
    "apply_changes_final",
    "late_changes_final",
    "change_audit_diff",
    "typed_rows",
    "envelope_after",
    "reconcile_diff",
    "dq_summary",
]


def timed(run) -> float:
    started = time.perf_counter()
    run()
    return round(time.perf_counter() - started, 3)


def drain(df) -> None:
    """Compute every column of every row and keep nothing."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = build_session("bench", f"local[{CPUS}]", CPUS, {"spark.ui.enabled": "false", "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    drain(QUERIES["customer_order_summary"](spark, SF_DIR))  # class loading, first code generation

    seconds = {name: min(timed(lambda n=name: drain(QUERIES[n](spark, SF_DIR))) for _ in range(2)) for name in HEADLINE}

    # One batch of changes into a lake table: source commit to sink commit.
    spec, log = SALES["orders"], fx.order_changes(spark, SF_DIR)
    changes = log.count()
    tables = [LakeTable(spark, scratch_folder(spark, "bench"), spec.schema, spec.key).create() for _ in range(2)]
    seconds["merge_bulk"] = min(timed(lambda t=t: t.merge(with_meta(log, spec), "bulk")) for t in tables)
    table = tables[0]
    small = log.filter("id % 100 = 7").withColumn("seq", log["seq"] + 10)
    seconds["merge_small_batch"] = min(
        timed(lambda i=i: table.merge(with_meta(small.withColumn("seq", small["seq"] + i), spec), f"small-{i}"))
        for i in range(3)
    )
    seconds["lake_read"] = timed(lambda: drain(table.read()))
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": SF_DIR,
                "merge_rows_per_sec": round(changes / seconds["merge_bulk"]),
            }
        )
    )


if __name__ == "__main__":
    main()
