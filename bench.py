"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR   folder with the tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_QUERIES  comma-separated names, or "all" for everything registered
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from linewatch import session  # noqa: E402
from linewatch.registry import REGISTRY  # noqa: E402

HEADLINE = [
    "stg_rdt_services", "stg_ns_departures", "stg_ns_disruptions", "int_departures_combined",
    "int_train_delays_daily", "int_ndw_traffic_daily", "free_flow_speed", "departure_rollup",
    "fct_train_performance", "fct_road_traffic", "dm_multimodal_daily", "service_volume_weekly",
    "disruption_causes_by_week", "station_performance", "operator_mix", "corridor_top_causes",
    "weather_condition_summary", "system_figures", "operator_profiles", "monthly_departures",
    "operator_ranking", "busiest_stations", "network_scale", "delay_attribution",
    "reliability_alerts_all_days", "quality_report",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(REGISTRY) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = (
        session.builder("linewatch-bench", **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
        })
        .master(f"local[{cpus}]").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in names:
        for attempt in ("warm-up", "timed"):
            started = time.perf_counter()
            REGISTRY[name](spark, folder).write.format("noop").mode("overwrite").save()
            if attempt == "timed":
                seconds[name] = round(time.perf_counter() - started, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "headline queries, total wall time after one warm-up",
        "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
