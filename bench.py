"""Headline timings: land the driver's rows as a transfers table, then run the analytics on that table.

Prints one JSON line. ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose the input and the number of threads.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import queries, views  # noqa: E402
from transferlens.plans.catalog import run_analytic  # noqa: E402
from transferlens.session import build_session, shared_folder  # noqa: E402
from transferlens.sources import metadata, raw_logs, transfers  # noqa: E402

PARAMETERS = {
    "ecosystem_summary": {},
    "top_active_tokens": {},
    "daily_activity": {"as_of": views.AS_OF},
    "hourly_pattern": {"as_of": views.AS_OF},
    "today_activity": {"day": views.TODAY},
    "trending_tokens": {"as_of": views.AS_OF},
    "volume_leaders": {},
    "transfer_size_distribution": {},
    "whale_transfers": {},
    "top_senders": {},
    "top_receivers": {},
    "multi_token_users": {},
    "holder_distribution": {"token": queries.TOKEN},
    "user_portfolio": {"address": queries.USER},
    "monthly_growth": {},
    "day_of_week_pattern": {"as_of": views.AS_OF},
    "fastest_growing": {"as_of": views.AS_OF},
    "chain_overview": {},
    "symbol_search": {},
    "token_concentration": {},
    "airdrop_candidates": {},
    "minting_activity": {},
    "token_velocity": {},
    "metadata_overview": {},
    "unusual_decimals": {},
    "popular_symbols": {},
    "token_profile": {"token": queries.TOKEN},
    "user_activity": {"address": queries.USER},
    "activity_between": {"start": "2024-02-01 00:00:00", "end": "2024-03-15 12:00:00"},
    "token_balances": {},
}


def seconds(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "transferlens-bench",
        f"local[{cpus}]",
        **{
            "spark.driver.memory": "16g",
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    logs, blocks, chain, activity, names = (
        shared_folder(spark, name) for name in ("logs", "blocks", "chain", "transfers", "metadata")
    )
    views.raw_logs(spark, sf_dir).write.parquet(logs)
    views.blocks(spark, sf_dir).write.parquet(blocks)
    metadata.write_metadata(views.metadata(spark, sf_dir).selectExpr("*", "current_timestamp() AS created_at"), names)
    source = views.transfers(spark, sf_dir).selectExpr("*", "cast(null AS string) AS transaction_hash")
    transfers.write_transfers(queries.wide(source), activity)

    def decode_and_land() -> None:
        decoded = raw_logs.decode_transfers(
            raw_logs.read_raw_logs(spark, logs), raw_logs.read_blocks(spark, blocks)
        )
        transfers.write_transfers(decoded, chain)

    timings = {"decode_and_land": seconds(decode_and_land)}
    events = transfers.read_transfers(spark, chain, 130).count()

    t = transfers.read_transfers(spark, activity, 130)
    m = metadata.read_metadata(spark, names, 130)
    for name, parameters in PARAMETERS.items():
        timings[name] = seconds(
            lambda: run_analytic(name, t, m, **parameters).write.format("noop").mode("overwrite").save()
        )
    result = {
        "metric": "total of all headline queries",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")),
        "ingest_events_per_sec": round(events / timings["decode_and_land"]),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
