"""Jobs for spark-submit: ``python -m transferlens ingest | resume | load-metadata | drop-chain | query``."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import functions as F

from transferlens.functions.amounts import amounts_of
from transferlens.plans.catalog import ANALYTICS, run_analytic
from transferlens.schema import CHAINS, DEFAULT_CHAIN
from transferlens.session import build_session
from transferlens.sources import metadata, raw_logs, transfers
from transferlens.streaming.ingest import ingest_stream
from transferlens.streaming.totals import ingest_totals


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="transferlens")
    jobs = parser.add_subparsers(dest="job", required=True)

    ingest = jobs.add_parser("ingest", help="decode log files that arrived since the last run")
    for name in ("logs", "blocks", "table", "checkpoint"):
        ingest.add_argument(f"--{name}", required=True)
    ingest.add_argument("--format", default="parquet")
    ingest.add_argument("--max-files", type=int, default=1000)
    ingest.add_argument("--rejects", help="folder for logs that do not decode")

    resume = jobs.add_parser("resume", help="decode logs again from the last stored block on, replacing that block")
    for name in ("logs", "blocks", "table"):
        resume.add_argument(f"--{name}", required=True)
    resume.add_argument("--format", default="parquet")

    load = jobs.add_parser("load-metadata", help="replace the token metadata table from JSON files")
    load.add_argument("--files", required=True)
    load.add_argument("--metadata", required=True)

    drop = jobs.add_parser("drop-chain", help="remove one chain from the transfers table")
    drop.add_argument("--table", required=True)

    query = jobs.add_parser("query", help="run one analytic and write its result")
    query.add_argument("name", choices=sorted(ANALYTICS))
    query.add_argument("--table", required=True)
    query.add_argument("--metadata", required=True)
    query.add_argument("--output", required=True, help="folder for the result, as parquet")
    query.add_argument("--parameters", type=json.loads, default={}, help='JSON, such as {"limit": 10}')

    for job in (ingest, resume, drop, query):
        job.add_argument("--chain", type=int, choices=sorted(CHAINS), default=DEFAULT_CHAIN, required=job is drop)
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = build_session(f"transferlens-{args.job}")
    if args.job == "ingest":
        run = ingest_stream(
            spark,
            args.logs,
            args.blocks,
            args.table,
            args.checkpoint,
            chain_id=args.chain,
            fmt=args.format,
            max_files=args.max_files,
            rejects_path=args.rejects,
        )
        run.awaitTermination()
        print(f"{sum(p['numInputRows'] for p in run.recentProgress)} logs read")
        totals = ingest_totals(spark, args.checkpoint)
        totals.withColumn("total_value", amounts_of(totals, "total_value").to_text(F.col("total_value"))).show(truncate=False)
    elif args.job == "resume":
        logs = raw_logs.read_raw_logs(spark, args.logs, args.format)
        decoded = raw_logs.decode_transfers(logs, raw_logs.read_blocks(spark, args.blocks, args.format), args.chain)
        print(f"resumed at block {transfers.replace_last_block(spark, args.table, decoded, args.chain)}")
    elif args.job == "load-metadata":
        metadata.write_metadata(metadata.load_metadata(spark, args.files), args.metadata)
        metadata.metadata_summary(metadata.read_metadata(spark, args.metadata)).show(len(CHAINS))
    elif args.job == "drop-chain":
        print(f"{transfers.drop_chain(spark, args.table, args.chain)} transfers removed")
    else:
        t = transfers.read_transfers(spark, args.table, args.chain)
        m = metadata.read_metadata(spark, args.metadata, args.chain)
        run_analytic(args.name, t, m, **args.parameters).write.mode("overwrite").parquet(args.output)


if __name__ == "__main__":
    main()
