"""``spark-submit``-able job: ``python -m coinwharf CONFIG LAKE [--landing DIR] [--stream CHECKPOINT [--messages FOLDER]]``."""

from __future__ import annotations

import argparse
import datetime as dt

from coinwharf.plans.chain import Run, run_batch
from coinwharf.plans.lake import Lake
from coinwharf.session import build_session
from coinwharf.sources.settings import job_settings
from coinwharf.streaming.arrivals import file_arrivals, message_arrivals, start_chain
from coinwharf.streaming.messages import acknowledged_arrivals


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="coinwharf", description=__doc__)
    parser.add_argument("config", help="job configuration document")
    parser.add_argument("lake", help="root folder of the raw, curated, reporting and audit tables")
    parser.add_argument("--landing", help="folder of landed files; default: as configured")
    parser.add_argument("--scheme", default="gs", help="scheme of the configured bucket")
    parser.add_argument("--stream", metavar="CHECKPOINT", help="take only files that arrived since the last run")
    parser.add_argument("--follow", action="store_true", help="with --stream: go on waiting for files")
    parser.add_argument("--as-of", type=dt.date.fromisoformat, help="reference day; default: today (UTC)")
    parser.add_argument("--headers", choices=("by_name", "strict"), default="by_name")
    parser.add_argument("--infer", action="store_true", help="find types that leave every value as it is")
    parser.add_argument("--messages", metavar="FOLDER", help="with --stream: take the files that messages in this folder name")
    parser.add_argument("--acks", metavar="FOLDER", help="with --messages and --follow: take them in bounded batches, acknowledged in this folder")
    parser.add_argument("--normalize-phone", action="store_true")
    parser.add_argument("--null-keys", action="store_true")
    parser.add_argument("--strict", action="store_true")
    parser.add_argument("--split-hot", action="store_true", help="deal accounts that are hot on both sides of a join over many tasks")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = build_session()
    settings = job_settings(spark, args.config, args.scheme)
    landing = args.landing or settings.landing
    if not landing:
        raise SystemExit("no landing folder: give --landing or configure storage.raw_bucket")
    lake = Lake(spark, args.lake.rstrip("/"), settings.partition_raw_by_day)
    options = {
        "headers": args.headers,
        "infer": args.infer,
        "normalize_phone": args.normalize_phone,
        "null_keys": args.null_keys,
        "strict": args.strict,
        "split_hot": args.split_hot,
    }
    if args.stream:
        if args.acks and not (args.messages and args.follow):
            raise SystemExit("--acks needs --messages and --follow")
        if args.acks:
            arrivals = acknowledged_arrivals(spark, args.messages, args.acks, args.scheme)
        elif args.messages:
            arrivals = message_arrivals(spark, args.messages, args.scheme)
        else:
            arrivals = file_arrivals(spark, landing)
        start_chain(
            arrivals, lake, args.stream, args.config, as_of=args.as_of, available_now=not args.follow, **options
        ).awaitTermination()
    else:
        run_batch(lake, landing, Run.of(as_of=args.as_of, **options), args.config)


if __name__ == "__main__":
    main()
