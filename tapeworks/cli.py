"""Command lines: ``python -m tapeworks.cli bars`` (streaming bars) and ``backfill`` (repair of lost trades)."""

from __future__ import annotations

import argparse
import logging
import signal
from collections.abc import Callable
from datetime import UTC, datetime
from functools import partial

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from tapeworks import config
from tapeworks.operators import backfill
from tapeworks.session import get_session
from tapeworks.sources import raw, sinks
from tapeworks.streaming import core, jobs


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tapeworks", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)
    bars = commands.add_parser("bars", help="bars of a stream of trades, every pane appended")
    bars.add_argument("--input", required=True, help="folder that JSON messages come to")
    bars.add_argument("--output", required=True)
    bars.add_argument("--checkpoint", required=True)
    bars.add_argument("--window-seconds", type=int, default=config.WINDOW_SECONDS)
    bars.add_argument("--allowed-lateness-seconds", type=int, default=config.LATENESS_SECONDS)
    bars.add_argument("--guarded", action="store_true", help="staging's guards: followed products, no test trades, no copies")
    bars.add_argument("--drain", action="store_true", help="process what is there and stop")
    fill = commands.add_parser("backfill", help="fetch the trades that a raw table lacks and append them")
    fill.add_argument("--endpoint", required=True)
    fill.add_argument("--product", required=True)
    fill.add_argument("--table", required=True, help="raw trades")
    fill.add_argument("--after", type=int, help="ids above this; with --before, else every hole of the table")
    fill.add_argument("--before", type=int)
    fill.add_argument("--parts", type=int, default=1)
    fill.add_argument("--dry-run", action="store_true", help="count what is missing and stop")
    return top


def run_bars(spark: SparkSession, args: argparse.Namespace) -> None:
    trades = jobs.parse_trades(raw.stream_messages(spark, args.input))
    if args.guarded:
        trades = jobs.guarded(trades, f"{args.window_seconds + args.allowed_lateness_seconds} seconds")
    writer = jobs.append_panes(jobs.pane_bars(trades, args.window_seconds, args.allowed_lateness_seconds), args.output, args.checkpoint)
    if args.drain:
        jobs.drain(writer)
        return
    query = writer.start()
    # the batch in hand is finished; the next start goes on from the checkpoint
    for name in (signal.SIGTERM, signal.SIGINT):
        signal.signal(name, lambda *_: query.stop())
    query.awaitTermination()


def run_backfill(spark: SparkSession, args: argparse.Namespace, fetch: Callable[[int], list[dict]] | None = None, now: datetime | None = None) -> int:
    """Append the missing trades that the endpoint has; returns how many were missing (dry run) or appended."""
    now = now or datetime.now(UTC)
    held = raw.scan_raw(spark, args.table, "trades", now, days=None).where(f"product_id = '{args.product}'")
    wanted = backfill.missing_within(held) if args.after is None else backfill.missing_ids(spark, held, args.after, args.before)
    ends = wanted.selectExpr("count(*) as n", "min(trade_id) as a", "max(trade_id) as b").first()
    if args.dry_run or not ends.n:
        return ends.n
    spark.dataSource.register(raw.paged_trades(fetch or partial(raw.fetch_page, args.endpoint, args.product)))
    pages = spark.read.format("paged_trades").options(after=ends.a - 1, before=ends.b + 1, parts=args.parts).load()
    found = Observation("backfill")
    rows = backfill.repair_rows(pages, wanted, args.product, now).observe(found, F.count(F.lit(1)).alias("n"))
    sinks.append_strict(rows, args.table, "trades")
    return found.get["n"]


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    handler = logging.StreamHandler()
    handler.setFormatter(core.JsonLog())
    logging.basicConfig(level=logging.INFO, handlers=[handler])
    spark = get_session()
    if args.command == "bars":
        run_bars(spark, args)
    else:
        core.LOG.info("backfill", extra={"fields": {"product_id": args.product, "trades": run_backfill(spark, args)}})
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
