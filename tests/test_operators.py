import json
from datetime import datetime, timedelta
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from session_data import CHANNELS, CLOCK, PRODUCTS, SESSION, raw_trade
from tapeworks import schemas
from tapeworks.functions.numeric import div9, mul9, whole
from tapeworks.functions.timing import bucket, iso_millis, lag_ms
from tapeworks.operators import backfill, bars, book, checks, continuity, monitor, quality, recon, staging, volatility
from tapeworks.plans import marts
from tapeworks.streaming.core import MessageHandler, RecordingPublisher

NOON = CLOCK.replace(tzinfo=None)


def raw(spark, rows):
    return spark.createDataFrame(rows, schemas.RAW["trades"])


def test_fixed_point(spark):
    row = spark.sql("select cast('77630.85' as decimal(38,9)) a, cast('0.00000007' as decimal(38,9)) b, cast(1 as decimal(38,9)) c, cast(3 as decimal(38,9)) d, cast(0 as decimal(38,9)) z, cast('1234567890.5' as decimal(38,9)) big")
    got = row.select(mul9(F.col("a"), F.col("b")), div9(F.col("c"), F.col("d")), div9(F.col("c"), F.col("z")), mul9(F.col("big"), F.col("d")), whole(F.lit(2.5)), whole(F.lit(-2.5))).first()
    assert got[:4] == (D("0.005434160"), D("0.333333333"), None, D("3703703671.500000000")) and got[4:] == (3, -3)


def test_times(spark):
    df = spark.sql("select timestamp'2026-05-04 09:37:59.9996' a, timestamp'2026-05-04 09:37:59.9988' b")
    assert df.select(lag_ms(F.col("a"), F.col("b")), iso_millis(F.col("a")), bucket(F.col("a"), 300)).first() == (0, "2026-05-04T09:37:59.999Z", datetime(2026, 5, 4, 9, 35))


def test_staging_dedupes_and_filters(spark):
    rows = [
        raw_trade(1, 0, lag_ms=90, message_id="late"), raw_trade(1, 0, lag_ms=30, message_id="b"), raw_trade(1, 0, lag_ms=30, message_id="a", price="11"),
        raw_trade(1, 0, product="ETH-USD"), raw_trade(2, 1, product="DOGE-USD"), raw_trade(999999, 2), raw_trade(3, 3, sequence=0, lag_ms=-5, side="sell"),
    ]
    got = {(r.product_id, r.trade_id): r for r in staging.with_taker_side(staging.stage_trades(raw(spark, rows))).collect()}
    assert set(got) == {("BTC-USD", 1), ("ETH-USD", 1), ("BTC-USD", 3)}
    assert got["BTC-USD", 1].price == 11 and got["BTC-USD", 1].maker_order_id is None and got["BTC-USD", 1].taker_side == "sell"
    back = got["BTC-USD", 3]
    assert back.is_backfilled and back.ingest_lag_ms == -5 and back.taker_side == "buy" and back.notional == 10
    with pytest.raises(Exception, match="(?i)cast"):
        staging.stage_trades(raw(spark, [raw_trade(1, 0, price="x")])).collect()


def trades(spark, rows):
    return staging.with_taker_side(staging.stage_trades(raw(spark, rows)))


def test_bars_and_rollup(spark):
    t = trades(spark, [raw_trade(3, 2, price="12", size="2", side="sell"), raw_trade(1, 2, price="10"), raw_trade(2, 2, price="9", size="3"), raw_trade(4, 70, price="20", size="0.5", lag_ms=41)])
    minute = bars.bars(t, 60)
    a, b = minute.orderBy("bar_start").collect()
    assert (a.open, a.high, a.low, a.close, a.volume, a.trade_count) == (10, 12, 9, 12, 6, 3)
    assert a.vwap == D("10.166666667") and (a.buy_volume, a.sell_volume) == (2, 4) and a.volume_imbalance == D("-0.333333333")
    assert a.bar_end - a.bar_start == timedelta(minutes=1) and b.avg_ingest_lag_ms == 41
    (w,) = bars.roll_up(minute, 300).collect()
    assert (w.open, w.close, w.high, w.low, w.volume, w.trade_count, w.source_bar_count) == (10, 20, 20, 9, D("6.5"), 4, 2) and w.vwap == D("10.923076923")
    for name in ("no_duplicate_trades", "bar_ohlc_coherence", "bar_volume_reconciles", "taker_side_is_inverse", "unique_bars", "price_in_range", "accepted_sides"):
        assert marts.check_all(marts.build(raw(spark, [raw_trade(1, 2), raw_trade(2, 3)])), NOON)[name].count() == 0


def l2(spark, rows):
    fields = [{"sequence": 1, "product_id": "BTC-USD", "event_type": kind, "payload": json.dumps(p), "event_time": f"{NOON + timedelta(seconds=e)}", "ingest_time": f"{NOON + timedelta(seconds=i)}", "message_id": f"m{n}"} for n, (kind, e, i, p) in enumerate(rows)]
    return spark.createDataFrame(fields, schemas.RAW["l2"])


def test_book_state_and_liquidity(spark):
    rows = [
        ("l2update", -1, -1, {"changes": [["buy", "100", "7"]]}),
        ("snapshot", 0, 0, {"bids": [["100", "1"], ["99.5", "2"], ["50", "9"]], "asks": [["101", "1.5"], ["101.2", 0.5]]}),
        ("l2update", 10, 10, {"changes": [["buy", "100.2", "3"], ["buy", "100.2", "0"], ["buy", "100.2", "4"]]}),
        ("l2update", 130, 130, {"changes": [["buy", "100.2", "0"]]}),
        ("l2update", 200, 200, {"changes": [["sell", "101", "6"]]}),
        ("snapshot", 250, 250, {"bids": [["200", "1"]], "asks": [["201", "1"]]}),
    ]
    events = staging.flatten_l2(l2(spark, rows))
    assert events.where("is_removal").count() == 2 and events.where("event_type = 'l2update'").agg(F.max("change_index")).first()[0] == 2
    state = book.book_state(events)
    got = {(r.event_minute, r.side, r.price): r.size for r in state.collect()}
    minute = lambda n: NOON + timedelta(minutes=n)
    assert got[minute(0), "buy", D("100.2")] == 4 and got[minute(0), "buy", D("100")] == 1 and (minute(0), "buy", D("50")) not in got
    assert (minute(2), "buy", D("100.2")) not in got and got[minute(2), "buy", D("100")] == 1 and got[minute(3), "sell", D("101")] == 6
    assert {k for k in got if k[0] == minute(4)} == {(minute(4), "buy", D("200")), (minute(4), "sell", D("201"))}
    assert {r.event_minute for r in book.book_state(events, latest_only=True).collect()} == {minute(4)}
    rows = {r.bar_start: r for r in book.liquidity(state).collect()}
    top = rows[minute(0)]
    assert (top.best_bid, top.best_ask, top.mid, top.spread) == (D("100.2"), D("101"), D("100.6"), D("0.8")) and top.spread_bps == D("79.522860000")
    assert top.bid_depth_25bps == 0 and top.book_levels == 5
    assert book.crossed(book.liquidity(state)).count() == 0


def test_volatility_needs_the_bar_before(spark):
    t = trades(spark, [raw_trade(i, 60 * i, price=str(10 + (i * 7) % 5)) for i in range(200)])
    minute = bars.bars(t, 60)
    full = {r.window_start: r for r in volatility.realized_vol(minute).collect()}
    assert all(r.vol_parkinson == 0 for r in full.values()) and all(r.bar_count > 1 for r in full.values())
    single = volatility.realized_vol(bars.bars(trades(spark, [raw_trade(1, 0)]), 60)).first()
    assert single.vol_close_to_close is None and single.vol_garman_klass == 0


def test_quality(spark):
    rows = [raw_trade(i, i) for i in (1, 2, 5)] + [raw_trade(2, 2, lag_ms=900), raw_trade(6, 6, sequence=0, lag_ms=10**7), raw_trade(7, 7, lag_ms=-8000), raw_trade(50, 7300, sequence=0)]
    q = {r.event_hour.hour: r for r in quality.data_quality(trades(spark, rows), staging.type_trades(raw(spark, rows))).collect()}
    a, b = q[9], q[11]
    assert (a.trades_received, a.trades_expected, a.trades_missing, a.duplicates_removed, a.backfilled_trades, a.negative_lag_rows) == (5, 7, 2, 1, 1, 1)
    assert a.completeness_pct == 71.4286 and not a.meets_completeness_sla and a.p99_ingest_lag_ms == 8000 and not a.meets_latency_sla
    assert b.p99_ingest_lag_ms is None and b.meets_latency_sla is None
    assert [(r.trade_id, r.missing) for r in quality.gaps(trades(spark, rows)).orderBy("trade_id").collect()] == [(2, 2), (7, 42)]
    assert [r.event_hour.hour for r in quality.silent_hours(quality.data_quality(trades(spark, rows), staging.type_trades(raw(spark, rows)))).collect()] == [10]
    feed = raw(spark, [raw_trade(1, 0)])
    assert quality.should_run(feed, NOON + timedelta(minutes=3))[0] and not quality.should_run(feed, NOON + timedelta(minutes=9))[0] and not quality.should_run(feed, NOON + timedelta(days=3))[0]
    assert quality.freshness(feed, NOON + timedelta(minutes=30)).first().status == "warn"


def test_checks_find_offenders(spark):
    t = trades(spark, [raw_trade(i, i - 86400) for i in (1, 2, 9)] + [raw_trade(10, 0)])
    assert checks.broken_contiguity(t, NOON).first().missing_share == D("0.666666667")
    assert {r.product_id for r in checks.missing_products(spark, t, NOON).collect()} == {"ETH-USD", "SOL-USD"}
    assert checks.slow_ingest(trades(spark, [raw_trade(1, 0, lag_ms=6000)]), NOON).count() == 1
    assert checks.incoherent_bars(spark.sql("select 5 low, 4 open, 6 close, 7 high")).count() == 1
    assert checks.orphans(t, spark.sql("select 'ETH-USD' product_id"), "product_id").count() == 4
    assert checks.nulls(t, ["maker_order_id"]).count() == 4 and checks.violates(t, "price > 10").count() == 4
    assert checks.unreconciled_volume(bars.bars(t.where("trade_id < 10"), 60), t).count() == 1


def pane(minute, n, index=0, volume="1", close="10", product="BTC-USD"):
    start = NOON + timedelta(minutes=minute)
    return (product, start, start, D(10), D(10), D(10), D(close), D(volume), n, D(10), 1, n, index, True, start + timedelta(seconds=index))


def test_reconciliation_outcomes(spark):
    panes = spark.createDataFrame([pane(1, 1), pane(2, 9, 0), pane(2, 2, 1), pane(3, 1), pane(4, 5), pane(5, 1), pane(6, 3), pane(7, 4), pane(8, 1), pane(9, 7, product="ETH-USD"), pane(1, 1, product="SOL-USD"), pane(2, 1, product="SOL-USD"), pane(3, 1, product="SOL-USD")], schemas.BARS_STREAM)
    batch = spark.createDataFrame([pane(0, 2), pane(1, 3), pane(2, 2), pane(3, 4), pane(4, 2), pane(6, 3, volume="2"), pane(7, 2), pane(2, 5, product="SOL-USD"), pane(3, 3, product="SOL-USD"), pane(1, 1, product="SOL-USD")], schemas.BARS_STREAM)
    got = {(r.product_id, int((r.bar_start - NOON).total_seconds() // 60)): r for r in recon.reconcile(panes, batch).collect()}
    reason = {k: r.divergence_reason.partition(":")[0] for k, r in got.items()}
    b = lambda m: reason["BTC-USD", m]
    assert (b(0), b(1), b(2), b(3), b(4), b(5), b(6), b(7), b(8)) == (
        "outside_run_window", "partial_window_at_startup", "agree", "late_data_dropped", "over_count", "missing_from_batch", "agree", "batch_not_yet_built", "batch_not_yet_built",
    )
    assert reason["SOL-USD", 3] == "partial_window_at_shutdown" and reason["SOL-USD", 2] == "late_data_dropped" and reason["ETH-USD", 9] == "missing_from_batch"
    two = got["BTC-USD", 2]
    assert two.was_restated and two.pane_count == 2 and two.bars_agree and two.counts_agree
    assert got["BTC-USD", 6].counts_agree and not got["BTC-USD", 6].bars_agree and got["BTC-USD", 0].counts_agree is None and got["BTC-USD", 0].bars_agree is False


def messages(spark):
    rows = [json.dumps(m) for m in SESSION]
    df = spark.createDataFrame(list(enumerate(rows)), "line_no int, line string")
    return df.select("line_no", F.from_json("line", schemas.SESSION).alias("m")).select("line_no", "m.*")


def test_continuity_windows_equal_the_handler(spark):
    handler = MessageHandler(PRODUCTS, RecordingPublisher())
    for m in SESSION:
        handler.handle(m, CLOCK)
    found = continuity.counters(continuity.classify(continuity.with_epochs(messages(spark)))).collect()
    names = ["sequence_gaps_total", "messages_lost_total", "duplicates_total", "heartbeat_detected_gaps_total"]
    assert {name: sum(r[name] for r in found) for name in names} == {name: handler.counters.totals[name] for name in names}
    sent = continuity.envelopes(messages(spark).withColumn("received_at", F.lit(NOON)))
    assert {k: v.count() for k, v in sent.items()} == CHANNELS
    by_handler = sorted((m["trade_id"], m["event_time"]) for m in handler.publisher.for_channel("trades"))
    assert sorted((r.trade_id, r.event_time) for r in sent["trades"].collect()) == by_handler


def test_monitoring(spark):
    points = spark.createDataFrame([(NOON + timedelta(seconds=s), c) for s, c in [(0, "a"), (1, "a"), (700, "a"), (650, "b")]], "ts timestamp, channel string")
    grid = monitor.on_grid(points, 300, "channel")
    assert {(r.label, int((r.bucket - NOON).total_seconds())): r.total for r in grid.collect()} == {("a", 0): 2, ("a", 300): 0, ("a", 600): 1, ("b", 0): 0, ("b", 300): 0, ("b", 600): 1}
    assert monitor.alerts(grid, below=1).where("fires").count() == 3 and monitor.alerts(grid, above=1).where("fires").count() == 1
    assert [r.messages_received for r in monitor.channel_counts(points).orderBy("channel").collect()] == [3, 1]
    beats = points.select(F.lit("P").alias("product_id"), F.col("ts").alias("ingest_time"))
    assert sorted(r.seconds for r in monitor.stalls(beats).collect()) == [50.0, 649.0]
    lags = spark.range(100).select(F.col("id").alias("ingest_lag_ms"))
    assert monitor.lag_percentiles(lags).first() == (50, 95, 99)
    assert monitor.rate_per_minute(grid, 300).where("all_labels = 0.4").count() == 2
    logs = spark.createDataFrame([("book", "crossed"), ("book", "other")], "logger string, message string")
    assert monitor.log_counters(logs, {"crossed": ("book", "crossed")}).first()[0] == 1


def test_backfill(spark):
    t = trades(spark, [raw_trade(i, i) for i in (5, 6, 9)])
    assert sorted(r.trade_id for r in backfill.missing_ids(spark, t, 4, 12).collect()) == [7, 8, 10, 11]
    assert sorted(r.trade_id for r in backfill.missing_within(t).collect()) == [7, 8]
    pages = spark.createDataFrame([(8, "1", "1", "buy", "2026-05-04T09:30:08.1Z"), (7, "1", "1", "sell", "2026-05-04T09:30:07Z"), (99, "1", "1", "buy", "x")], "trade_id bigint, price string, size string, side string, time string")
    fixed = backfill.repair_rows(pages, backfill.missing_within(t), "BTC-USD", NOON).collect()
    assert [r.trade_id for r in fixed] == [7, 8] and all(r.sequence == 0 and r.maker_order_id == "" for r in fixed)
