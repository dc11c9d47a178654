"""Queries of staging, marts, checks and monitoring, each with rows to find, and their SQL twins."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks import config
from tapeworks.functions.timing import iso_millis
from tapeworks.operators import backfill, bars, book, checks, monitor, quality, staging
from tapeworks.plans.registry import _BARS_SQL, _L2_SQL, _LEVELS_SQL, _carried, _hourly, _l2_raw, plain, query
from tapeworks.plans.tape import TAPE_SQL, events, load, tape

#: Products that the made-up raw messages follow; events of the fifth type are another product's.
FOLLOWED = ("click", "purchase", "signup", "view")
#: Synthetic ids of that feed: every 500th message, from the second on, bears one. It is itself the id
#: of such a message, so that no other event can have it; the model's own ids are real ones in long tables.
TEST_TRADE_IDS = (1,)
_FOLLOWED_SQL = ", ".join(f"'{p}'" for p in FOLLOWED)


def _trades_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trade messages made of events: texts throughout, blank order ids, later copies of every
    seventh with another price, ids of test trades, and a product that nobody follows."""
    e = events(spark, sf_dir).withColumn("cents", F.round(F.col("value") * 100).cast("bigint") + 100)
    text = lambda c: F.format_string("%d.%02d", (c / 100).cast("bigint"), c % 100)
    moment = lambda ts: F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    first = e.select(
        F.when(F.col("k") % 20 == 0, F.lit(0)).otherwise(F.col("event_id") + 1).cast("bigint").alias("sequence"),
        F.col("event_type").alias("product_id"),
        F.when(F.col("event_id") % 500 == 1, F.lit(TEST_TRADE_IDS[0])).otherwise(F.col("event_id")).cast("bigint").alias("trade_id"),
        text(F.col("cents")).alias("price"),
        text(F.col("k") + 1).alias("size"),
        F.when(F.col("user_id") % 2 == 0, "buy").otherwise("sell").alias("side"),
        F.when(F.col("k") % 3 == 0, "").otherwise(F.concat(F.lit("m"), F.col("event_id").cast("string"))).alias("maker_order_id"),
        F.lit("").alias("taker_order_id"),
        moment(F.col("ts")).alias("event_time"),
        moment(F.timestamp_add("MILLISECOND", F.col("k") - 10, F.col("ts"))).alias("ingest_time"),
        F.concat(F.lit("a"), F.col("event_id").cast("string")).alias("message_id"),
        "k",
    )
    again = first.where("k % 7 = 0").withColumns({"price": F.lit("1.00"), "ingest_time": moment(F.timestamp_add("SECOND", F.lit(5), F.col("ingest_time").cast("timestamp"))), "message_id": F.concat(F.lit("b"), F.col("message_id"))})
    return first.unionByName(again).drop("k")


@query(f"""WITH {TAPE_SQL}
SELECT trade_id, product_id, sequence, (cents / 100.0)::DOUBLE AS price, (lots / 100.0)::DOUBLE AS size, round(cents * lots / 10000.0, 6)::DOUBLE AS notional, side, taker_side, CASE WHEN k % 3 <> 0 THEN 'm' || trade_id END AS maker_order_id,
  CAST(NULL AS VARCHAR) AS taker_order_id, is_backfilled, lag_ms AS ingest_lag_ms, epoch(date_trunc('minute', ts))::BIGINT AS event_minute, strftime(ts, '%Y-%m-%d') AS event_date
FROM tape WHERE product_id IN ({_FOLLOWED_SQL}) AND trade_id % 500 <> 1""")
def stage_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw messages to the trades fact: typed, filtered, the earliest arrival of each id."""
    found = staging.with_taker_side(staging.stage_trades(_trades_raw(spark, sf_dir), FOLLOWED, TEST_TRADE_IDS))
    return plain(found, *"trade_id product_id sequence price size notional side taker_side maker_order_id taker_order_id is_backfilled ingest_lag_ms event_minute event_date".split())


@query(f"""WITH {TAPE_SQL} SELECT product_id, count(*) AS typed_rows, count(*) - count(DISTINCT trade_id) AS copies, count(*) FILTER (WHERE k % 3 = 0) AS without_maker
FROM (SELECT product_id, trade_id, k FROM tape UNION ALL SELECT product_id, trade_id, k FROM tape WHERE k % 7 = 0) WHERE product_id IN ({_FOLLOWED_SQL}) AND trade_id % 500 <> 1 GROUP BY 1""")
def type_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed trades before deduplication, as the quality mart counts them."""
    typed = staging.type_trades(_trades_raw(spark, sf_dir), FOLLOWED, TEST_TRADE_IDS)
    return typed.groupBy("product_id").agg(F.count(F.lit(1)).alias("typed_rows"), (F.count(F.lit(1)) - F.count_distinct("trade_id")).alias("copies"), F.count_if(F.col("maker_order_id").isNull()).alias("without_maker"))


@query(f"""WITH {TAPE_SQL}, h AS (SELECT product_id, cast(floor(epoch(ts) / 3600) * 3600 AS BIGINT) AS event_hour, count(*) AS n, min(trade_id) AS a, max(trade_id) AS b, count(*) FILTER (WHERE k % 7 = 0) AS copies, count(*) FILTER (WHERE is_backfilled) AS bf
  FROM tape WHERE product_id IN ({_FOLLOWED_SQL}) AND trade_id % 500 <> 1 GROUP BY 1, 2)
SELECT product_id, event_hour, n AS trades_received, b - a + 1 AS trades_expected, b - a + 1 - n AS trades_missing, copies AS duplicates_removed, bf AS backfilled_trades FROM h""")
def data_quality_of_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of staged trades, with the copies that staging dropped counted before it did."""
    raw = _trades_raw(spark, sf_dir)
    found = quality.data_quality(staging.stage_trades(raw, FOLLOWED, TEST_TRADE_IDS), staging.type_trades(raw, FOLLOWED, TEST_TRADE_IDS))
    return plain(found, *"product_id event_hour trades_received trades_expected trades_missing duplicates_removed backfilled_trades".split())


@query(f"""WITH {TAPE_SQL} SELECT product_id, sequence, trade_id + 3 AS last_trade_id, lag_ms AS ingest_lag_ms, epoch(date_trunc('minute', ts))::BIGINT AS event_minute, strftime(ts, '%Y-%m-%d') AS event_date
FROM tape WHERE product_id IN ({_FOLLOWED_SQL})""")
def type_heartbeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir)
    raw = e.select(
        F.when(F.col("k") % 20 == 0, F.lit(0)).otherwise(F.col("event_id") + 1).cast("bigint").alias("sequence"), F.col("event_type").alias("product_id"), (F.col("event_id") + 3).alias("last_trade_id"),
        F.col("ts").cast("string").alias("event_time"), F.timestamp_add("MILLISECOND", F.col("k") - 10, F.col("ts")).cast("string").alias("ingest_time"),
    )
    return plain(staging.type_heartbeats(raw, FOLLOWED), *"product_id sequence last_trade_id ingest_lag_ms event_minute event_date".split())


def _bars_sql(seconds: int) -> str:
    return f"""WITH {TAPE_SQL} SELECT product_id, cast(floor(epoch(ts) / {seconds}) * {seconds} AS BIGINT) AS bar_start, (arg_min(cents, trade_id) / 100.0)::DOUBLE AS open, (max(cents) / 100.0)::DOUBLE AS high,
  (min(cents) / 100.0)::DOUBLE AS low, (arg_max(cents, trade_id) / 100.0)::DOUBLE AS close, (sum(lots) / 100.0)::DOUBLE AS volume, count(*) AS trade_count, round(sum(cents * lots)::DOUBLE / sum(lots) / 100, 6) AS vwap FROM tape GROUP BY 1, 2"""


@query(_bars_sql(60))
def bars_one_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(bars.bars(tape(spark, sf_dir), 60), *"product_id bar_start open high low close volume trade_count vwap".split())


@query(f"""WITH {TAPE_SQL}, m AS (SELECT product_id, cast(floor(epoch(ts) / 60) * 60 AS BIGINT) AS bar_start, arg_min(cents, trade_id) AS o, max(cents) AS h, min(cents) AS l, arg_max(cents, trade_id) AS c, sum(lots) AS lots, sum(cents * lots) AS quote, count(*) AS n FROM tape GROUP BY 1, 2)
SELECT product_id, cast(floor(bar_start / 300) * 300 AS BIGINT) AS bar_start, (arg_min(o, bar_start) / 100.0)::DOUBLE AS open, (max(h) / 100.0)::DOUBLE AS high, (min(l) / 100.0)::DOUBLE AS low, (arg_max(c, bar_start) / 100.0)::DOUBLE AS close,
  (sum(lots) / 100.0)::DOUBLE AS volume, cast(sum(n) AS BIGINT) AS trade_count, round(sum(quote)::DOUBLE / sum(lots) / 100, 6) AS vwap, count(*) AS source_bar_count FROM m GROUP BY 1, 2""")
def bars_five_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(bars.roll_up(bars.bars(tape(spark, sf_dir), 60), 300), *"product_id bar_start open high low close volume trade_count vwap source_bar_count".split())


@query(f"""WITH {_L2_SQL}, last AS (SELECT product_id, max(ts) AS snap FROM l2 WHERE event_type = 'snapshot' GROUP BY 1), snaps AS (SELECT l2.product_id, l2.ts AS snap, cents + 25 AS mid FROM l2 JOIN last ON l2.product_id = last.product_id AND l2.ts = last.snap WHERE event_type = 'snapshot'),
r AS (SELECT l.*, s.snap FROM levels l JOIN snaps s ON l.product_id = s.product_id AND l.ts >= s.snap WHERE abs(l.cents - s.mid) <= s.mid * 0.01),
st AS (SELECT product_id, side, cents, date_trunc('minute', ts) AS minute, arg_max(size, (event_type <> 'snapshot', ts, change_index)) AS size FROM r GROUP BY ALL), g AS (SELECT DISTINCT product_id, minute FROM st),
c AS (SELECT g.product_id, g.minute, s.side, s.cents, s.size FROM g JOIN st s ON g.product_id = s.product_id AND s.minute <= g.minute QUALIFY row_number() OVER (PARTITION BY g.product_id, g.minute, s.side, s.cents ORDER BY s.minute DESC) = 1)
SELECT product_id, epoch(minute)::BIGINT AS event_minute, side, (cents / 100.0)::DOUBLE AS price, size::DOUBLE AS size FROM c WHERE size > 0""")
def book_state_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the epoch of each product's last snapshot."""
    return plain(book.book_state(staging.flatten_l2(_l2_raw(spark, sf_dir), None), latest_only=True), "product_id", "event_minute", "side", "price", "size")


@query(f"""WITH {_LEVELS_SQL}, top AS (SELECT product_id, event_minute, max(CASE WHEN side = 'buy' THEN level + 1 END) AS bid, min(CASE WHEN side = 'sell' THEN level + 1 END) AS ask FROM carried WHERE size > 0 GROUP BY 1, 2)
SELECT product_id, epoch(event_minute)::BIGINT AS bar_start, bid::DOUBLE AS best_bid, ask::DOUBLE AS best_ask FROM top WHERE bid >= ask""")
def crossed_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = _carried(spark, sf_dir).select("product_id", "event_minute", "side", (F.col("level") + 1).cast("decimal(38,9)").alias("price"), F.col("size").cast("decimal(38,9)").alias("size"), F.to_date("event_minute").alias("event_date"))
    return plain(book.crossed(book.liquidity(state)), "product_id", "bar_start", "best_bid", "best_ask")


@query(f"""WITH {TAPE_SQL}, e AS (SELECT max(ts) AS as_of FROM tape) SELECT p.product_id FROM (VALUES ('click'), ('error'), ('purchase'), ('refund'), ('signup'), ('transfer'), ('view')) p(product_id)
WHERE NOT EXISTS (SELECT 1 FROM tape t, e WHERE t.product_id = p.product_id AND t.ts >= e.as_of - INTERVAL 1 DAY AND NOT (t.product_id = 'click' AND t.ts >= e.as_of - INTERVAL 2 DAY))""")
def missing_products_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products without a trade in the last day: two that never trade, and one that stopped."""
    t = tape(spark, sf_dir)
    as_of = t.agg(F.max("event_time")).first()[0]
    stopped = t.where((F.col("product_id") != "click") | (F.col("event_time") < F.lit(as_of - timedelta(days=2)).cast("timestamp")))
    return checks.missing_products(spark, stopped, as_of, ("click", "error", "purchase", "refund", "signup", "transfer", "view"))


@query("SELECT DISTINCT l_orderkey FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderpriority <> '1-URGENT')")
def relationship_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items whose order is not among those of lower priority."""
    known = load(spark, sf_dir, "orders").where("o_orderpriority <> '1-URGENT'").select(F.col("o_orderkey").alias("l_orderkey"))
    return checks.orphans(load(spark, sf_dir, "lineitem").select("l_orderkey").distinct(), known, "l_orderkey")


_SOURCES = {"trades": "view", "l2": "click", "heartbeat": "error"}
_FRESH_SQL = " UNION ALL ".join(f"SELECT '{name}' AS source, '{kind}' AS kind, {config.SOURCE_FRESHNESS[name][0]} AS warn, {config.SOURCE_FRESHNESS[name][1]} AS error" for name, kind in _SOURCES.items())


@query(f"""WITH s AS ({_FRESH_SQL} UNION ALL SELECT 'silent', 'nothing', 5, 60), n AS (SELECT epoch_us(max(ts)) + 150000000 AS as_of FROM events),
l AS (SELECT s.*, (SELECT max(epoch_us(ts)) FROM events e, n WHERE e.event_type = s.kind AND epoch_us(ts) >= n.as_of - 86400000000) AS last_arrival, n.as_of FROM s, n)
SELECT source, last_arrival, cast((as_of - last_arrival) // 60000000 AS BIGINT) AS staleness_minutes,
  CASE WHEN last_arrival IS NULL THEN 'empty' WHEN (as_of - last_arrival) // 60000000 > error THEN 'error' WHEN (as_of - last_arrival) // 60000000 > warn THEN 'warn' ELSE 'pass' END AS status FROM l""")
def freshness_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every source against its own thresholds, two and a half minutes after the last event of all."""
    rows = events(spark, sf_dir).withColumnRenamed("ts", "publish_time")
    as_of = rows.agg(F.max("publish_time")).first()[0] + timedelta(seconds=150)
    sources = {name: rows.where(F.col("event_type") == kind) for name, kind in _SOURCES.items()} | {"silent": rows.where("event_type = 'nothing'")}
    return quality.freshness_of(sources, as_of).withColumn("last_arrival", F.unix_micros("last_arrival"))


@query(f"""WITH {TAPE_SQL}, {_BARS_SQL}, b AS (SELECT *, CASE WHEN n % 5 = 0 THEN h + 1 ELSE l END AS low FROM bars) SELECT product_id, bar_start, (low / 100.0)::DOUBLE AS low, (h / 100.0)::DOUBLE AS high FROM b WHERE low > o OR low > c OR h < o OR h < c OR low > h""")
def incoherent_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars some of which had their low put above their high."""
    spoilt = _hourly(spark, sf_dir).withColumn("low", F.when(F.col("trade_count") % 5 == 0, (F.col("high") + F.lit("0.01").cast("decimal(38,9)")).cast("decimal(38,9)")).otherwise(F.col("low")))
    return plain(checks.incoherent_bars(spoilt), "product_id", "bar_start", "low", "high")


@query(f"""WITH {TAPE_SQL}, h AS (SELECT product_id, cast(floor(epoch(ts) / 3600) * 3600 AS BIGINT) AS event_hour, count(*) AS n, min(trade_id) AS a, max(trade_id) AS b FROM tape GROUP BY 1, 2), e AS (SELECT cast(floor(epoch(max(ts)) / 3600) * 3600 AS BIGINT) AS hour FROM tape)
SELECT product_id, event_hour, n AS trades_received, b - a + 1 AS trades_expected FROM h, e WHERE event_hour < hour AND n::DOUBLE / (b - a + 1) < 0.9999""")
def sla_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tape(spark, sf_dir)
    as_of = t.agg(F.max("event_time")).first()[0]
    return plain(checks.failed_sla(quality.data_quality(t, t), as_of), "product_id", "event_hour", "trades_received", "trades_expected")


@query(f"""WITH {TAPE_SQL}, e AS (SELECT max(ts) AS as_of FROM tape) SELECT product_id, quantile_disc(abs(lag_ms), 0.99) AS p99_ingest_lag_ms FROM tape, e WHERE ts >= as_of - INTERVAL 1 DAY AND NOT is_backfilled GROUP BY 1 HAVING quantile_disc(abs(lag_ms), 0.99) > 80""")
def slow_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tape(spark, sf_dir)
    return checks.slow_ingest(t, t.agg(F.max("event_time")).first()[0], limit=80)


@query(f"""WITH {TAPE_SQL} SELECT 'accepted_sides' AS check_name, count(*) AS offending FROM tape WHERE side NOT IN ('buy') UNION ALL SELECT 'price_in_range', count(*) FROM tape WHERE cents < 200 OR cents > 10000
UNION ALL SELECT 'maker_known', count(*) FROM tape WHERE k % 3 = 0 AND product_id IN ({_FOLLOWED_SQL}) AND trade_id % 500 <> 1 UNION ALL SELECT 'small_lots', count(*) FROM tape WHERE lots > 50
UNION ALL SELECT 'taker_is_inverse', count(*) FROM tape WHERE k % 11 = 0""")
def column_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows offend each check on columns."""
    t = tape(spark, sf_dir)
    spoilt = t.withColumn("taker_side", F.when((F.col("size") * 100 - 1) % 11 == 0, F.when(F.col("side") == "buy", F.col("side"))).otherwise(F.col("taker_side")))
    staged = staging.stage_trades(_trades_raw(spark, sf_dir), FOLLOWED, TEST_TRADE_IDS)
    found = {
        "accepted_sides": checks.not_accepted(t, "side", ("buy",)),
        "price_in_range": checks.out_of_range(t, "price", "2", "100"),
        "maker_known": checks.nulls(staged, ["maker_order_id", "trade_id"]),
        "small_lots": checks.violates(t, "size <= 0.5"),
        "taker_is_inverse": checks.wrong_taker_side(spoilt),
    }
    counts = [rows.agg(F.lit(name).alias("check_name"), F.count(F.lit(1)).alias("offending")) for name, rows in found.items()]
    out = counts[0]
    for more in counts[1:]:
        out = out.unionByName(more)
    return out


_ALERTS_SQL = " UNION ALL ".join(
    f"""SELECT '{rule}' AS alert, b.bucket, cast(coalesce(total, 0) AS BIGINT) AS total FROM (SELECT unnest(range(a // {s} * {s}, z // {s} * {s} + {s}, {s})) AS bucket FROM span) b
LEFT JOIN (SELECT t // {s} * {s} AS bucket, sum(value) AS total FROM m WHERE name = '{rule}' GROUP BY 1) x ON x.bucket = b.bucket WHERE {f'coalesce(total, 0) > {above}' if above is not None else f'coalesce(total, 0) < {below}'}"""
    for rule, (s, above, below) in monitor.ALERTS.items()
)


def _metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of the alert table's metrics, made of events: each event type is another metric."""
    name = F.when(F.col("event_type") == "click", "no_publishes").when(F.col("event_type") == "error", "crossed_book").when(F.col("event_type") == "view", "sequence_gaps").when(F.col("event_type") == "signup", "reconnects").otherwise("consumer_absent")
    return events(spark, sf_dir).where("event_id < 2000").select("ts", name.alias("name"), (F.col("k") % 5).alias("value"))


@query(f"""WITH m AS (SELECT cast(floor(epoch(ts)) AS BIGINT) AS t, CASE event_type WHEN 'click' THEN 'no_publishes' WHEN 'error' THEN 'crossed_book' WHEN 'view' THEN 'sequence_gaps' WHEN 'signup' THEN 'reconnects' ELSE 'consumer_absent' END AS name,
  cast(json_extract_string(props, '$.k') AS BIGINT) % 5 AS value FROM events WHERE event_id < 2000), span AS (SELECT min(t) AS a, max(t) AS z FROM m) {_ALERTS_SQL}""")
def alert_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rule of the alert table over its own windows, silent ones included."""
    return plain(monitor.evaluate(_metrics(spark, sf_dir)))


@query("SELECT event_type AS channel, count(*) AS messages_received FROM events GROUP BY 1")
def channel_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.channel_counts(events(spark, sf_dir), "event_type").withColumnRenamed("event_type", "channel")


@query("""SELECT count(*) FILTER (WHERE event_type = 'error' AND user_id % 3 = 0) AS crossed, count(*) FILTER (WHERE event_type = 'view' AND user_id % 3 = 1) AS gap FROM events""")
def log_counter_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = events(spark, sf_dir).select(F.col("event_type").alias("logger"), F.concat(F.lit("m"), (F.col("user_id") % 3).cast("string")).alias("message"))
    return monitor.log_counters(logs, {"crossed": ("error", "m0"), "gap": ("view", "m1")})


@query(f"""WITH {TAPE_SQL}, v AS (SELECT min(trade_id) AS a, max(trade_id) AS b FROM tape WHERE product_id = 'view') SELECT cast(0 AS BIGINT) AS sequence, 'view' AS product_id, trade_id, (cents / 100.0)::DOUBLE AS price, side, epoch_us(ts) // 1000 AS event_ms
FROM tape, v WHERE trade_id > a AND trade_id < b AND product_id <> 'view' AND k % 4 = 0""")
def repair_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows for the ids that one product lacks, from what an exchange gave for some of them."""
    t = tape(spark, sf_dir)
    wanted = backfill.missing_within(t.where("product_id = 'view'"))
    pages = t.where("(size * 100 - 1) % 4 = 0").select("trade_id", F.col("price").cast("string").alias("price"), F.col("size").cast("string").alias("size"), "side", iso_millis(F.col("event_time")).alias("time"))
    found = backfill.repair_rows(pages, wanted, "view", t.agg(F.max("event_time")).first()[0])
    return found.select("sequence", "product_id", "trade_id", F.round(F.col("price").cast("double"), 6).alias("price"), "side", F.unix_millis(F.col("event_time").cast("timestamp")).alias("event_ms"))


@query(f"""WITH {TAPE_SQL}, g AS (SELECT product_id, trade_id, lead(trade_id) OVER (PARTITION BY product_id ORDER BY trade_id) AS next_trade_id FROM tape) SELECT product_id, trade_id, next_trade_id, next_trade_id - trade_id - 1 AS missing FROM g WHERE next_trade_id - trade_id > 12 ORDER BY missing DESC""")
def largest_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Holes of over eleven ids, the largest first."""
    return quality.gaps(tape(spark, sf_dir), most_missing_first=True).where("missing > 11")


@query(f"""WITH {TAPE_SQL} SELECT product_id, event_date, received, expected FROM (SELECT product_id, strftime(ts, '%Y-%m-%d') AS event_date, count(*) AS received, max(trade_id) - min(trade_id) + 1 AS expected FROM tape WHERE product_id IN ({_FOLLOWED_SQL}) GROUP BY 1, 2) WHERE received * 5 < expected""")
def sparse_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product-days that hold under a fifth of their id span, by the check on a whole history."""
    t = tape(spark, sf_dir).where(F.col("product_id").isin(*FOLLOWED))
    as_of = t.agg(F.max("event_time")).first()[0] + timedelta(days=1)
    return plain(checks.broken_contiguity(t, as_of, limit=0.8, lookback=400), "product_id", "event_date", "received", "expected")

