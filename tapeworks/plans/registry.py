"""Queries over the driver's tables and their SQL twins, by name.

Instants leave as epoch seconds, dates as text and decimals as doubles of six places, so that
both engines' values can be compared exactly.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeworks.functions.frames import running
from tapeworks.functions.numeric import NUM
from tapeworks.operators import backfill, bars, book, checks, continuity, monitor, quality, recon, staging, volatility
from tapeworks.plans.tape import TAPE_SQL, events, load, tape

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}
HOUR, DAY = 3600, 86400


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    from tapeworks.plans import registry_marts  # noqa: F401  (adds its own)

    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(_SQL)


def plain(df: DataFrame, *columns: str) -> DataFrame:
    def value(field: T.StructField):
        c = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType | T.DoubleType):
            return F.round(c.cast("double"), 6).alias(field.name)
        if isinstance(field.dataType, T.TimestampType | T.TimestampNTZType):
            return F.unix_seconds(c.cast("timestamp")).alias(field.name)
        return c.cast("string").alias(field.name) if isinstance(field.dataType, T.DateType) else c

    return df.select(*[value(df.schema[c]) for c in (columns or df.columns)])


_BARS_SQL = """bars AS (
  SELECT product_id, cast(floor(epoch(ts) / 3600) * 3600 AS BIGINT) AS bar_start, arg_min(cents, trade_id) AS o, max(cents) AS h, min(cents) AS l, arg_max(cents, trade_id) AS c,
         sum(lots) AS lots, sum(cents * lots) AS quote, count(*) AS n, sum(CASE WHEN taker_side = 'buy' THEN lots ELSE 0 END) AS bought, sum(CASE WHEN taker_side = 'sell' THEN lots ELSE 0 END) AS sold,
         sum(lag_ms) AS lag_sum, min(trade_id) AS first_id, max(trade_id) AS last_id
  FROM tape GROUP BY 1, 2
)"""


def _hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars.bars(tape(spark, sf_dir), HOUR)


@query(f"""WITH {TAPE_SQL}, {_BARS_SQL}
SELECT product_id, bar_start, bar_start + 3600 AS bar_end, round(o / 100.0, 6)::DOUBLE AS open, round(h / 100.0, 6)::DOUBLE AS high, round(l / 100.0, 6)::DOUBLE AS low, round(c / 100.0, 6)::DOUBLE AS close,
       round(lots / 100.0, 6)::DOUBLE AS volume, round(quote / 10000.0, 6)::DOUBLE AS quote_volume, n AS trade_count, round(quote::DOUBLE / lots / 100, 6) AS vwap, round(bought / 100.0, 6)::DOUBLE AS buy_volume,
       round(sold / 100.0, 6)::DOUBLE AS sell_volume, round((bought - sold)::DOUBLE / lots, 6) AS volume_imbalance,
       cast(CASE WHEN lag_sum < 0 THEN -floor(-lag_sum::DOUBLE / n + 0.5) ELSE floor(lag_sum::DOUBLE / n + 0.5) END AS BIGINT) AS avg_ingest_lag_ms,
       first_id AS first_trade_id, last_id AS last_trade_id FROM bars""")
def ohlcv_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_hourly(spark, sf_dir).drop("event_date"))


@query(f"""WITH {TAPE_SQL}, {_BARS_SQL}
SELECT product_id, cast(floor(bar_start / 86400) * 86400 AS BIGINT) AS bar_start, round(arg_min(o, bar_start) / 100.0, 6)::DOUBLE AS open, round(max(h) / 100.0, 6)::DOUBLE AS high, round(min(l) / 100.0, 6)::DOUBLE AS low,
       round(arg_max(c, bar_start) / 100.0, 6)::DOUBLE AS close, round(sum(lots) / 100.0, 6)::DOUBLE AS volume, round(sum(quote) / 10000.0, 6)::DOUBLE AS quote_volume, cast(sum(n) AS BIGINT) AS trade_count,
       round(sum(quote)::DOUBLE / sum(lots) / 100, 6) AS vwap, round(sum(bought) / 100.0, 6)::DOUBLE AS buy_volume, round(sum(sold) / 100.0, 6)::DOUBLE AS sell_volume,
       round((sum(bought) - sum(sold))::DOUBLE / sum(lots), 6) AS volume_imbalance, count(*) AS source_bar_count
FROM bars GROUP BY 1, 2""")
def ohlcv_daily_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(bars.roll_up(_hourly(spark, sf_dir), DAY).drop("event_date"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, epoch(l_shipdate)::BIGINT AS l_shipdate FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS n FROM lineitem) WHERE n = 1""")
def dedupe_earliest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", F.unix_seconds(F.col("l_shipdate").cast("timestamp")).alias("l_shipdate"))
    return staging.keep_earliest(rows, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"])


@query(f"""WITH {TAPE_SQL} SELECT side, taker_side, count(*) AS n, round(sum(lots) / 100.0, 6)::DOUBLE AS volume FROM tape GROUP BY 1, 2""")
def taker_side_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(tape(spark, sf_dir).groupBy("side", "taker_side").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("volume")))


def _l2_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Book messages made of events: signups are snapshots of one level a side, the rest deltas."""
    e = events(spark, sf_dir).withColumn("cents", F.round(F.col("value") * 100).cast("bigint"))
    price, above = (F.format_string("%d.%02d", (c / 100).cast("bigint"), c % 100) for c in (F.col("cents"), F.col("cents") + 50))
    level = lambda p, s: F.array(p, s.cast("string"))
    snapshot = F.to_json(F.struct(F.array(level(price, F.col("k") + 1)).alias("bids"), F.array(level(above, F.col("k") + 2)).alias("asks")))
    deltas = F.to_json(F.struct(F.array(F.array(F.lit("buy"), price, F.col("k").cast("string")), F.array(F.lit("sell"), above, F.lit("0"))).alias("changes")))
    is_snapshot = F.col("k") % 10 == 7
    return e.select(
        F.col("event_id").alias("sequence"), F.col("event_type").alias("product_id"), F.when(is_snapshot, "snapshot").otherwise("l2update").alias("event_type"),
        F.when(is_snapshot, snapshot).otherwise(deltas).alias("payload"), F.col("ts").cast("string").alias("event_time"), F.col("ts").cast("string").alias("ingest_time"),
    )


_L2_SQL = """l2 AS (
  SELECT event_type AS product_id, event_id, ts, CASE WHEN k % 10 = 7 THEN 'snapshot' ELSE 'l2update' END AS event_type, cast(round(value * 100) AS BIGINT) AS cents, k
  FROM (SELECT *, cast(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
), levels AS (
  SELECT product_id, ts, event_type, 'buy' AS side, cents, CASE WHEN event_type = 'snapshot' THEN k + 1 ELSE k END AS size, 0 AS change_index FROM l2
  UNION ALL SELECT product_id, ts, event_type, 'sell', cents + 50, CASE WHEN event_type = 'snapshot' THEN k + 2 ELSE 0 END, CASE WHEN event_type = 'snapshot' THEN 0 ELSE 1 END FROM l2
)"""


@query(f"""WITH {_L2_SQL} SELECT product_id, event_type, side, round(cents / 100.0, 6)::DOUBLE AS price, size::DOUBLE AS size, change_index::BIGINT AS change_index, size = 0 AS is_removal,
  epoch(date_trunc('minute', ts))::BIGINT AS event_minute FROM levels""")
def json_flatten_posexplode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(staging.flatten_l2(_l2_raw(spark, sf_dir), None), "product_id", "event_type", "side", "price", "size", "change_index", "is_removal", "event_minute")


@query("SELECT event_type, cast(json_extract_string(props, '$.k') AS BIGINT) AS k, count(*) AS n FROM events GROUP BY 1, 2")
def json_value_scalar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).groupBy("event_type", "k").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {_L2_SQL} SELECT product_id, side, event_type, count(*) AS levels, sum(size)::DOUBLE AS size FROM levels GROUP BY 1, 2, 3""")
def union_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = staging.flatten_l2(_l2_raw(spark, sf_dir), None)
    return plain(flat.groupBy("product_id", "side", "event_type").agg(F.count(F.lit(1)).alias("levels"), F.sum("size").alias("size")))


def _level_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes of whole-unit price levels at the end of each hour."""
    e = events(spark, sf_dir).select(
        F.col("event_type").alias("product_id"), F.when(F.col("user_id") % 2 == 0, "buy").otherwise("sell").alias("side"), F.floor("value").cast("bigint").alias("level"),
        F.date_trunc("HOUR", "ts").alias("minute"), "event_id", F.when(F.col("k") % 4 == 0, F.lit(0)).otherwise(F.col("k")).alias("size"),
    )
    return e.groupBy("product_id", "side", "level", "minute").agg(F.max_by("size", "event_id").alias("size"))


_LEVELS_SQL = """states AS (
  SELECT event_type AS product_id, CASE WHEN user_id % 2 = 0 THEN 'buy' ELSE 'sell' END AS side, cast(floor(value) AS BIGINT) AS level, date_trunc('hour', ts) AS minute,
         arg_max(CASE WHEN k % 4 = 0 THEN 0 ELSE k END, event_id) AS size
  FROM (SELECT *, cast(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) GROUP BY ALL
), grid AS (SELECT DISTINCT product_id, minute AS event_minute FROM states),
carried AS (
  SELECT g.product_id, g.event_minute, s.side, s.level, s.size FROM grid g JOIN states s ON g.product_id = s.product_id AND s.minute <= g.event_minute
  QUALIFY row_number() OVER (PARTITION BY g.product_id, g.event_minute, s.side, s.level ORDER BY s.minute DESC) = 1
)"""


def _carried(spark: SparkSession, sf_dir: str) -> DataFrame:
    return book.carry_forward(_level_states(spark, sf_dir), ["product_id"], ["side", "level"])


@query(f"""WITH {_LEVELS_SQL} SELECT product_id, side, epoch(event_minute)::BIGINT AS event_minute, count(*) AS levels, cast(sum(size) AS BIGINT) AS size, cast(sum(level) AS BIGINT) AS level_sum
FROM carried WHERE size > 0 GROUP BY 1, 2, 3""")
def asof_carry_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = _carried(spark, sf_dir).groupBy("product_id", "side", "event_minute").agg(F.count(F.lit(1)).alias("levels"), F.sum("size").alias("size"), F.sum("level").alias("level_sum"))
    return plain(sums)


@query(f"""WITH {_LEVELS_SQL}, b AS (SELECT * FROM carried WHERE size > 0),
top AS (SELECT product_id, event_minute, max(CASE WHEN side = 'buy' THEN level + 1 END) AS bid, min(CASE WHEN side = 'sell' THEN level + 1 END) AS ask FROM b GROUP BY 1, 2),
m AS (SELECT *, (bid + ask)::DECIMAL(18, 4) * 0.5 AS mid FROM top WHERE bid IS NOT NULL AND ask IS NOT NULL),
d AS (SELECT b.product_id, b.event_minute, count(*) AS book_levels,
  sum(CASE WHEN side = 'buy' AND level + 1 >= mid - mid * 0.0005 THEN size ELSE 0 END) AS b5, sum(CASE WHEN side = 'sell' AND level + 1 <= mid + mid * 0.0005 THEN size ELSE 0 END) AS a5,
  sum(CASE WHEN side = 'buy' AND level + 1 >= mid - mid * 0.0010 THEN size ELSE 0 END) AS b10, sum(CASE WHEN side = 'sell' AND level + 1 <= mid + mid * 0.0010 THEN size ELSE 0 END) AS a10,
  sum(CASE WHEN side = 'buy' AND level + 1 >= mid - mid * 0.0025 THEN size ELSE 0 END) AS b25, sum(CASE WHEN side = 'sell' AND level + 1 <= mid + mid * 0.0025 THEN size ELSE 0 END) AS a25
  FROM b JOIN m USING (product_id, event_minute) GROUP BY 1, 2)
SELECT product_id, epoch(event_minute)::BIGINT AS bar_start, bid::DOUBLE AS best_bid, ask::DOUBLE AS best_ask, mid::DOUBLE AS mid, (ask - bid)::DOUBLE AS spread, round((ask - bid)::DOUBLE / mid::DOUBLE * 10000, 3) AS spread_bps,
  b5::DOUBLE AS bid_depth_5bps, a5::DOUBLE AS ask_depth_5bps, b10::DOUBLE AS bid_depth_10bps, a10::DOUBLE AS ask_depth_10bps, b25::DOUBLE AS bid_depth_25bps, a25::DOUBLE AS ask_depth_25bps,
  round(b25 * mid, 6)::DOUBLE AS bid_depth_25bps_notional, round(a25 * mid, 6)::DOUBLE AS ask_depth_25bps_notional,
  CASE WHEN b25 + a25 = 0 THEN NULL ELSE round(round((b25 - a25)::DOUBLE / (b25 + a25)::DOUBLE, 9), 6) END AS book_imbalance, book_levels
FROM m JOIN d USING (product_id, event_minute)""")
def top_of_book_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = _carried(spark, sf_dir).select("product_id", "event_minute", "side", (F.col("level") + 1).cast(NUM).alias("price"), F.col("size").cast(NUM).alias("size"), F.to_date("event_minute").alias("event_date"))
    return plain(book.liquidity(state).drop("event_date").withColumn("spread_bps", F.round("spread_bps", 3)))


@query(f"""WITH {TAPE_SQL}, {_BARS_SQL}, r AS (
  SELECT product_id, bar_start, ln(c::DOUBLE / lag(c) OVER (PARTITION BY product_id ORDER BY bar_start)) AS r, ln(h::DOUBLE / l) AS hl, ln(c::DOUBLE / o) AS co FROM bars)
SELECT product_id, cast(floor(bar_start / 86400) * 86400 AS BIGINT) AS window_start, cast(floor(bar_start / 86400) * 86400 AS BIGINT) + 86400 AS window_end, count(*) AS bar_count,
  round(stddev_samp(r), 6) AS vol_close_to_close, round(sqrt(avg(hl * hl) / (4 * ln(2))), 6) AS vol_parkinson,
  round(sqrt(greatest(avg(0.5 * hl * hl - (2 * ln(2) - 1) * co * co), 0)), 6) AS vol_garman_klass, round(stddev_samp(r) * sqrt(365), 6) AS vol_close_to_close_annualised, round(sqrt(avg(hl * hl) / (4 * ln(2))) * sqrt(365), 6) AS vol_parkinson_annualised
FROM r GROUP BY 1, 2, 3""")
def realized_vol_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = volatility.realized_vol(_hourly(spark, sf_dir), DAY, per_year=365)
    return plain(found, "product_id", "window_start", "window_end", "bar_count", "vol_close_to_close", "vol_parkinson", "vol_garman_klass", "vol_close_to_close_annualised", "vol_parkinson_annualised")


@query(f"""WITH {TAPE_SQL}, h AS (
  SELECT product_id, cast(floor(epoch(ts) / 3600) * 3600 AS BIGINT) AS event_hour, count(*) AS n, min(trade_id) AS a, max(trade_id) AS b, count(*) - count(DISTINCT trade_id) AS copies,
    quantile_disc(CASE WHEN NOT is_backfilled THEN abs(lag_ms) END, 0.5) AS p50, quantile_disc(CASE WHEN NOT is_backfilled THEN abs(lag_ms) END, 0.95) AS p95, quantile_disc(CASE WHEN NOT is_backfilled THEN abs(lag_ms) END, 0.99) AS p99,
    count(*) FILTER (WHERE lag_ms < 0) AS neg, count(*) FILTER (WHERE is_backfilled) AS bf FROM tape GROUP BY 1, 2)
SELECT product_id, event_hour, n AS trades_received, b - a + 1 AS trades_expected, greatest(b - a + 1 - n, 0) AS trades_missing, round(n::DOUBLE / (b - a + 1) * 100, 4) AS completeness_pct, copies AS duplicates_removed,
  p50 AS p50_ingest_lag_ms, p95 AS p95_ingest_lag_ms, p99 AS p99_ingest_lag_ms, neg AS negative_lag_rows, bf AS backfilled_trades, a AS first_trade_id, b AS last_trade_id,
  n::DOUBLE / (b - a + 1) >= 0.9999 AS meets_completeness_sla, p99 <= 5000 AS meets_latency_sla FROM h""")
def data_quality_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tape(spark, sf_dir)
    return plain(quality.data_quality(t, t).drop("first_event_time", "last_event_time", "event_date"))


_STREAM_SQL = """stream AS (
  SELECT product_id, bar_start, arg_max(cents, trade_id) AS c, sum(lots) AS lots, sum(cents * lots) AS quote, count(*) AS n
  FROM (SELECT *, cast(floor(epoch(ts) / 3600) * 3600 AS BIGINT) AS bar_start FROM tape) t
  WHERE lag_ms <= 70 AND ts >= (SELECT min(ts) + INTERVAL 5 DAY FROM tape) AND ts < (SELECT max(ts) - INTERVAL 5 DAY FROM tape) GROUP BY 1, 2
)"""


def _panes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two panes a window of what a streaming job would have seen: not the first and last days,
    and nothing that came more than 70 ms late."""
    t = tape(spark, sf_dir)
    ends = t.agg((F.min("event_time") + F.expr("interval 5 days")).alias("a"), (F.max("event_time") - F.expr("interval 5 days")).alias("b"))
    seen = t.join(F.broadcast(ends), F.lit(True)).where("ingest_lag_ms <= 70 and event_time >= a and event_time < b")
    final = bars.bars(seen, HOUR).withColumn("pane_index", F.lit(1).cast("bigint"))
    early = bars.bars(seen.where("ingest_lag_ms <= 30"), HOUR).withColumn("pane_index", F.lit(0).cast("bigint"))
    return final.unionByName(early).withColumns({"is_final_pane": F.col("pane_index") == 1, "written_at": F.col("bar_end")})


@query(f"""WITH {TAPE_SQL}, {_BARS_SQL}, {_STREAM_SQL},
early AS (SELECT product_id, cast(floor(epoch(ts) / 3600) * 3600 AS BIGINT) AS bar_start, count(*) AS n FROM tape
  WHERE lag_ms <= 30 AND ts >= (SELECT min(ts) + INTERVAL 5 DAY FROM tape) AND ts < (SELECT max(ts) - INTERVAL 5 DAY FROM tape) GROUP BY 1, 2),
run AS (SELECT product_id, min(bar_start) AS a, max(bar_start) AS b FROM stream GROUP BY 1), front AS (SELECT product_id, max(bar_start) AS f FROM bars GROUP BY 1),
j AS (SELECT coalesce(s.product_id, b.product_id) AS product_id, coalesce(s.bar_start, b.bar_start) AS bar_start, s.n AS sn, b.n AS bn, s.lots AS sl, b.lots AS bl, s.c AS sc, b.c AS bc, s.product_id IS NOT NULL AS in_stream, b.product_id IS NOT NULL AS in_batch
  FROM stream s FULL JOIN bars b ON s.product_id = b.product_id AND s.bar_start = b.bar_start)
SELECT j.product_id, j.bar_start, in_stream, in_batch, sn AS stream_trade_count, bn AS batch_trade_count, coalesce(bn, 0) - coalesce(sn, 0) AS trade_count_diff, round((coalesce(bl, 0) - coalesce(sl, 0)) / 100.0, 6)::DOUBLE AS volume_diff,
  CASE WHEN in_stream THEN 1 + (e.n IS NOT NULL)::INT END::BIGINT AS pane_count, j.bar_start = a AS is_first_window, j.bar_start = b AS is_last_window, j.bar_start >= f AS at_batch_frontier, in_stream AND e.n IS NOT NULL AS was_restated,
  sn = bn AS counts_agree, sn = bn AND coalesce(sl, 0) = coalesce(bl, 0) AND sc = bc AS bars_agree,
  CASE WHEN NOT in_stream AND in_batch THEN '{recon.REASONS["outside"]}' WHEN in_stream AND NOT in_batch AND j.bar_start >= f THEN '{recon.REASONS["not_built"]}' WHEN in_stream AND NOT in_batch THEN '{recon.REASONS["missing"]}'
    WHEN j.bar_start = a AND sn < bn THEN '{recon.REASONS["startup"]}' WHEN j.bar_start = b AND sn < bn THEN '{recon.REASONS["shutdown"]}' WHEN sn < bn THEN '{recon.REASONS["late"]}'
    WHEN j.bar_start >= f AND sn > bn THEN '{recon.REASONS["not_built"]}' WHEN sn > bn THEN '{recon.REASONS["over"]}' ELSE 'agree' END AS divergence_reason
FROM j LEFT JOIN run ON run.product_id = j.product_id LEFT JOIN front ON front.product_id = j.product_id LEFT JOIN early e ON e.product_id = j.product_id AND e.bar_start = j.bar_start""")
def recon_full_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = "product_id bar_start in_stream in_batch stream_trade_count batch_trade_count trade_count_diff volume_diff pane_count is_first_window is_last_window at_batch_frontier was_restated counts_agree bars_agree divergence_reason"
    return plain(recon.reconcile(_panes(spark, sf_dir), _hourly(spark, sf_dir)), *columns.split())


@query(f"""WITH {TAPE_SQL} SELECT * FROM (SELECT product_id, trade_id, lead(trade_id) OVER w AS next_trade_id, lead(trade_id) OVER w - trade_id - 1 AS missing FROM tape WINDOW w AS (PARTITION BY product_id ORDER BY trade_id)) WHERE missing > 0""")
def contiguity_gap_lead(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.gaps(tape(spark, sf_dir))


@query(f"""WITH {TAPE_SQL}, e AS (SELECT product_id, min(trade_id) AS a, max(trade_id) AS b FROM tape GROUP BY 1), w AS (SELECT product_id, unnest(range(a, b + 1)) AS trade_id FROM e)
SELECT w.product_id, w.trade_id FROM w WHERE NOT EXISTS (SELECT 1 FROM tape t WHERE t.product_id = w.product_id AND t.trade_id = w.trade_id)""")
def id_set_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backfill.missing_within(tape(spark, sf_dir))


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as one connection's messages: errors are disconnects of their product, one event
    type in five a heartbeat; a product is a user."""
    kind = F.when(F.col("event_type") == "error", continuity.DISCONNECT).when(F.col("event_type") == "view", "heartbeat").otherwise("match")
    return events(spark, sf_dir).select(
        F.col("user_id").cast("string").alias("product_id"), kind.alias("type"), F.col("event_id").alias("line_no"), (F.floor(F.col("event_id") / 50) + F.col("k")).cast("bigint").alias("trade_id"),
        (F.floor(F.col("event_id") / 50) + F.col("k") + 5).cast("bigint").alias("last_trade_id"),
    )


@query("""WITH m AS (SELECT cast(user_id AS VARCHAR) AS product_id, event_id, CASE event_type WHEN 'error' THEN 'd' WHEN 'view' THEN 'h' ELSE 't' END AS kind, cast(floor(event_id / 50) AS BIGINT) + k AS id
  FROM (SELECT *, cast(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)),
e AS (SELECT *, sum(CASE WHEN kind = 'd' THEN 1 ELSE 0 END) OVER (PARTITION BY product_id ORDER BY event_id) AS epoch FROM m),
s AS (SELECT *, coalesce(max(CASE WHEN kind = 't' THEN 1 ELSE 0 END) OVER (PARTITION BY product_id, epoch ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS started FROM e WHERE kind <> 'd'),
v AS (SELECT *, CASE WHEN kind = 't' THEN id WHEN started = 1 THEN id + 5 END AS value FROM s),
p AS (SELECT *, max(value) OVER (PARTITION BY product_id, epoch ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM v)
SELECT event_id AS line_no, product_id, cast(epoch AS BIGINT) AS epoch,
  CASE WHEN kind = 't' THEN CASE WHEN seen IS NULL THEN 'FIRST' WHEN value - seen = 1 THEN 'IN_ORDER' WHEN value - seen > 1 THEN 'GAP' ELSE 'DUPLICATE' END WHEN value - seen > 0 THEN 'HEARTBEAT_GAP' ELSE 'HEARTBEAT_OK' END AS continuity,
  cast(CASE WHEN kind = 't' AND value - seen > 1 THEN value - seen - 1 WHEN kind = 'h' AND value - seen > 0 THEN value - seen ELSE 0 END AS BIGINT) AS missing FROM p""")
def continuity_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return continuity.classify(continuity.with_epochs(_messages(spark, sf_dir), connection="product_id")).select("line_no", "product_id", "epoch", "continuity", "missing")


@query(f"""WITH {TAPE_SQL}, b AS (SELECT product_id, cast(ts AS DATE) AS d, count(*) AS n, sum(lots) AS lots FROM tape WHERE lag_ms <= 70 GROUP BY 1, 2), t AS (SELECT product_id, cast(ts AS DATE) AS d, count(*) AS n, sum(lots) AS lots FROM tape GROUP BY 1, 2)
SELECT coalesce(b.product_id, t.product_id) AS product_id, strftime(coalesce(b.d, t.d), '%Y-%m-%d') AS event_date, b.n AS bar_trades, t.n AS trades, (b.lots / 100.0)::DOUBLE AS bar_volume, (t.lots / 100.0)::DOUBLE AS trade_volume
FROM b FULL JOIN t ON b.product_id = t.product_id AND b.d = t.d WHERE b.n IS DISTINCT FROM t.n OR abs(coalesce(b.lots, 0) - coalesce(t.lots, 0)) > 0""")
def volume_reconciles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars that missed late trades, against all trades."""
    t = tape(spark, sf_dir)
    return plain(checks.unreconciled_volume(bars.bars(t.where("ingest_lag_ms <= 70"), HOUR), t), "product_id", "event_date", "bar_trades", "trades", "bar_volume", "trade_volume")


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def duplicates_having(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.duplicates(load(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""SELECT event_type AS product_id, epoch(date_trunc('hour', ts))::BIGINT AS bar_start, arg_max(value, event_id) AS value, count(*) AS pane_count, max(event_id) AS final_pane_index FROM events GROUP BY 1, 2""")
def final_pane_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    panes = events(spark, sf_dir).select(F.col("event_type").alias("product_id"), F.date_trunc("HOUR", "ts").alias("bar_start"), F.col("event_id").alias("pane_index"), F.col("ts").alias("written_at"), "value")
    return recon.final_panes(panes).select("product_id", F.unix_seconds("bar_start").alias("bar_start"), "value", "pane_count", "final_pane_index")


@query("""WITH b AS (SELECT event_type AS label, cast(floor(epoch(ts) / 3600) * 3600 AS BIGINT) AS bucket, count(*) AS n FROM events GROUP BY 1, 2), s AS (SELECT min(bucket) AS a, max(bucket) AS z FROM b),
g AS (SELECT label, unnest(range(a, z + 3600, 3600)) AS bucket FROM (SELECT DISTINCT label FROM b), s)
SELECT g.label, g.bucket, cast(coalesce(b.n, 0) AS BIGINT) AS total, coalesce(b.n, 0) > 3 OR coalesce(b.n, 0) < 1 AS fires FROM g LEFT JOIN b ON b.label = g.label AND b.bucket = g.bucket""")
def alert_window_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(monitor.alerts(monitor.on_grid(events(spark, sf_dir), HOUR, "event_type"), above=3, below=1))


@query("""SELECT product_id, epoch_us(a) AS silent_from, epoch_us(ts) AS silent_to, (epoch_us(ts) - epoch_us(a)) / 1e6 AS seconds FROM (SELECT event_type AS product_id, ts, lag(ts) OVER (PARTITION BY event_type ORDER BY ts) AS a FROM events)
WHERE epoch_us(ts) - epoch_us(a) > 3600000000""")
def stall_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = monitor.stalls(events(spark, sf_dir).withColumnRenamed("event_type", "product_id"), HOUR, ts="ts")
    return found.select("product_id", F.unix_micros("silent_from").alias("silent_from"), F.unix_micros("silent_to").alias("silent_to"), "seconds")


@query(f"""WITH {TAPE_SQL}, r AS (SELECT product_id, lag_ms, row_number() OVER (PARTITION BY product_id ORDER BY lag_ms) - 1 AS i, count(*) OVER (PARTITION BY product_id) AS n FROM tape)
SELECT product_id, max(CASE WHEN i = least(floor(n * 0.5), n - 1) THEN lag_ms END) AS p50, max(CASE WHEN i = least(floor(n * 0.95), n - 1) THEN lag_ms END) AS p95, max(CASE WHEN i = least(floor(n * 0.99), n - 1) THEN lag_ms END) AS p99 FROM r GROUP BY 1""")
def lag_percentile_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.lag_percentiles(tape(spark, sf_dir), key="product_id")


@query(f"""WITH {TAPE_SQL}, b AS (SELECT cast(floor(epoch(ts) / 3600) * 3600 AS BIGINT) AS bucket, product_id, count(*) AS n FROM tape GROUP BY 1, 2), s AS (SELECT min(bucket) AS a, max(bucket) AS z FROM b), g AS (SELECT unnest(range(a, z + 3600, 3600)) AS bucket FROM s)
SELECT g.bucket, round(coalesce(sum(n), 0) / 60.0, 6)::DOUBLE AS all_labels, round(coalesce(max(n), 0) / 60.0, 6)::DOUBLE AS busiest FROM g LEFT JOIN b USING (bucket) GROUP BY 1""")
def publish_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(monitor.rate_per_minute(monitor.on_grid(tape(spark, sf_dir), HOUR, "product_id", "event_time"), HOUR))


@query(f"""WITH {TAPE_SQL}, d AS (SELECT product_id, cast(ts AS DATE) AS event_date, count(DISTINCT trade_id) AS received, max(trade_id) - min(trade_id) + 1 AS expected FROM tape GROUP BY 1, 2), e AS (SELECT max(cast(ts AS DATE)) AS today FROM tape)
SELECT product_id, strftime(event_date, '%Y-%m-%d') AS event_date, received, expected, round((expected - received)::DOUBLE / expected, 6) AS missing_share FROM d, e WHERE event_date < today AND event_date >= today - 3 AND (expected - received)::DOUBLE / expected > 0.0001""")
def trade_ids_contiguous(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tape(spark, sf_dir)
    as_of = t.agg(F.max("event_time")).first()[0]
    return plain(checks.broken_contiguity(t, as_of))


@query(f"""WITH {TAPE_SQL}, {_BARS_SQL}, e AS (SELECT product_id, min(bar_start) AS a, max(bar_start) AS z FROM bars GROUP BY 1), g AS (SELECT product_id, unnest(range(a, z + 3600, 3600)) AS event_hour FROM e)
SELECT g.product_id, g.event_hour FROM g WHERE NOT EXISTS (SELECT 1 FROM bars b WHERE b.product_id = g.product_id AND b.bar_start = g.event_hour)""")
def silent_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tape(spark, sf_dir)
    return plain(quality.silent_hours(quality.data_quality(t, t)))


@query(f"""WITH {TAPE_SQL}, e AS (SELECT max(cast(ts AS DATE)) AS today FROM tape) SELECT strftime(cast(ts AS DATE), '%Y-%m-%d') AS event_date, count(*) AS n FROM tape, e WHERE cast(ts AS DATE) >= today - 3 GROUP BY 1""")
def incremental_lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tapeworks.functions.timing import within_lookback

    t = tape(spark, sf_dir)
    as_of = t.agg(F.max("event_time")).first()[0]
    return plain(t.where(within_lookback(F.col("event_date"), F.lit(as_of).cast("timestamp"), 3)).groupBy("event_date").agg(F.count(F.lit(1)).alias("n")))


@query(f"""WITH {TAPE_SQL}, {_BARS_SQL} SELECT product_id, bar_start, (o / 100.0)::DOUBLE AS open, (h / 100.0)::DOUBLE AS high, (l / 100.0)::DOUBLE AS low, (c / 100.0)::DOUBLE AS close, (lots / 100.0)::DOUBLE AS volume, n AS trade_count,
  round(quote::DOUBLE / lots / 100, 6) AS vwap, first_id AS first_trade_id, last_id AS last_trade_id FROM bars""")
def tumbling_batch_equiv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The streaming job's aggregation over the whole tape at once."""
    from tapeworks.streaming.jobs import windowed_bars

    return plain(windowed_bars(tape(spark, sf_dir).select("product_id", "trade_id", "price", "size", "event_time"), HOUR).drop("bar_end"))


def _scratch(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        import tempfile

        base = f"file://{tempfile.gettempdir()}/checkpoints"
    return f"{base.rstrip('/')}/streams/{uuid.uuid4().hex}"


def _stream_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = spark.readStream.schema(spark.read.parquet(f"{sf_dir}/events.parquet").schema).parquet(f"{sf_dir}/events.parquet*")
    cents = F.round(F.col("value") * 100).cast("bigint") + 100
    return raw.select(
        F.col("event_type").alias("product_id"), F.col("event_id").alias("trade_id"), (cents / F.lit(100).cast("decimal(3,0)")).cast(NUM).alias("price"),
        ((F.get_json_object("props", "$.k").cast("bigint") + 1) / F.lit(100).cast("decimal(3,0)")).cast(NUM).alias("size"), F.col("ts").cast("timestamp").alias("event_time"),
    )


@query(_SQL["tumbling_batch_equiv"])
def tumbling_stream_equiv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same bars through a file stream: panes are appended, the last of each window counts."""
    from tapeworks.streaming.jobs import windowed_bars

    where = _scratch(spark)
    updates = windowed_bars(_stream_of(spark, sf_dir), HOUR)

    def keep(batch: DataFrame, number: int) -> None:
        # a batch that is tried again replaces what it wrote
        batch.withColumns({"pane_index": F.lit(number).cast("bigint"), "written_at": F.current_timestamp()}).write.mode("overwrite").parquet(f"{where}/panes/batch={number}")

    updates.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", f"{where}/state").trigger(availableNow=True).start().awaitTermination()
    last = recon.final_panes(spark.read.parquet(f"{where}/panes"))
    return plain(last, "product_id", "bar_start", "open", "high", "low", "close", "volume", "trade_count", "vwap", "first_trade_id", "last_trade_id")


@query(f"""WITH {TAPE_SQL}, b AS (SELECT product_id, cast(floor(epoch(ts) / 3600) * 3600 AS BIGINT) AS bar_start, arg_min(cents, trade_id) AS o, max(cents) AS h, min(cents) AS l, arg_max(cents, trade_id) AS c, sum(lots) AS lots, sum(cents * lots) AS quote, count(*) AS n,
  min(trade_id) AS first_id, max(trade_id) AS last_id FROM tape GROUP BY 1, 2), e AS (SELECT product_id, max(bar_start) AS open_window FROM b GROUP BY 1)
SELECT b.product_id, bar_start, bar_start + 3600 AS bar_end, (o / 100.0)::DOUBLE AS open, (h / 100.0)::DOUBLE AS high, (l / 100.0)::DOUBLE AS low, (c / 100.0)::DOUBLE AS close, (lots / 100.0)::DOUBLE AS volume, n AS trade_count, round(quote::DOUBLE / lots / 100, 6) AS vwap,
  first_id AS first_trade_id, last_id AS last_trade_id, cast(0 AS BIGINT) AS pane_index, false AS is_final_pane FROM b JOIN e ON b.product_id = e.product_id WHERE bar_start < open_window""")
def stateful_panes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Panes by the stateful processor, over the tape as a stream: it comes in order of time, so each
    window fires once, when a later trade passes its end, and a product's last window stays open."""
    from tapeworks.streaming.jobs import append_panes, drain, pane_bars

    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    where = _scratch(spark)
    drain(append_panes(pane_bars(_stream_of(spark, sf_dir), HOUR, 1800), f"{where}/panes", f"{where}/state"))
    return plain(spark.read.parquet(f"{where}/panes").drop("written_at"))


@query(f"""WITH {_L2_SQL}, snaps AS (SELECT product_id, ts, lead(ts) OVER (PARTITION BY product_id ORDER BY ts) AS until, cents + 25 AS mid FROM l2 WHERE event_type = 'snapshot'),
r AS (SELECT l.*, s.ts AS snap FROM levels l JOIN snaps s ON l.product_id = s.product_id AND l.ts >= s.ts AND (s.until IS NULL OR l.ts < s.until) WHERE abs(l.cents - s.mid) <= s.mid * 0.01),
st AS (SELECT product_id, snap, side, cents, date_trunc('minute', ts) AS minute, arg_max(size, (event_type <> 'snapshot', ts, change_index)) AS size FROM r GROUP BY ALL),
g AS (SELECT DISTINCT product_id, snap, minute FROM st),
c AS (SELECT g.product_id, g.snap, g.minute, s.side, s.cents, s.size FROM g JOIN st s ON g.product_id = s.product_id AND g.snap = s.snap AND s.minute <= g.minute
  QUALIFY row_number() OVER (PARTITION BY g.product_id, g.snap, g.minute, s.side, s.cents ORDER BY s.minute DESC) = 1),
f AS (SELECT * FROM c WHERE size > 0 QUALIFY snap = max(snap) OVER (PARTITION BY product_id, minute))
SELECT product_id, epoch(minute)::BIGINT AS event_minute, side, (cents / 100.0)::DOUBLE AS price, size::DOUBLE AS size FROM f""")
def book_state_epochs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(book.book_state(staging.flatten_l2(_l2_raw(spark, sf_dir), None)), "product_id", "event_minute", "side", "price", "size")


@query("""WITH m AS (SELECT event_type AS product_id, event_id AS line_no, cast(round(value * 100) AS BIGINT) AS cents, k, k % 10 = 7 AS is_snapshot FROM (SELECT *, cast(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)),
s AS (SELECT *, max(CASE WHEN is_snapshot THEN line_no END) OVER (PARTITION BY product_id ORDER BY line_no) AS snap FROM m),
c AS (SELECT product_id, snap, line_no, 'buy' AS side, cents, CASE WHEN is_snapshot THEN k + 1 ELSE k END AS size FROM s WHERE snap IS NOT NULL UNION ALL SELECT product_id, snap, line_no, 'sell', cents + 50, CASE WHEN is_snapshot THEN k + 2 ELSE 0 END FROM s WHERE snap IS NOT NULL),
l AS (SELECT s.product_id, s.line_no, c.side, c.cents, arg_max(c.size, c.line_no) AS size FROM s JOIN c ON s.product_id = c.product_id AND s.snap = c.snap AND c.line_no <= s.line_no GROUP BY ALL),
q AS (SELECT product_id, line_no, max(CASE WHEN side = 'buy' THEN cents END) AS bid, min(CASE WHEN side = 'sell' THEN cents END) AS ask, arg_max(size, cents) FILTER (WHERE side = 'buy') AS bid_size, arg_min(size, cents) FILTER (WHERE side = 'sell') AS ask_size, count(*) AS n FROM l WHERE size > 0 GROUP BY 1, 2)
SELECT s.product_id, cast(s.line_no AS INTEGER) AS line_no, snap IS NOT NULL AS ready, (bid / 100.0)::DOUBLE AS best_bid, bid_size::DOUBLE AS bid_size, (ask / 100.0)::DOUBLE AS best_ask, ask_size::DOUBLE AS ask_size, cast(coalesce(n, 0) AS INTEGER) AS levels, coalesce(bid >= ask, false) AS crossed
FROM s LEFT JOIN q ON q.product_id = s.product_id AND q.line_no = s.line_no""")
def order_book_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The book machine over the tape's book messages, as a stream."""
    from tapeworks import schemas
    from tapeworks.streaming.jobs import drain, order_books

    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    where = _scratch(spark)
    raw = _l2_raw(spark, sf_dir).select(F.col("sequence").cast("int").alias("line_no"), "product_id", F.col("event_type").alias("type"), F.from_json("payload", schemas.PAYLOAD).alias("p")).select("line_no", "product_id", "type", "p.*")
    raw.write.parquet(f"{where}/messages")
    stream = spark.readStream.schema(spark.read.parquet(f"{where}/messages").schema).parquet(f"{where}/messages")
    drain(order_books(stream).writeStream.format("parquet").option("path", f"{where}/books").option("checkpointLocation", f"{where}/state"))
    return plain(spark.read.parquet(f"{where}/books"))


@query(f"""WITH {TAPE_SQL} SELECT product_id, trade_id, sum(lots) OVER (PARTITION BY product_id ORDER BY trade_id)::BIGINT AS running_lots FROM tape""")
def running_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    lots = tape(spark, sf_dir).select("product_id", "trade_id", (F.col("size") * 100).cast("bigint").alias("lots"))
    return running(lots, ["product_id"], F.col("trade_id"), F.floor(F.col("trade_id") / quality.ID_CELL), F.col("lots"), "running_lots").drop("lots")
