"""Completeness and latency per product and hour, gaps between ids, and data checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeworks import config
from tapeworks.functions.frames import neighbour
from tapeworks.functions.timing import bucket


def data_quality(trades: DataFrame, typed: DataFrame, seconds: int = 3600, accuracy: int = 10_000, null_latency_passes: bool | None = None) -> DataFrame:
    """Quality of deduplicated ``trades``, with copies counted in ``typed`` (before deduplication).

    Loss is counted by the span of ids. Backfilled rows have no say in latency; an hour with
    nothing else has no latency verdict unless ``null_latency_passes`` gives one.
    """
    live = F.when(~F.col("is_backfilled"), F.abs("ingest_lag_ms"))
    hourly = trades.groupBy("product_id", bucket(F.col("event_time"), seconds).alias("event_hour")).agg(
        F.count(F.lit(1)).alias("trades_received"),
        F.min("trade_id").alias("first_trade_id"),
        F.max("trade_id").alias("last_trade_id"),
        F.percentile_approx(live, F.array(F.lit(0.5), F.lit(0.95), F.lit(0.99)), F.lit(accuracy)).alias("q"),
        F.count_if("is_backfilled").alias("backfilled_trades"),
        F.count_if(F.col("ingest_lag_ms") < 0).alias("negative_lag_rows"),
        F.min("event_time").alias("first_event_time"),
        F.max("event_time").alias("last_event_time"),
        F.min("event_date").alias("event_date"),
    )
    raw = typed.groupBy("product_id", bucket(F.col("event_time"), seconds).alias("event_hour")).agg((F.count(F.lit(1)) - F.count_distinct("trade_id")).alias("copies"))
    span = F.col("last_trade_id") - F.col("first_trade_id") + 1
    p99 = F.get("q", F.lit(2))
    latency = p99 <= config.LATENCY_SLA_MS
    return hourly.join(raw, ["product_id", "event_hour"], "left").select(
        "product_id",
        "event_hour",
        "trades_received",
        span.alias("trades_expected"),
        F.greatest(span - F.col("trades_received"), F.lit(0)).alias("trades_missing"),
        F.round(F.try_divide(F.col("trades_received"), span) * 100, 4).alias("completeness_pct"),
        F.coalesce("copies", F.lit(0)).alias("duplicates_removed"),
        F.get("q", F.lit(0)).alias("p50_ingest_lag_ms"),
        F.get("q", F.lit(1)).alias("p95_ingest_lag_ms"),
        p99.alias("p99_ingest_lag_ms"),
        "negative_lag_rows",
        "backfilled_trades",
        "first_trade_id",
        "last_trade_id",
        "first_event_time",
        "last_event_time",
        (F.try_divide(F.col("trades_received"), span) >= config.COMPLETENESS_SLA).alias("meets_completeness_sla"),
        (latency if null_latency_passes is None else F.coalesce(latency, F.lit(null_latency_passes))).alias("meets_latency_sla"),
        "event_date",
    )


#: Ids of one cell of the search for gaps; a product's ids are dealt to as many tasks as it has cells.
ID_CELL = 100_000


def gaps(trades: DataFrame, most_missing_first: bool = False) -> DataFrame:
    """Every hole between neighbouring ids of a product, over hour borders too."""
    ids = trades.select("product_id", "trade_id")
    after = neighbour(ids, ["product_id"], F.col("trade_id"), F.floor(F.col("trade_id") / ID_CELL), F.col("trade_id"), "next_trade_id", ahead=True)
    found = after.where(F.col("next_trade_id") - F.col("trade_id") > 1).withColumn("missing", F.col("next_trade_id") - F.col("trade_id") - 1)
    return found.orderBy(F.desc("missing"), "product_id", "trade_id") if most_missing_first else found


def silent_hours(quality: DataFrame) -> DataFrame:
    """Hours between a product's first and last without any trade, which the hourly table lacks."""
    ends = quality.groupBy("product_id").agg(F.min("event_hour").alias("a"), F.max("event_hour").alias("b"))
    grid = ends.select("product_id", F.explode(F.sequence("a", "b", F.expr("interval 1 hour"))).alias("event_hour"))
    return grid.join(quality.select("product_id", "event_hour"), ["product_id", "event_hour"], "left_anti")


def freshness(rows: DataFrame, as_of, warn: int = config.SOURCE_FRESHNESS["trades"][0], error: int = config.SOURCE_FRESHNESS["trades"][1]) -> DataFrame:
    """Minutes since the last arrival within a day of ``as_of``, and pass, warn, error or empty."""
    now = F.lit(as_of).cast("timestamp")
    recent = rows.where(F.col("publish_time").isNull() | (F.col("publish_time") >= now - F.expr("interval 1 day")))
    last = recent.agg(F.max("publish_time").alias("last_arrival"))
    stale = F.timestamp_diff("MINUTE", F.col("last_arrival"), now)
    status = F.when(stale.isNull(), "empty").when(stale > error, "error").when(stale > warn, "warn").otherwise("pass")
    return last.select("last_arrival", stale.alias("staleness_minutes"), status.alias("status"))


def freshness_of(sources: dict[str, DataFrame], as_of, thresholds: dict[str, tuple[int, int]] = config.SOURCE_FRESHNESS) -> DataFrame:
    """One row a source, each against its own (warn, error) minutes; unlisted ones as trades."""
    found = [freshness(rows, as_of, *thresholds.get(name, thresholds["trades"])).withColumn("source", F.lit(name)) for name, rows in sources.items()]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.select("source", "last_arrival", "staleness_minutes", "status")


def should_run(rows: DataFrame, as_of, limit: int = config.FRESHNESS_MINUTES) -> tuple[bool, str]:
    """Gate of a scheduled run: skip when the feed is silent or stale."""
    found = freshness(rows, as_of).first()
    if found["last_arrival"] is None:
        return False, "no rows in the last 24 hours"
    if found["staleness_minutes"] > limit:
        return False, f"feed is {found['staleness_minutes']} minutes stale"
    return True, f"feed is {found['staleness_minutes']} minutes old"
