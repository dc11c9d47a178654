"""Data checks. Each returns the offending rows; none means that the check holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks import config
from tapeworks.functions.numeric import div9


def missing_products(spark: SparkSession, trades: DataFrame, as_of, products: tuple[str, ...] = config.TRACKED_PRODUCTS) -> DataFrame:
    expected = spark.range(1).select(F.explode(F.array(*map(F.lit, products))).alias("product_id"))
    recent = trades.where(F.col("event_time") >= F.lit(as_of).cast("timestamp") - F.expr("interval 1 day")).select("product_id").distinct()
    return expected.join(recent, "product_id", "left_anti")


def incoherent_bars(bars: DataFrame) -> DataFrame:
    return bars.where("low > open or low > close or high < open or high < close or low > high")


def unreconciled_volume(bars: DataFrame, trades: DataFrame, tolerance: str = config.VOLUME_TOLERANCE) -> DataFrame:
    """Product-days whose bars and trades differ in count at all, or in volume beyond tolerance."""
    b = bars.groupBy("product_id", "event_date").agg(F.sum("trade_count").alias("bar_trades"), F.sum("volume").alias("bar_volume"))
    t = trades.groupBy("product_id", "event_date").agg(F.count(F.lit(1)).alias("trades"), F.sum("size").alias("trade_volume"))
    off = F.abs(F.coalesce("bar_volume", F.lit(0)) - F.coalesce("trade_volume", F.lit(0))) > F.lit(tolerance).cast("decimal(38,9)")
    return b.join(t, ["product_id", "event_date"], "full").where(~F.col("bar_trades").eqNullSafe(F.col("trades")) | off)


def failed_sla(quality: DataFrame, as_of) -> DataFrame:
    hour = F.date_trunc("HOUR", F.lit(as_of).cast("timestamp"))
    return quality.where((F.col("event_hour") < hour) & (~F.col("meets_completeness_sla") | ~F.col("meets_latency_sla")))


def slow_ingest(trades: DataFrame, as_of, limit: int = config.LATENCY_SLA_MS) -> DataFrame:
    recent = trades.where((F.col("event_time") >= F.lit(as_of).cast("timestamp") - F.expr("interval 1 day")) & ~F.col("is_backfilled"))
    p99 = recent.groupBy("product_id").agg(F.percentile_approx(F.abs("ingest_lag_ms"), F.lit(0.99), F.lit(10_000)).alias("p99_ingest_lag_ms"))
    return p99.where(F.col("p99_ingest_lag_ms") > limit)


def duplicates(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def wrong_taker_side(trades: DataFrame) -> DataFrame:
    return trades.where("taker_side is null or side = taker_side")


def broken_contiguity(trades: DataFrame, as_of, limit: float = config.DAILY_LOSS_LIMIT, lookback: int = config.LOOKBACK_DAYS) -> DataFrame:
    """Whole product-days within the lookback that lack more than ``limit`` of their id span."""
    today = F.to_date(F.lit(as_of).cast("timestamp"))
    days = trades.where((F.col("event_date") < today) & (F.col("event_date") >= F.date_sub(today, lookback)))
    found = days.groupBy("product_id", "event_date").agg(F.count_distinct("trade_id").alias("received"), (F.max("trade_id") - F.min("trade_id") + 1).alias("expected"))
    return found.withColumn("missing_share", div9((F.col("expected") - F.col("received")).cast("decimal(38,9)"), F.col("expected").cast("decimal(38,9)"))).where(F.col("missing_share") > limit)


def not_accepted(rows: DataFrame, column: str, values: tuple) -> DataFrame:
    return rows.where(~F.col(column).isin(*values))


def out_of_range(rows: DataFrame, column: str, low: str, high: str) -> DataFrame:
    return rows.where(~F.col(column).between(F.lit(low).cast("decimal(38,9)"), F.lit(high).cast("decimal(38,9)")))


def orphans(rows: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    return rows.where(F.col(key).isNotNull()).join(parent.select(key).distinct(), key, "left_anti")


def violates(rows: DataFrame, expression: str) -> DataFrame:
    """Rows for which the expression is false; unknown passes."""
    return rows.where(f"not ({expression})")


def nulls(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.where(" or ".join(f"{c} is null" for c in columns))
