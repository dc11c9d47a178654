"""Price bars and their roll-ups: one hash aggregation each, no window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeworks.functions.numeric import div9, whole
from tapeworks.functions.timing import bucket, day


def bars(trades: DataFrame, seconds: int = 60) -> DataFrame:
    """Open, high, low, close, volume and flow per product and bucket. Open and close are the
    trades of lowest and highest id, not of earliest and latest time."""
    size, taker = F.col("size"), F.col("taker_side")
    grouped = trades.groupBy("product_id", bucket(F.col("event_time"), seconds).alias("bar_start")).agg(
        F.min_by("price", "trade_id").alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", "trade_id").alias("close"),
        F.sum("size").cast("decimal(38,9)").alias("volume"),
        F.sum("notional").cast("decimal(38,9)").alias("quote_volume"),
        F.count(F.lit(1)).alias("trade_count"),
        F.sum(F.when(taker == "buy", size).otherwise(0)).cast("decimal(38,9)").alias("buy_volume"),
        F.sum(F.when(taker == "sell", size).otherwise(0)).cast("decimal(38,9)").alias("sell_volume"),
        whole(F.avg("ingest_lag_ms")).alias("avg_ingest_lag_ms"),
        F.min("trade_id").alias("first_trade_id"),
        F.max("trade_id").alias("last_trade_id"),
    )
    return grouped.select(
        "product_id",
        "bar_start",
        (F.col("bar_start") + F.make_interval(secs=F.lit(seconds))).alias("bar_end"),
        "open",
        "high",
        "low",
        "close",
        "volume",
        "quote_volume",
        "trade_count",
        div9(F.col("quote_volume"), F.col("volume")).alias("vwap"),
        "buy_volume",
        "sell_volume",
        div9(F.col("buy_volume") - F.col("sell_volume"), F.col("volume")).alias("volume_imbalance"),
        "avg_ingest_lag_ms",
        "first_trade_id",
        "last_trade_id",
        day(F.col("bar_start")).alias("event_date"),
    )


def roll_up(finer: DataFrame, seconds: int) -> DataFrame:
    """Wider bars from finer ones, never from ticks; the average price is weighted anew."""
    grouped = finer.groupBy("product_id", bucket(F.col("bar_start"), seconds).alias("window_start")).agg(
        F.min_by("open", "bar_start").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "bar_start").alias("close"),
        *[F.sum(c).cast("decimal(38,9)").alias(c) for c in ("volume", "quote_volume", "buy_volume", "sell_volume")],
        F.sum("trade_count").alias("trade_count"),
        F.count(F.lit(1)).alias("source_bar_count"),
    )
    return grouped.select(
        "product_id",
        F.col("window_start").alias("bar_start"),
        "open",
        "high",
        "low",
        "close",
        "volume",
        "quote_volume",
        "trade_count",
        div9(F.col("quote_volume"), F.col("volume")).alias("vwap"),
        "buy_volume",
        "sell_volume",
        div9(F.col("buy_volume") - F.col("sell_volume"), F.col("volume")).alias("volume_imbalance"),
        "source_bar_count",
        day(F.col("window_start")).alias("event_date"),
    )
