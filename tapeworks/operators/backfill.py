"""Planning a backfill: which ids are missing, and rows that repair them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks import schemas
from tapeworks.functions.timing import iso_millis


def wanted_ids(spark: SparkSession, after: int, before: int) -> DataFrame:
    """Ids strictly between ``after`` and ``before``."""
    return spark.range(after + 1, max(after + 1, before)).withColumnRenamed("id", "trade_id")


def missing_ids(spark: SparkSession, trades: DataFrame, after: int, before: int) -> DataFrame:
    return wanted_ids(spark, after, before).join(trades.select("trade_id").distinct(), "trade_id", "left_anti")


def missing_within(trades: DataFrame) -> DataFrame:
    """Every id that a product lacks between its first and last, by holes rather than by a full range."""
    from tapeworks.operators.quality import gaps

    return gaps(trades).select("product_id", F.explode(F.sequence(F.col("trade_id") + 1, F.col("next_trade_id") - 1)).alias("trade_id"))


def repair_rows(pages: DataFrame, wanted: DataFrame, product: str, fetched_at) -> DataFrame:
    """Raw rows of the wanted trades among fetched ones (trade_id, price, size, side, time), in
    ascending order. Sequence 0 marks them as backfilled; order ids are unknown."""
    found = pages.join(wanted.select("trade_id"), "trade_id", "left_semi").dropDuplicates(["trade_id"])
    now = iso_millis(F.lit(fetched_at).cast("timestamp"))
    return (
        found.select(
            F.lit(0).cast("bigint").alias("sequence"), F.lit(product).alias("product_id"), "trade_id", "price", "size", "side",
            F.lit("").alias("maker_order_id"), F.lit("").alias("taker_order_id"), F.col("time").alias("event_time"), now.alias("ingest_time"),
        )
        .to(schemas.TRADES)
        .orderBy("trade_id")
    )
