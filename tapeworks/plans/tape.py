"""The driver's ``events`` table read as a tape: event types are products, event ids trade ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks.functions.numeric import NUM, mul9
from tapeworks.operators.staging import _timed, with_taker_side

#: The same tape in SQL, as a common table expression named ``tape``; prices in cents and
#: sizes in hundredths, so that sums are whole numbers.
TAPE_SQL = """tape AS (
  SELECT event_type AS product_id, event_id AS trade_id, CASE WHEN k % 20 = 0 THEN 0 ELSE event_id + 1 END AS sequence,
         cast(round(value * 100) AS BIGINT) + 100 AS cents, k + 1 AS lots, CASE WHEN user_id % 2 = 0 THEN 'buy' ELSE 'sell' END AS side,
         CASE WHEN user_id % 2 = 0 THEN 'sell' ELSE 'buy' END AS taker_side, ts, k - 10 AS lag_ms, k % 20 = 0 AS is_backfilled, k
  FROM (SELECT *, cast(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
)"""


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get(F.array(F.get_json_object("props", "$.k").cast("bigint")), F.lit(0))
    return load(spark, sf_dir, "events").withColumns({"k": k, "ts": F.col("ts").cast("timestamp")})


def tape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades as the trades fact has them."""
    cents = F.round(F.col("value") * 100).cast("bigint") + 100
    rows = events(spark, sf_dir).select(
        F.col("event_id").alias("trade_id"),
        F.col("event_type").alias("product_id"),
        F.when(F.col("k") % 20 == 0, F.lit(0)).otherwise(F.col("event_id") + 1).cast("bigint").alias("sequence"),
        (cents / F.lit(100).cast("decimal(3,0)")).cast(NUM).alias("price"),
        ((F.col("k") + 1) / F.lit(100).cast("decimal(3,0)")).cast(NUM).alias("size"),
        F.when(F.col("user_id") % 2 == 0, "buy").otherwise("sell").alias("side"),
        F.lit(None).cast("string").alias("maker_order_id"),
        F.lit(None).cast("string").alias("taker_order_id"),
        F.col("ts").alias("event_time"),
        F.timestamp_add("MILLISECOND", F.col("k") - 10, F.col("ts")).alias("ingest_time"),
    )
    rows = _timed(rows.withColumns({"notional": mul9(F.col("price"), F.col("size")), "is_backfilled": F.col("sequence") == 0}))
    return with_taker_side(rows)
