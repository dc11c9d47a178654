"""Raw messages to typed, deduplicated rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeworks import config, schemas
from tapeworks.functions.numeric import mul9, num
from tapeworks.functions.timing import day, instant, lag_ms


def _has(df: DataFrame, name: str, kind: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def _timed(df: DataFrame) -> DataFrame:
    """Derive lag, day and minute in a second step: the casts must come first."""
    return df.withColumns({"ingest_lag_ms": lag_ms(F.col("event_time"), F.col("ingest_time")), "event_date": day(F.col("event_time")), "event_minute": F.date_trunc("MINUTE", "event_time")})


def type_trades(raw: DataFrame, products: tuple[str, ...] | None = config.TRACKED_PRODUCTS, synthetic: tuple[int, ...] = config.SYNTHETIC_TRADE_IDS) -> DataFrame:
    """Typed trades before deduplication: tracked products, no synthetic ids."""
    rows = raw if products is None else raw.where(F.col("product_id").isin(*products))
    typed = rows.select(
        F.col("trade_id").cast("bigint").alias("trade_id"),
        "product_id",
        F.col("sequence").cast("bigint").alias("sequence"),
        num("price").alias("price"),
        num("size").alias("size"),
        "side",
        F.nullif(F.col("maker_order_id"), F.lit("")).alias("maker_order_id"),
        F.nullif(F.col("taker_order_id"), F.lit("")).alias("taker_order_id"),
        instant(F.col("event_time")).alias("event_time"),
        instant(F.col("ingest_time")).alias("ingest_time"),
        _has(raw, "publish_time", "timestamp").alias("publish_time"),
        _has(raw, "message_id", "string").alias("message_id"),
    )
    if synthetic:
        typed = typed.where(~F.col("trade_id").isin(*synthetic))
    return _timed(typed.withColumns({"notional": mul9(F.col("price"), F.col("size")), "is_backfilled": F.col("sequence") == 0}))


def keep_earliest(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the first in ``order``. The planner limits groups before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def stage_trades(raw: DataFrame, products: tuple[str, ...] | None = config.TRACKED_PRODUCTS, synthetic: tuple[int, ...] = config.SYNTHETIC_TRADE_IDS) -> DataFrame:
    """Typed trades, the earliest arrival of each (trade_id, product_id); message_id breaks ties."""
    return keep_earliest(type_trades(raw, products, synthetic), ["trade_id", "product_id"], ["ingest_time", "publish_time", "message_id"]).drop("message_id")


def with_taker_side(trades: DataFrame) -> DataFrame:
    """The trades fact: ``side`` is the maker's, ``taker_side`` its inverse, null for anything else."""
    side = F.col("side")
    taker = F.when(side == "buy", "sell").when(side == "sell", "buy")
    return trades.withColumn("taker_side", taker).select(*schemas.contract("fct_trades")[0].names)


def flatten_l2(raw: DataFrame, products: tuple[str, ...] | None = config.TRACKED_PRODUCTS) -> DataFrame:
    """One row per price level change. Deltas keep their index in the message; the levels of a
    snapshot, bids as buy and asks as sell, have index 0. Size 0 is a removal."""
    rows = raw if products is None else raw.where(F.col("product_id").isin(*products))
    parsed = rows.select(
        "product_id",
        "event_type",
        F.from_json("payload", schemas.PAYLOAD).alias("p"),
        instant(F.col("event_time")).alias("event_time"),
        instant(F.col("ingest_time")).alias("ingest_time"),
        _has(raw, "publish_time", "timestamp").alias("publish_time"),
        _has(raw, "message_id", "string").alias("message_id"),
    )
    def levels(field: str, side: Column | None, indexed: bool) -> Column:
        at = 0 if side is not None else 1
        return F.transform(
            F.coalesce(f"p.{field}", F.array().cast("array<array<string>>")),
            lambda level, i: F.struct(
                (F.get(level, F.lit(0)) if side is None else side).alias("side"), num(F.get(level, F.lit(at))).alias("price"), num(F.get(level, F.lit(at + 1))).alias("size"),
                (i if indexed else F.lit(0)).cast("bigint").alias("change_index"),
            ),
        )

    # one scan, one parse, one explode
    of_message = F.when(F.col("event_type") == "l2update", levels("changes", None, True)).when(
        F.col("event_type") == "snapshot", F.concat(levels("bids", F.lit("buy"), False), levels("asks", F.lit("sell"), False))
    )
    every = parsed.select("product_id", "event_type", "event_time", "ingest_time", "publish_time", "message_id", F.inline(of_message))
    return _timed(every.withColumn("is_removal", F.col("size") == 0))


def type_heartbeats(raw: DataFrame, products: tuple[str, ...] | None = config.TRACKED_PRODUCTS) -> DataFrame:
    rows = raw if products is None else raw.where(F.col("product_id").isin(*products))
    return _timed(
        rows.select(
            "product_id",
            F.col("sequence").cast("bigint").alias("sequence"),
            F.col("last_trade_id").cast("bigint").alias("last_trade_id"),
            instant(F.col("event_time")).alias("event_time"),
            instant(F.col("ingest_time")).alias("ingest_time"),
            _has(raw, "publish_time", "timestamp").alias("publish_time"),
        )
    )
