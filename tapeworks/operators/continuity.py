"""Continuity of a message stream as window expressions: gaps, copies, heartbeats, epochs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeworks.functions.frames import running

DISCONNECT = "__disconnect__"
TRADE_TYPES = ("match", "last_match")


#: Messages of one cell of a connection's order; an order is dealt to as many tasks as it has cells.
CELL = 100_000


def _cell(order: str):
    return F.floor(F.col(order) / CELL)


def with_epochs(messages: DataFrame, order: str = "line_no", connection: str | None = None) -> DataFrame:
    """Number of disconnects before each message. A connection's messages come in one order, which
    ``order`` numbers; without that column there is one connection."""
    cuts = F.when(F.col("type") == DISCONNECT, 1).otherwise(0)
    return running(messages, [connection] if connection else [], F.col(order), _cell(order), cuts, "epoch")


def classify(messages: DataFrame, order: str = "line_no") -> DataFrame:
    """Adds seen, continuity and missing to trades and heartbeats, per product and epoch.

    A trade is FIRST, IN_ORDER, GAP (ids are missing) or DUPLICATE (not above the highest seen,
    which stays). A heartbeat ahead of the highest id seen is HEARTBEAT_GAP and raises it; a
    heartbeat before the first trade of its epoch says nothing.
    """
    keys, is_trade = ["product_id", "epoch"], F.col("type").isin(*TRADE_TYPES)
    rows = messages.where(is_trade | (F.col("type") == "heartbeat"))
    # the first trade of an epoch is one row for each: it starts the counting
    starts = rows.where(is_trade).groupBy(*keys).agg(F.min(order).alias("_start"))
    rows = rows.join(starts, keys, "left").withColumn("value", F.when(is_trade, F.col("trade_id")).when(F.col(order) > F.col("_start"), F.coalesce("last_trade_id", F.lit(0)))).drop("_start")
    rows = running(rows, keys, F.col(order), _cell(order), F.col("value"), "seen", "max", before=True)
    step = F.col("value") - F.col("seen")
    trade = F.when(F.col("seen").isNull(), "FIRST").when(step == 1, "IN_ORDER").when(step > 1, "GAP").otherwise("DUPLICATE")
    verdict = F.when(is_trade, trade).when(step > 0, "HEARTBEAT_GAP").otherwise("HEARTBEAT_OK")
    missing = F.when(is_trade & (step > 1), step - 1).when(~is_trade & (step > 0), step).otherwise(0)
    return rows.withColumns({"continuity": verdict, "missing": missing}).drop("value")


def counters(classified: DataFrame) -> DataFrame:
    """Totals per product: gaps, lost messages, duplicates, gaps that only heartbeats showed."""
    return classified.groupBy("product_id").agg(
        F.count_if(F.col("continuity") == "GAP").alias("sequence_gaps_total"),
        F.sum("missing").alias("messages_lost_total"),
        F.count_if(F.col("continuity") == "DUPLICATE").alias("duplicates_total"),
        F.count_if(F.col("continuity") == "HEARTBEAT_GAP").alias("heartbeat_detected_gaps_total"),
    )


def envelopes(messages: DataFrame, received_at: str = "received_at") -> dict[str, DataFrame]:
    """Raw rows per channel, as a collector would publish them. Types it doesn't know are left
    out; copies stay, for staging to count and drop."""
    from tapeworks import schemas
    from tapeworks.functions.timing import instant, iso_millis

    arrived = iso_millis(F.col(received_at))
    moment = F.coalesce(iso_millis(instant(F.col("time"))), arrived)
    empty = lambda c: F.coalesce(F.col(c), F.lit(""))
    trades = messages.where(F.col("type").isin(*TRADE_TYPES)).select(
        "sequence", "product_id", "trade_id", "price", "size", "side", empty("maker_order_id").alias("maker_order_id"), empty("taker_order_id").alias("taker_order_id"),
        moment.alias("event_time"), arrived.alias("ingest_time"),
    )
    snapshot = F.col("type") == "snapshot"
    payload = F.when(snapshot, F.to_json(F.struct("bids", "asks"))).otherwise(F.to_json(F.struct("changes")))
    l2 = messages.where(F.col("type").isin("snapshot", "l2update")).select(
        F.coalesce("sequence", F.lit(0)).alias("sequence"), "product_id", F.col("type").alias("event_type"), payload.alias("payload"),
        # snapshots carry no exchange time
        F.when(snapshot, arrived).otherwise(moment).alias("event_time"), arrived.alias("ingest_time"),
    )
    beats = messages.where(F.col("type") == "heartbeat").select("sequence", "product_id", F.coalesce("last_trade_id", F.lit(0)).alias("last_trade_id"), moment.alias("event_time"), arrived.alias("ingest_time"))
    return {"trades": trades.to(schemas.TRADES), "l2": l2.to(schemas.L2), "heartbeat": beats.to(schemas.HEARTBEAT)}
