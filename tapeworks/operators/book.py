"""Order book per minute from level changes, and what it says about liquidity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeworks import config
from tapeworks.functions.frames import running
from tapeworks.functions.numeric import div9, half, mul9, times
from tapeworks.functions.timing import day

def _state_order() -> Column:
    """What came last on a level: snapshots before deltas, then exchange time, then place in the
    message; the message id settles what the others leave open."""
    return F.struct((F.col("event_type") != "snapshot").alias("a"), F.col("event_time").alias("b"), F.col("change_index").alias("c"), F.coalesce("message_id", F.lit("")).alias("d"))


def snapshot_mids(events: DataFrame) -> DataFrame:
    """(product_id, snapshot_time, mid) of every snapshot that has both sides."""
    at = events.where((F.col("event_type") == "snapshot") & (F.col("size") > 0)).groupBy("product_id", F.col("ingest_time").alias("snapshot_time"))
    mids = at.agg(half(F.min(F.when(F.col("side") == "sell", F.col("price"))) + F.max(F.when(F.col("side") == "buy", F.col("price")))).alias("mid"))
    return mids.where(F.col("mid").isNotNull())


def with_snapshot_time(events: DataFrame) -> DataFrame:
    """Every event with the arrival of the last snapshot at or before it, null before the first.

    Rows are dealt by product and hour; an hour gets the last snapshot of those before it."""
    taken = F.when(F.col("event_type") == "snapshot", F.col("ingest_time"))
    return running(events, ["product_id"], F.col("ingest_time"), F.date_trunc("HOUR", "ingest_time"), taken, "snapshot_time", "max")


def carry_forward(states: DataFrame, within: list[str], level: list[str]) -> DataFrame:
    """Level sizes at every minute of ``within`` that has any state: the last at or before it.

    states: within, level, minute, size (one row each). A state holds from its minute to the
    level's next one; sizes of 0 end a level and are not carried. The active minutes of a group
    are numbered, so a state's stay is a range of numbers: it makes exactly the rows it
    holds for, and no row is joined with a minute it doesn't hold for."""
    of_group = Window.partitionBy(*within)
    grid = states.select(*within, "minute").distinct()
    grid = grid.withColumns({"_at": F.row_number().over(of_group.orderBy("minute")), "_end": F.count(F.lit(1)).over(of_group).cast("int") + 1})
    until = F.lead("_at").over(Window.partitionBy(*within, *level).orderBy("_at"))
    held = states.join(grid, [*within, "minute"]).withColumn("_until", F.coalesce(until, F.col("_end"))).where("size > 0").drop("minute", "_end")
    each = held.withColumn("_at", F.explode(F.sequence("_at", F.col("_until") - 1))).drop("_until")
    return each.join(grid.select(*within, "_at", F.col("minute").alias("event_minute")), [*within, "_at"]).drop("_at")


def book_state(events: DataFrame, latest_only: bool = False, band: str = config.PRUNE_BAND) -> DataFrame:
    """State of every level near the snapshot's mid at the end of each active minute.

    A snapshot starts an epoch and clears the book; only its own epoch's events follow it.
    ``latest_only`` keeps just the epoch of the last snapshot. Each event meets one epoch, that of
    the last snapshot before it, found by a running maximum and not by a range join.
    """
    if "message_id" not in events.columns:
        events = events.withColumn("message_id", F.lit(""))
    placed = with_snapshot_time(events.select("product_id", "event_type", "side", "price", "size", "event_time", "ingest_time", "change_index", "message_id"))
    if latest_only:
        last = events.where(F.col("event_type") == "snapshot").groupBy("product_id").agg(F.max("ingest_time").alias("snapshot_time"))
        placed = placed.join(last, ["product_id", "snapshot_time"], "left_semi")
    near = F.abs(F.col("price") - F.col("mid")) <= times(F.col("mid"), band)
    relevant = placed.join(snapshot_mids(events), ["product_id", "snapshot_time"]).where(near).withColumn("minute", F.date_trunc("MINUTE", "ingest_time"))
    by_minute = relevant.groupBy("product_id", "snapshot_time", "side", "price", "minute").agg(F.max_by("size", _state_order()).alias("size"))
    carried = carry_forward(by_minute, ["product_id", "snapshot_time"], ["side", "price"])
    if not latest_only:
        # a minute with two snapshots belongs to the later one
        last = F.max("snapshot_time").over(Window.partitionBy("product_id", "event_minute"))
        carried = carried.withColumn("_last", last).where("snapshot_time = _last")
    return carried.select("product_id", "event_minute", "side", "price", "size", day(F.col("event_minute")).alias("event_date"))


def liquidity(book: DataFrame, bands: tuple[int, ...] = config.DEPTH_BANDS_BPS) -> DataFrame:
    """Top of book, spread and depth around the mid, for minutes with both sides."""
    buy, sell = F.col("side") == "buy", F.col("side") == "sell"
    top = book.groupBy("product_id", "event_minute", "event_date").agg(F.max(F.when(buy, F.col("price"))).alias("best_bid"), F.min(F.when(sell, F.col("price"))).alias("best_ask"))
    quoted = top.where("best_bid is not null and best_ask is not null").withColumns({"mid": half(F.col("best_bid") + F.col("best_ask")), "spread": (F.col("best_ask") - F.col("best_bid")).cast("decimal(38,9)")})
    joined = book.join(quoted.select("product_id", "event_minute", "mid"), ["product_id", "event_minute"])

    def depth(side: Column, inside: Column) -> Column:
        return F.sum(F.when(side & inside, F.col("size")).otherwise(0)).cast("decimal(38,9)")

    sums = [F.count(F.lit(1)).alias("book_levels")]
    for bps in bands:
        share = f"{bps / 10_000:.6f}"
        off = times(F.col("mid"), share)
        sums += [depth(buy, F.col("price") >= F.col("mid") - off).alias(f"bid_depth_{bps}bps"), depth(sell, F.col("price") <= F.col("mid") + off).alias(f"ask_depth_{bps}bps")]
    widest = max(bands)
    bid, ask = F.col(f"bid_depth_{widest}bps"), F.col(f"ask_depth_{widest}bps")
    return quoted.join(joined.groupBy("product_id", "event_minute").agg(*sums), ["product_id", "event_minute"]).select(
        "product_id",
        F.col("event_minute").alias("bar_start"),
        "best_bid",
        "best_ask",
        "mid",
        "spread",
        # the ratio is rounded to nine decimals before it becomes basis points
        (div9(F.col("spread"), F.col("mid")) * 10_000).cast("decimal(38,9)").alias("spread_bps"),
        *[f"{side}_depth_{bps}bps" for bps in bands for side in ("bid", "ask")],
        mul9(bid, F.col("mid")).alias(f"bid_depth_{widest}bps_notional"),
        mul9(ask, F.col("mid")).alias(f"ask_depth_{widest}bps_notional"),
        div9(bid - ask, bid + ask).alias("book_imbalance"),
        "book_levels",
        "event_date",
    )


def crossed(liquidity_rows: DataFrame) -> DataFrame:
    """Minutes whose bid is not below the ask."""
    return liquidity_rows.where((F.col("best_bid") >= F.col("best_ask")) | (F.col("spread") <= 0))
