"""Reconciliation of streaming bars with batch bars, with a reason for every difference."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeworks import config

#: Fixed texts, in order of evaluation.
REASONS = {
    "outside": "outside_run_window: the burst job was not running for this minute",
    "not_built": "batch_not_yet_built: streaming is ahead of the last dbt run",
    "missing": "missing_from_batch: BROKEN - streaming saw a window batch has no trades for",
    "startup": "partial_window_at_startup: job began mid-minute",
    "shutdown": "partial_window_at_shutdown: job was drained mid-minute",
    "late": "late_data_dropped: trades arrived after the 30s allowed lateness expired",
    "over": "over_count: BROKEN - likely accumulating panes summed instead of taking the final one",
    "agree": "agree",
}


def final_panes(panes: DataFrame) -> DataFrame:
    """The last pane of each window, with how many there were: panes restate, they don't add."""
    columns = [c for c in panes.columns if c not in ("product_id", "bar_start")]
    grouped = panes.groupBy("product_id", "bar_start").agg(
        F.max_by(F.struct(*columns), F.struct("pane_index", "written_at")).alias("last"), F.count(F.lit(1)).alias("pane_count"), F.max("pane_index").alias("final_pane_index")
    )
    return grouped.select("product_id", "bar_start", "last.*", "pane_count", "final_pane_index")


def reconcile(panes: DataFrame, batch: DataFrame, tolerance: str = config.VOLUME_TOLERANCE) -> DataFrame:
    """One row per product and minute that either side has."""
    stream = final_panes(panes)
    # one row per product each
    run = stream.groupBy("product_id").agg(F.min("bar_start").alias("first_window"), F.max("bar_start").alias("last_window"))
    frontier = batch.groupBy("product_id").agg(F.max("bar_start").alias("latest_built"))
    values = ["trade_count", "volume", "close", "vwap"]
    s = stream.select("product_id", "bar_start", *[F.col(v).alias(f"stream_{v}") for v in values], "pane_count", "final_pane_index", F.lit(True).alias("in_s"))
    b = batch.select("product_id", "bar_start", *[F.col(v).alias(f"batch_{v}") for v in values], F.lit(True).alias("in_b"))
    both = s.join(b, ["product_id", "bar_start"], "full").join(run, "product_id", "left").join(frontier, "product_id", "left")
    both = both.withColumns(
        {
            "in_stream": F.coalesce("in_s", F.lit(False)),
            "in_batch": F.coalesce("in_b", F.lit(False)),
            "is_first_window": F.col("bar_start") == F.col("first_window"),
            "is_last_window": F.col("bar_start") == F.col("last_window"),
            "at_batch_frontier": F.col("bar_start") >= F.col("latest_built"),
        }
    )
    fewer, more = F.col("stream_trade_count") < F.col("batch_trade_count"), F.col("stream_trade_count") > F.col("batch_trade_count")
    only_stream = F.col("in_stream") & ~F.col("in_batch")
    cases = [
        (~F.col("in_stream") & F.col("in_batch"), "outside"),
        (only_stream & F.col("at_batch_frontier"), "not_built"),
        (only_stream, "missing"),
        (F.col("is_first_window") & fewer, "startup"),
        (F.col("is_last_window") & fewer, "shutdown"),
        (fewer, "late"),
        (F.col("at_batch_frontier") & more, "not_built"),
        (more, "over"),
    ]
    reason = F.when(*[cases[0][0], F.lit(REASONS[cases[0][1]])])
    for condition, name in cases[1:]:
        reason = reason.when(condition, F.lit(REASONS[name]))
    same_count = F.col("stream_trade_count") == F.col("batch_trade_count")
    same_volume = F.abs(F.coalesce("stream_volume", F.lit(0)) - F.coalesce("batch_volume", F.lit(0))) < F.lit(tolerance).cast("decimal(38,9)")
    return both.select(
        "product_id",
        "bar_start",
        "in_stream",
        "in_batch",
        "stream_trade_count",
        "batch_trade_count",
        (F.coalesce("batch_trade_count", F.lit(0)) - F.coalesce("stream_trade_count", F.lit(0))).alias("trade_count_diff"),
        "stream_volume",
        "batch_volume",
        (F.coalesce("batch_volume", F.lit(0)) - F.coalesce("stream_volume", F.lit(0))).cast("decimal(38,9)").alias("volume_diff"),
        "stream_close",
        "batch_close",
        "stream_vwap",
        "batch_vwap",
        "pane_count",
        "final_pane_index",
        "is_first_window",
        "is_last_window",
        "at_batch_frontier",
        (F.coalesce("pane_count", F.lit(0)) > 1).alias("was_restated"),
        same_count.alias("counts_agree"),
        (same_count & same_volume & (F.col("stream_close") == F.col("batch_close"))).alias("bars_agree"),
        reason.otherwise(F.lit(REASONS["agree"])).alias("divergence_reason"),
        F.to_date("bar_start").alias("event_date"),
    )
