"""Realised volatility per hour from minute bars."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeworks import config
from tapeworks.functions.frames import neighbour
from tapeworks.functions.timing import day


def realized_vol(bars: DataFrame, seconds: int = 3600, per_year: int = config.MINUTES_PER_YEAR, since=None) -> DataFrame:
    """Close-to-close, Parkinson and Garman-Klass volatility per product and hour.

    Returns run on over hour borders. Read bars from before ``since`` (a date) too: their last
    one gives the first return, so an incremental run equals a full one.
    """
    x = {c: F.col(c).cast("double") for c in ("open", "high", "low", "close")}
    narrow = bars.select("product_id", "bar_start", "open", "high", "low", "close")
    followed = neighbour(narrow, ["product_id"], F.col("bar_start"), F.date_trunc("DAY", "bar_start"), x["close"], "before")
    rows = followed.select("product_id", "bar_start", F.ln(x["close"] / F.col("before")).alias("r"), F.ln(x["high"] / x["low"]).alias("hl"), F.ln(x["close"] / x["open"]).alias("co"))
    if since is not None:
        rows = rows.where(F.to_date("bar_start") >= F.lit(since))
    start = F.timestamp_seconds(F.floor(F.unix_seconds("bar_start") / F.lit(seconds)) * F.lit(seconds))
    grouped = rows.groupBy("product_id", start.alias("window_start")).agg(
        F.count(F.lit(1)).alias("bar_count"),
        F.stddev_samp("r").alias("vol_close_to_close"),
        F.avg(F.pow("hl", F.lit(2))).alias("hl2"),
        F.avg(0.5 * F.pow("hl", F.lit(2)) - (2 * math.log(2) - 1) * F.pow("co", F.lit(2))).alias("gk"),
    )
    parkinson = F.sqrt(F.col("hl2") / (4 * math.log(2)))
    annual = math.sqrt(per_year)
    return grouped.select(
        "product_id",
        "window_start",
        (F.col("window_start") + F.make_interval(secs=F.lit(seconds))).alias("window_end"),
        "bar_count",
        "vol_close_to_close",
        parkinson.alias("vol_parkinson"),
        F.when(F.col("gk").isNotNull(), F.sqrt(F.greatest("gk", F.lit(0.0)))).alias("vol_garman_klass"),
        (F.col("vol_close_to_close") * annual).alias("vol_close_to_close_annualised"),
        (parkinson * annual).alias("vol_parkinson_annualised"),
        day(F.col("window_start")).alias("event_date"),
    )
