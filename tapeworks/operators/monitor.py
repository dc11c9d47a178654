"""Monitoring over event time: rates and alerts on a full time grid, stalls, lag percentiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeworks import config
from tapeworks.functions.frames import neighbour


def channel_counts(messages: DataFrame, channel: str = "channel") -> DataFrame:
    return messages.groupBy(channel).agg(F.count(F.lit(1)).alias("messages_received"))


def on_grid(points: DataFrame, seconds: int, label: str, ts: str = "ts", value: Column | None = None) -> DataFrame:
    """Sum of ``value`` (default: a count) per label and bucket; buckets without rows are 0,
    since missing data must be able to raise an alert."""
    start = F.timestamp_seconds(F.floor(F.unix_seconds(ts) / F.lit(seconds)) * F.lit(seconds))
    sums = points.groupBy(F.col(label).alias("label"), start.alias("bucket")).agg(F.sum(value if value is not None else F.lit(1)).alias("total"))
    span = points.agg(F.min(start).alias("a"), F.max(start).alias("b"))
    labels = points.select(F.col(label).alias("label")).distinct()
    # one span row for all labels
    grid = labels.join(F.broadcast(span), F.lit(True)).select("label", F.explode(F.sequence("a", "b", F.make_dt_interval(secs=F.lit(seconds)))).alias("bucket"))
    return grid.join(sums, ["label", "bucket"], "left").select("label", "bucket", F.coalesce("total", F.lit(0)).alias("total"))


def alerts(grid: DataFrame, above: float | None = None, below: float | None = None) -> DataFrame:
    """Buckets whose total is above or below the threshold."""
    fires = F.lit(False)
    if above is not None:
        fires = fires | (F.col("total") > above)
    if below is not None:
        fires = fires | (F.col("total") < below)
    return grid.withColumn("fires", fires)


#: name -> (bucket seconds, above, below)
ALERTS = {"no_publishes": (300, None, 1), "crossed_book": (300, 0, None), "sequence_gaps": (3600, 5, None), "publish_failures": (300, 0, None), "reconnects": (900, 10, None), "consumer_absent": (600, None, 1)}


def evaluate(points: DataFrame, rules: dict[str, tuple[int, float | None, float | None]] = ALERTS) -> DataFrame:
    """(alert, bucket, total) of every window in which a rule fires, by points (ts, name, value). The windows
    run over the span of all points, so a metric that has none is silent and can fire."""
    span = points.agg(F.unix_seconds(F.min("ts")).alias("a"), F.unix_seconds(F.max("ts")).alias("z"))
    table = [(name, seconds, None if above is None else float(above), None if below is None else float(below)) for name, (seconds, above, below) in rules.items()]
    known = points.sparkSession.createDataFrame(table, "name string, seconds bigint, above double, below double")
    start = lambda c: F.floor(c / F.col("seconds")) * F.col("seconds")
    # one row of span, and a row for each rule
    grid = F.broadcast(known).join(F.broadcast(span), F.lit(True)).select("name", "above", "below", F.explode(F.sequence(start(F.col("a")), start(F.col("z")), F.col("seconds"))).alias("at"))
    sums = points.join(F.broadcast(known), "name").groupBy("name", start(F.unix_seconds("ts")).alias("at")).agg(F.sum("value").alias("total"))
    filled = grid.join(sums, ["name", "at"], "left").withColumn("total", F.coalesce("total", F.lit(0)))
    fires = F.coalesce(F.col("total") > F.col("above"), F.lit(False)) | F.coalesce(F.col("total") < F.col("below"), F.lit(False))
    return filled.where(fires).select(F.col("name").alias("alert"), F.timestamp_seconds("at").alias("bucket"), "total")


def rate_per_minute(grid: DataFrame, seconds: int) -> DataFrame:
    """Rates per label, and the highest label of each bucket."""
    rates = grid.withColumn("per_minute", F.col("total") * 60.0 / seconds)
    return rates.groupBy("bucket").agg(F.sum("per_minute").alias("all_labels"), F.max("per_minute").alias("busiest"))


def stalls(beats: DataFrame, timeout: int = config.HEARTBEAT_TIMEOUT_SECONDS, key: str = "product_id", ts: str = "ingest_time") -> DataFrame:
    """Silences longer than ``timeout`` seconds between neighbouring beats."""
    followed = neighbour(beats.select(key, ts), [key], F.col(ts), F.date_trunc("DAY", ts), F.col(ts), "silent_from")
    rows = followed.select(key, "silent_from", F.col(ts).alias("silent_to"))
    seconds = (F.unix_micros("silent_to") - F.unix_micros("silent_from")) / 1e6
    return rows.withColumn("seconds", seconds).where(F.col("seconds") > timeout)


def lag_percentiles(rows: DataFrame, lag: str = "ingest_lag_ms", key: str | None = None) -> DataFrame:
    """p50, p95 and p99 by rank floor(n * p), at most n - 1, of the sorted lags: exact. Equal lags
    are counted on the map side first, so a key's window runs over its different lags only."""
    keyed = rows.where(F.col(lag).isNotNull()).select((F.col(key) if key else F.lit(0)).alias("_key"), F.col(lag).alias("_lag"))
    counted = keyed.groupBy("_key", "_lag").agg(F.count(F.lit(1)).alias("_n"))
    part = Window.partitionBy("_key")
    ranked = counted.withColumn("upto", F.sum("_n").over(part.orderBy("_lag"))).withColumn("n", F.sum("_n").over(part))
    # the lag of rank r is the least one that more than r rows reach
    pick = lambda p: F.min(F.when(F.col("upto") > F.least(F.floor(F.col("n") * p), F.col("n") - 1), F.col("_lag")))
    found = [pick(p).alias(f"p{round(100 * p)}") for p in (0.5, 0.95, 0.99)]
    return ranked.groupBy(F.col("_key").alias(key)).agg(*found) if key else ranked.groupBy().agg(*found)


def log_counters(logs: DataFrame, rules: dict[str, tuple[str, str]]) -> DataFrame:
    """How many log lines match each named (logger, message) rule."""
    return logs.groupBy().agg(*[F.count_if((F.col("logger") == a) & (F.col("message") == b)).alias(name) for name, (a, b) in rules.items()])
