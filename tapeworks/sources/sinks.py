"""Writing: contracts, idempotent partitions, the lake, quarantine, and where things go."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeworks import config, schemas
from tapeworks.functions.timing import within_lookback


class ContractError(ValueError):
    pass


def check_contract(df: DataFrame, name: str) -> DataFrame:
    """``df`` with the declared names, order and types, whose required columns fail the job that
    meets a null: the check runs within the write, before anything is committed."""
    schema, required = schemas.contract(name)
    have, want = [(f.name, f.dataType.simpleString()) for f in df.schema], [(f.name, f.dataType.simpleString()) for f in schema]
    if have != want:
        raise ContractError(f"{name}: schema is {sorted(set(have) - set(want))}, declared is {sorted(set(want) - set(have))}")
    never = {c: F.coalesce(F.col(c), F.raise_error(F.lit(f"{_NULL}{name}: nulls in {c}")).cast(schema[c].dataType)) for c in required}
    return df.withColumns(never)


_NULL = "contract of "


def _keeping_contract(write: Callable[[], None]) -> None:
    """Run a write; a null that the contract forbids is a ContractError."""
    try:
        write()
    except Exception as e:
        if (at := str(e).find(_NULL)) >= 0:
            raise ContractError(str(e)[at + len(_NULL) :].splitlines()[0]) from None
        raise


def fail_on_schema_change(df: DataFrame, path: str) -> None:
    """An incremental table keeps its columns: what is there must match what comes."""
    spark = df.sparkSession
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        return
    old = {f.name: f.dataType.simpleString() for f in spark.read.parquet(path).schema}
    new = {f.name: f.dataType.simpleString() for f in df.schema}
    if old != new:
        raise ContractError(f"schema of {path} would change: {sorted(set(old.items()) ^ set(new.items()))}")


def write_incremental(df: DataFrame, path: str, as_of, lookback: int | None = config.LOOKBACK_DAYS, contract: str | None = None, partition: str = "event_date", order: str = "product_id") -> None:
    """Replace the partitions within the lookback; days outside it survive. ``lookback=None`` writes all."""
    if lookback is not None:
        df = df.where(within_lookback(F.col(partition), F.lit(as_of).cast("timestamp"), lookback))
    if contract:
        df = check_contract(df, contract)
    fail_on_schema_change(df, path)
    # a day goes to as many tasks as its size asks for
    dealt = df.hint("rebalance", partition).sortWithinPartitions(partition, order)
    _keeping_contract(lambda: dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path))


def rebuild(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def append_strict(df: DataFrame, path: str, channel: str) -> None:
    """Append to a typed raw table; a column that the schema doesn't know fails."""
    if unknown := set(df.columns) - set(schemas.RAW[channel].names):
        raise ContractError(f"unknown fields: {sorted(unknown)}")
    df.to(schemas.RAW[channel]).write.mode("append").parquet(path)


def write_lake(messages: DataFrame, path: str, subscription: str) -> None:
    """Envelopes of JSON bodies, under one folder per arrival day. messages: body, message_id, publish_time."""
    envelope = messages.select(
        F.lit(subscription).alias("subscription_name"), "message_id", "publish_time", F.encode("body", "UTF-8").alias("data"), F.lit("{}").alias("attributes"), F.to_date("publish_time").alias("dt")
    )
    envelope.write.mode("append").partitionBy("dt").parquet(path)


def split_valid(lines: DataFrame, schema: T.StructType, required: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(valid rows, dead letters) of a column ``value`` of JSON. What doesn't parse, or lacks a
    required field, is kept whole with the reason, for a person to look at."""
    full = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    parsed = lines.select("value", F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}).alias("m"))
    broken = F.col("m").isNull() | F.col("m._corrupt_record").isNotNull()
    lacking = F.lit(False)
    for c in required:
        lacking = lacking | F.col(f"m.{c}").isNull()
    reason = F.when(broken, "not parsed").when(lacking, "field missing")
    return parsed.where(reason.isNull()).select("m.*").drop("_corrupt_record"), parsed.where(reason.isNotNull()).select("value", reason.alias("reason"))


def layer_path(root: str, layer: str, env: str) -> str:
    """Layers keep their own names everywhere but in ci, where all share one folder."""
    return f"{root}/ci" if env == "ci" else f"{root}/{layer}"


def expired_days(days: list[date], today: date, keep: int) -> list[date]:
    """Which day partitions are past retention."""
    return sorted(d for d in days if d < today - timedelta(days=keep))


def expire(spark: SparkSession, path: str, today: date, keep: int, partition: str = "event_date", archive: str | None = None) -> list[date]:
    """Delete the day folders of a table that are past retention, or move them to ``archive``, a cheaper
    tier with a retention of its own. Returns the days that went."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder = lambda *parts: jvm.org.apache.hadoop.fs.Path("/".join(parts))
    files = folder(path).getFileSystem(conf)
    if not files.exists(folder(path)):
        return []
    names = [status.getPath().getName() for status in files.listStatus(folder(path))]
    days = {date.fromisoformat(n.partition("=")[2]): n for n in names if n.startswith(f"{partition}=") and not n.endswith("__HIVE_DEFAULT_PARTITION__")}
    gone = expired_days(list(days), today, keep)
    for day in gone:
        if archive is None:
            files.delete(folder(path, days[day]), True)
        else:
            files.mkdirs(folder(archive))
            if not files.rename(folder(path, days[day]), folder(archive, days[day])):
                raise OSError(f"{days[day]} could not be moved to {archive}")
    return gone


def quarantine(lines: DataFrame, path: str, schema: T.StructType, required: tuple[str, ...] = (), attempts: int = config.DELIVERY_ATTEMPTS) -> DataFrame:
    """Valid rows of ``lines(value[, attempt])``. Dead letters, and valid ones that failed to be delivered
    ``attempts`` times, are appended under ``path`` whole, with the reason."""
    tries = F.col("attempt") if "attempt" in lines.columns else F.lit(1)
    marked = lines.withColumn("_spent", tries > attempts)
    good, bad = split_valid(marked.where(~F.col("_spent")), schema, required)
    spent = marked.where("_spent").select("value", F.lit("attempts spent").alias("reason"))
    bad.unionByName(spent).withColumn("dead_at", F.current_timestamp()).write.mode("append").parquet(path)
    return good
