"""Sharding by sampled splitters: near-equal bytes per shard, in key order.

The key of a row is (hash of its text, hash of its doc_id, a tie-break), so equal texts stand
together and a group of copies larger than a range is still divided, by doc_id, and rows equal in both
by the tie-break, which tells nothing in the result apart. A size-weighted sample of keys gives
quantile splitters; each record falls into the range between two of them, found through a
broadcast table of the splitters by the first bits of the key.
The exact bytes of every range are then summed, and a range that holds a shard border
(an overfull one) is subdivided at exactly that byte by a running sum inside the range.
Only ranges, a table of at most ``MOST_RANGES``, and ``OVERSAMPLE`` keys a range meet at one place.

Defined results: a null text counts as the empty one and is given no bytes besides
``overhead``; a null doc_id sorts first; repeated rows each get their own slot; an empty
table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapeworks.llm.common import cut, table

SHARDS = 24
#: At least so many ranges for each shard, and so many rows for a range at most, about.
RANGES_PER_SHARD = 16
ROWS_PER_RANGE = 500_000
MOST_RANGES = 100_000
#: Sampled keys for each splitter.
OVERSAMPLE = 8
#: Splitters are looked up by so many first bits of the key.
HEAD_BITS = 12


def _head(key: Column) -> Column:
    return F.shiftright(key, 64 - HEAD_BITS).cast("int")


def splitters(keys: DataFrame, ranges: int, total: int) -> DataFrame:
    """Quantile boundaries (key, tie) of ``keys(key, tie, size)`` weighted by size; at most ``ranges - 1``.

    A row is drawn with probability size / (total / wanted), by a hash of its key rather
    than by chance, so a lost task draws the same rows again. Rows of more than that share are drawn
    as often as they hold it.
    """
    wanted = ranges * OVERSAMPLE
    share = F.col("size") * F.lit(wanted / max(1, total))
    unit = F.pmod(F.xxhash64("key", "tie", F.lit("draw")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    times = (F.floor(share) + F.when(unit < share - F.floor(share), 1).otherwise(0)).cast("int")
    drawn = keys.withColumn("times", times).where("times > 0").select("key", "tie", "times")
    # the sample is about ranges * OVERSAMPLE keys, whatever the table's size
    upto = F.sum("times").over(Window.orderBy("key", "tie").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    every = F.sum("times").over(Window.partitionBy())
    at = drawn.withColumn("upto", upto).withColumn("every", every)
    quantile = lambda n: F.floor(n * F.lit(ranges) / F.col("every"))
    return at.where((quantile(F.col("upto")) > quantile(F.col("upto") - F.col("times"))) & (F.col("upto") < F.col("every"))).select("key", "tie").distinct()


def _with_range(rows: DataFrame, borders: DataFrame) -> DataFrame:
    """``rows`` with ``range``, the number of borders <= (key, tie). Borders are looked up by the
    first bits of the key, so few of them are compared."""
    numbered = borders.withColumn("at", F.row_number().over(Window.orderBy("key", "tie")) - 1).withColumn("head", _head(F.col("key")))
    heads = numbered.groupBy("head").agg(F.min("at").alias("before"), F.sort_array(F.collect_list(F.struct("key", "tie"))).alias("borders"))
    # heads without a border take the number of those below the next lower one that has any
    last = Window.orderBy("head").rowsBetween(Window.unboundedPreceding, -1)
    every = rows.sparkSession.range(-(1 << (HEAD_BITS - 1)), 1 << (HEAD_BITS - 1)).select(F.col("id").cast("int").alias("head"))
    known = every.join(F.broadcast(heads), "head", "left")
    below = F.coalesce(F.sum(F.coalesce(F.size("borders"), F.lit(0))).over(last), F.lit(0))
    # 2 ** HEAD_BITS rows
    lookup = cut(known.select("head", below.alias("below"), F.coalesce("borders", F.array().cast("array<struct<key:bigint,tie:bigint>>")).alias("borders")), "splitters")
    of_row = rows.withColumn("head", _head(F.col("key"))).join(F.broadcast(lookup), "head")
    passed = F.size(F.filter("borders", lambda b: (b["key"] < F.col("key")) | ((b["key"] == F.col("key")) & (b["tie"] <= F.col("tie")))))
    return of_row.withColumn("range", (F.col("below") + passed).cast("long")).drop("head", "below", "borders")


def shard_by_bytes(docs: DataFrame, shards: int = SHARDS, overhead: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Assign every row a shard 0..shards-1 and a gapless slot in it, in key order.

    Returns (id, size, text_crc32, shard, slot, grown_shard). A row belongs to the shard in
    which the middle of its bytes falls, so shards differ by about one row's size.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    # the hash goes into the high bits and doc_id into the low ones: one long orders by both
    grouped = F.shiftleft(F.shiftright(F.xxhash64(text), 24), 24)
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + F.lit(overhead)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        (grouped.bitwiseOR(F.pmod(F.xxhash64(F.col(id_col)), F.lit(1 << 24)))).alias("key"),
        F.xxhash64(F.monotonically_increasing_id()).alias("tie"),
    )
    rows = cut(rows, "sizes")  # where the tie-breaks are fixed
    n, total = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    ranges = min(MOST_RANGES, max(RANGES_PER_SHARD * shards, -(-n // ROWS_PER_RANGE)))
    placed = _with_range(rows, splitters(rows, ranges, total))
    sums = placed.groupBy("range").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    # a table of at most `ranges` + 1 rows
    order = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut(
        sums.select("range", F.coalesce(F.sum("bytes").over(order), F.lit(0)).alias("bytes_before"), F.coalesce(F.sum("n").over(order), F.lit(0)).alias("rows_before")),
        "ranges",
    )
    within = Window.partitionBy("range").orderBy("key", "tie", F.col("doc_id").asc_nulls_first())
    running = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = (
        placed.withColumn("upto", F.sum("size").over(running))
        .withColumn("nth", F.row_number().over(within).cast("long"))
        .join(F.broadcast(offsets), "range")
        .withColumn("middle2", 2 * (F.col("bytes_before") + F.col("upto")) - F.col("size"))
        .withColumn("rank", F.col("rows_before") + F.col("nth") - 1)
        .withColumn("shard", F.least(F.expr(f"cast(cast(middle2 as decimal(38,0)) * {shards} div {2 * max(1, total)} as int)"), F.lit(shards - 1)))
        .select("doc_id", "size", "text_crc32", "shard", "rank")
    )
    ranked = cut(ranked, "ranks")
    first = ranked.groupBy("shard").agg(F.min("rank").alias("first_rank"))
    return ranked.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("rank") - F.col("first_rank")).alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_bytes(table(spark, sf_dir, "documents"))
