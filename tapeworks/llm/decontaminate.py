"""Benchmark decontamination by winnowing.

Words are lower-cased in A-Z. Every window of ``window`` words keeps the smallest of its
``window - gram + 1`` word-gram hashes, so any shared span of ``window`` words has the same
fingerprint on both sides: none can be missed. Training fingerprints are joined with those of
the benchmark, and a hit is extended to its window, whose words must be equal. An item
shorter than a window, but not empty, is one window of its own length.

All window lengths go through one scan. The benchmark's fingerprints are broadcast only up to
``BROADCAST_ROWS`` of them (counted first), and nothing but hits leaves the scan. Beyond that, windows
are shuffled as numbers only (row, place, length, fingerprint), and the words of those that meet are
fetched afterwards.

Defined results: null and empty texts have no words and no hits; repeated rows get equal
results (rows are told apart by doc_id and text); an empty benchmark or document table is
fine; item ids that are null count as hits but are in no item list; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapeworks.llm.common import cut, table

WINDOW = 10
GRAM = 6
BROADCAST_ROWS = 1_000_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Fixed by the contract: what is not a word, before and after lower-casing.
_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Array of lower-cased words; empty for a null text."""
    text = F.coalesce(text, F.lit(""))
    # lower() is right and fast for ASCII; elsewhere only A-Z may change
    lower = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.array_remove(F.split(lower, _GAP), "")


def _gram(h: Column, at: Column, n: int) -> Column:
    return F.xxhash64(*[F.get(h, at + F.lit(t)) for t in range(n)])


def _least(parts: list[Column]) -> Column:
    return parts[0] if len(parts) == 1 else F.least(*parts)


def windows(rows: DataFrame, keys: list[str], window: int, gram: int, sizes: list[int]) -> DataFrame:
    """(keys, words, at, n, fp) for every window of every length in ``sizes``; rows have keys and words.
    Windows shorter than ``window`` are one gram each."""
    hashed = rows.where(F.size("words") >= min(sizes)).select(*keys, "words", F.transform("words", lambda w: F.xxhash64(w)).alias("h"))
    placed = hashed.select(*keys, "words", "h", F.explode(F.sequence(F.lit(0), F.size("h") - F.lit(min(sizes)))).alias("at"))
    least = _least([_gram(F.col("h"), F.col("at") + F.lit(t), gram) for t in range(window - gram + 1)])
    prints = [F.struct(F.lit(n).alias("n"), (least if n == window else _gram(F.col("h"), F.col("at"), n)).alias("fp")) for n in sizes]
    if len(sizes) == 1:
        return placed.select(*keys, "words", "at", F.lit(window).alias("n"), least.alias("fp"))
    each = placed.select(*keys, "words", "at", F.size("h").alias("size"), F.inline(F.array(*prints)))
    return each.where("at + n <= size").drop("size")


def _text(n: Column) -> Column:
    return F.array_join(F.slice("words", F.col("at") + 1, n), " ")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, text_hash."""
    items = cut(benchmark.select("item_id", words_of(F.col("text")).alias("words")).where(F.size("words") > 0), "items")
    short = sorted(r[0] for r in items.where(F.size("words") < window).select(F.size("words")).distinct().collect())
    sizes = [window, *short]

    own = windows(items, ["item_id"], window, gram, sizes).where(F.col("n") == F.least(F.size("words"), F.lit(window)))
    targets = cut(own.select("item_id", "n", "fp", _text(F.col("n")).alias("span")).distinct(), "targets")
    spans = targets.select("n", "span").distinct()
    prints = targets.select("n", "fp").distinct()
    small = prints.count() <= BROADCAST_ROWS

    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), words_of(F.col(text_col)).alias("words"))
    keys = ["doc_id", "text_hash"]
    mine = windows(rows, keys, window, gram, sizes)
    if small:
        found = mine.join(F.broadcast(prints), ["n", "fp"], "left_semi")
    else:
        places = mine.select(*keys, "at", "n", "fp").join(prints, ["n", "fp"], "left_semi").select(*keys, "at", "n")
        of_doc = cut(places.groupBy(*keys).agg(F.collect_set(F.struct("at", "n")).alias("places")).withColumnsRenamed({"doc_id": "d", "text_hash": "t"}), "places")
        few = of_doc.count() <= BROADCAST_ROWS
        met = rows.join(F.broadcast(of_doc) if few else of_doc, [F.col("doc_id").eqNullSafe(F.col("d")), F.col("text_hash") == F.col("t")])
        found = met.select(*keys, "words", F.inline("places"))
    hits = found.select(*keys, "at", "n", _text(F.col("n")).alias("span"))
    hits = cut(hits.join(F.broadcast(spans) if small else spans, ["n", "span"]).distinct(), "hits")

    order = Window.partitionBy(*keys).orderBy("at", "n")
    before = F.max(F.col("at") + F.col("n")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.col("at") + F.col("n") - F.greatest(F.col("at"), F.coalesce(before, F.lit(0)))
    covered = hits.withColumn("fresh", F.greatest(fresh, F.lit(0))).groupBy(*keys).agg(F.sum("fresh").alias("n_hit"))
    pairs = hits.select(*keys, "n", "span").distinct().join(targets.select("item_id", "n", "span").distinct(), ["n", "span"]).select(*keys, "item_id").distinct()
    named = pairs.groupBy(*keys).agg(F.count("item_id").alias("n_items"), F.array_sort(F.collect_list(F.col("item_id").cast("string"))).alias("items"))
    marks = covered.join(named, [covered["doc_id"].eqNullSafe(named["doc_id"]), covered["text_hash"] == named["text_hash"]], "left").select(
        covered["doc_id"].alias("d"), covered["text_hash"].alias("t"), "n_hit", "n_items", "items"
    )
    every = docs.select(
        F.col(id_col).alias("doc_id"),
        F.xxhash64(text_col).alias("text_hash"),
        F.size(F.array_remove(F.split(F.coalesce(F.col(text_col), F.lit("")), _GAP), "")).cast("long").alias("n_words"),
    )
    return every.join(marks, [every["doc_id"].eqNullSafe(marks["d"]), every["text_hash"] == marks["t"]], "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.coalesce("items", F.array().cast("array<string>")), ","), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        "text_hash",
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold any window of the benchmark; all columns stay."""
    bad = cut(contamination(docs, benchmark).where("contaminated").select(F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash")).distinct(), "contaminated")
    few = bad.count() <= BROADCAST_ROWS
    return docs.join(F.broadcast(bad) if few else bad, [docs["doc_id"].eqNullSafe(bad["_doc"]), F.xxhash64(docs["text"]) == bad["_hash"]], "left_anti")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_hash")


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS span
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM bw), dw AS (
  SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS span
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)
), hits AS (SELECT DISTINCT dw.doc_id, dw.n, dw.i, bw.item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.span = bw.span),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items FROM (SELECT DISTINCT doc_id, cast(item_id AS VARCHAR) AS s FROM hits) GROUP BY doc_id)
SELECT d.doc_id, cast(len(d.w) AS BIGINT) AS n_words, cast(coalesce(n_hit, 0) AS BIGINT) AS n_hit, cast(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""
