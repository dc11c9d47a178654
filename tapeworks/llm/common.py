"""Helpers that several corpus operators share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Where this package lies, for Python workers that share the driver's disk (local mode); on a
#: cluster the package is shipped by --py-files.
_ROOT = str(Path(__file__).resolve().parents[2])


#: Texts a Python worker gets at once, unless the session says otherwise: batches of Spark's
#: default of 10,000 long texts would stay in both processes' pools.
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_DEFAULT, _FEWER = "10000", "1000"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.sparkContext.environment.setdefault("PYTHONPATH", _ROOT)
    if spark.conf.get(_BATCH, _DEFAULT) == _DEFAULT:
        spark.conf.set(_BATCH, _FEWER)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value evaluated once however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Only in local mode, where all share one disk, may it be unset.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        named = f"file://{tempfile.gettempdir()}/checkpoints"
    return named.rstrip("/")


def cut(df: DataFrame, tag: str = "cut", partition: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back; ``partition`` is a column to make folders of.

    The lineage ends there: a lost executor costs only a re-read.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tables/{tag}-{uuid.uuid4().hex}"
    (df.write.partitionBy(partition) if partition else df.write).parquet(path)
    _delete_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def _delete_at_exit(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)


def drop_cut(df: DataFrame) -> None:
    """Remove a table made by :func:`cut` that no later plan reads."""
    jvm = df.sparkSession.sparkContext._jvm
    for file in df.inputFiles()[:1]:
        folder = jvm.org.apache.hadoop.fs.Path(file).getParent()
        if "/tables/" in folder.toString():
            folder.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(src long, dst long)``.

    Alternating large-star and small-star contraction. Every step is an equi-join with
    one minimum per node, so no adjacency list is ever gathered; the edge set shrinks
    to one star per component. Returns ``(id, root)`` for every node that has an edge,
    root being the smallest id reachable. Nulls and self-loops are dropped.
    """
    pairs = (
        edges.where("src <> dst")
        .select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v"))
        .distinct()
    )
    pairs = cut(pairs, "edges")
    before = None
    while True:
        seen = pairs.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if before == tuple(seen):
            break
        before = tuple(seen)
        if not seen[0]:
            break
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small_low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(small_low, "u")
        small = (
            joined.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .where("u <> v")
            .distinct()
        )
        after = cut(small, "edges")
        drop_cut(pairs)
        pairs = after
    roots = pairs.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("root"))
    return roots.unionByName(pairs.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct())
