"""Windows over long orders, cut into cells so that one key's rows are many tasks' work.

A window over a product alone is one task a product. Here rows are dealt by (keys, cell), where
cells follow the order (an hour, a range of ids); what a cell needs of those before it is one row
a cell, aggregated on the map side, run over in a window of cells and joined back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _bordered(rows: DataFrame, keys: list[str], cell: Column, summary: Column, carry) -> DataFrame:
    """``rows`` with _cell, and _border: what ``carry`` makes of the summaries of a key's cells."""
    marked = rows.withColumn("_cell", cell)
    cells = marked.groupBy(*keys, "_cell").agg(summary.alias("_sum"))
    by_cell = Window.partitionBy(*keys).orderBy("_cell")
    borders = cells.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_cell").alias("_at"), carry(F.col("_sum"), by_cell).alias("_border"))
    match = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    # cells without a border stay: the join is outer for nothing but null keys' sake
    return marked.join(borders, [*match, F.col("_cell").eqNullSafe(F.col("_at"))], "left").drop("_at", *[f"_k{i}" for i in range(len(keys))])


def neighbour(rows: DataFrame, keys: list[str], order: Column, cell: Column, value: Column, name: str, ahead: bool = False) -> DataFrame:
    """``rows`` with ``value`` of the row before (or after, if ``ahead``) in ``order`` within keys.

    ``cell`` must not fall as ``order`` grows. As ``lag`` and ``lead`` do, the first (last) row gets null.
    """
    boxed = F.struct(value.alias("v"))
    if ahead:
        marked = _bordered(rows, keys, cell, F.min_by(boxed, order), lambda s, w: F.lead(s).over(w))
        inside = F.lead(boxed).over(Window.partitionBy(*keys, "_cell").orderBy(order))
    else:
        marked = _bordered(rows, keys, cell, F.max_by(boxed, order), lambda s, w: F.lag(s).over(w))
        inside = F.lag(boxed).over(Window.partitionBy(*keys, "_cell").orderBy(order))
    return marked.withColumn(name, F.coalesce(inside, F.col("_border"))["v"]).drop("_cell", "_border")


def running(rows: DataFrame, keys: list[str], order: Column, cell: Column, value: Column, name: str, how: str = "sum", before: bool = False) -> DataFrame:
    """``rows`` with the running sum or max of ``value``, ties of ``order`` included; or, with ``before``,
    that of the rows before each, where ``order`` has no ties."""
    total, join = {"sum": (F.sum, lambda a, b: F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a + b)), "max": (F.max, F.greatest)}[how]
    until = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    marked = _bordered(rows, keys, cell, total(value), lambda s, w: total(s).over(until(w)))
    inside = Window.partitionBy(*keys, "_cell").orderBy(order)
    return marked.withColumn(name, join(F.col("_border"), total(value).over(until(inside) if before else inside))).drop("_cell", "_border")
