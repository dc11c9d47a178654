"""The batch graph: raw messages to marts, each a pure function of what lies below it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeworks import config, schemas
from tapeworks.functions.timing import within_lookback
from tapeworks.operators import bars, book, checks, quality, recon, staging, volatility
from tapeworks.sources.sinks import layer_path, rebuild, write_incremental


#: What a model is made of: raw inputs and models before it, by name.
Stored = dict[str, DataFrame]
Model = Callable[[Stored], DataFrame]


def plan(inputs: Stored, products: tuple[str, ...] | None = config.TRACKED_PRODUCTS, latest_book_only: bool = False) -> dict[str, Model]:
    """All models by name, in order. inputs: trades_raw, and l2_raw and panes where there are any."""
    models: dict[str, Model] = {
        "fct_trades": lambda t: staging.with_taker_side(staging.stage_trades(t["trades_raw"], products)),
        "fct_bars_1m": lambda t: bars.bars(t["fct_trades"], 60),
        "fct_bars_5m": lambda t: bars.roll_up(t["fct_bars_1m"], 300),
        "fct_bars_1h": lambda t: bars.roll_up(t["fct_bars_1m"], 3600),
        "fct_realized_vol": lambda t: volatility.realized_vol(t["fct_bars_1m"]),
        "fct_data_quality": lambda t: quality.data_quality(t["fct_trades"], staging.type_trades(t["trades_raw"], products)),
    }
    if inputs.get("l2_raw") is not None:
        models["int_book_state_1m"] = lambda t: book.book_state(staging.flatten_l2(t["l2_raw"], products), latest_book_only)
        models["fct_liquidity_1m"] = lambda t: book.liquidity(t["int_book_state_1m"])
    if inputs.get("panes") is not None:
        models["fct_stream_batch_recon"] = lambda t: recon.reconcile(t["panes"], t["fct_bars_1m"])
    return models


def build(trades_raw: DataFrame, l2_raw: DataFrame | None = None, panes: DataFrame | None = None, products: tuple[str, ...] | None = config.TRACKED_PRODUCTS, latest_book_only: bool = False) -> Stored:
    """All models, lazily, over each other."""
    inputs = {"trades_raw": trades_raw, "l2_raw": l2_raw, "panes": panes}
    known: Stored = dict(inputs)
    for name, model in plan(inputs, products, latest_book_only).items():
        known[name] = model(known)
    return {name: frame for name, frame in known.items() if name not in inputs}


def checks_of(name: str, t: Stored, as_of, products: tuple[str, ...] | None = config.TRACKED_PRODUCTS, dim_products: DataFrame | None = None) -> Stored:
    """Offending rows of each check of one model; ``t`` holds it and those before it."""
    low, high = config.PRICE_RANGE
    rows = t[name]
    required = schemas.contract(name)[1] if name in schemas.CONTRACTS else []
    found = {f"{name}_not_null": checks.nulls(rows, required)} if required else {}
    if name == "fct_trades":
        found |= {
            "no_duplicate_trades": checks.duplicates(rows, ["trade_id", "product_id"]),
            "taker_side_is_inverse": checks.wrong_taker_side(rows),
            "trade_ids_contiguous": checks.broken_contiguity(rows, as_of),
            "ingest_lag_within_sla": checks.slow_ingest(rows, as_of),
            "accepted_sides": checks.not_accepted(rows, "side", ("buy", "sell")),
            "price_in_range": checks.out_of_range(rows, "price", low, high),
            "size_is_positive": checks.violates(rows, "size > 0"),
        }
        if products is not None:
            found["all_products_present"] = checks.missing_products(rows.sparkSession, rows, as_of, products)
        if dim_products is not None:
            found["products_are_known"] = checks.orphans(rows, dim_products, "product_id")
    elif name == "fct_bars_1m":
        found |= {
            "bar_ohlc_coherence": checks.incoherent_bars(rows),
            "bar_volume_reconciles": checks.unreconciled_volume(rows, t["fct_trades"]),
            "unique_bars": checks.duplicates(rows, ["product_id", "bar_start"]),
        }
    elif name == "fct_data_quality":
        found["data_quality_meets_sla"] = checks.failed_sla(rows, as_of)
    elif name == "fct_liquidity_1m":
        found["no_crossed_book"] = book.crossed(rows)
    return found


def check_all(models: Stored, as_of, products: tuple[str, ...] | None = None) -> Stored:
    """Offending rows of each check of the models that are there."""
    return {check: rows for name in models for check, rows in checks_of(name, models, as_of, products).items()}


#: Models that are rebuilt whole; the others replace the days within the lookback.
FULL = {"int_book_state_1m", "fct_stream_batch_recon"}
#: Checks that warn; all others stop the run.
WARN = {"data_quality_meets_sla", "all_products_present"}


def run(
    inputs: Stored, root: str, as_of, env: str = "prod", lookback: int | None = config.LOOKBACK_DAYS, products: tuple[str, ...] | None = config.TRACKED_PRODUCTS,
    latest_book_only: bool = False, dim_products: DataFrame | None = None,
) -> dict[str, int]:
    """Write every model in order and check it before the next one, which reads what was written; the first
    error stops the run, so nothing is built upon bad data. ``inputs`` as in :func:`plan`. Returns the
    number of offending rows by check."""
    spark, counts = inputs["trades_raw"].sparkSession, {}
    base = layer_path(root, "marts", env)
    stored: Stored = {name: frame for name, frame in inputs.items() if frame is not None}
    for name, model in plan(inputs, products, latest_book_only).items():
        path = f"{base}/{name}"
        if name in FULL:
            rebuild(model(stored), path)
        else:
            write_incremental(model(stored), path, as_of, lookback, name if name in schemas.CONTRACTS else None)
        table = spark.read.parquet(path)
        if name not in FULL and lookback is not None:
            # the days that are replaced, and one before: the first return needs the bar before its window
            table = table.where(within_lookback(F.col("event_date"), F.lit(as_of).cast("timestamp"), lookback + 1))
        stored[name] = table
        for check, rows in checks_of(name, stored, as_of, products, dim_products).items():
            counts[check] = rows.count()
            if counts[check] and check not in WARN:
                raise ValueError(f"check {check} on {name}: {counts[check]} rows")
    return counts
