"""Declared schemas: raw messages, lake envelopes, and the contracts of the marts."""

from __future__ import annotations

from pyspark.sql import types as T

NUM = T.DecimalType(38, 9)


_KINDS = {
    "bigint": T.LongType(), "int": T.IntegerType(), "string": T.StringType(), "timestamp": T.TimestampType(), "binary": T.BinaryType(), "date": T.DateType(),
    "boolean": T.BooleanType(), "decimal(38": NUM, "array<array<string>>": T.ArrayType(T.ArrayType(T.StringType())),
}


def _struct(ddl: str) -> T.StructType:
    """Fields of "name type, ...", without a session: stream workers import this module too."""
    fields = [part.split() for part in ddl.replace("(38,9)", "(38").split(",")]
    return T.StructType([T.StructField(name, _KINDS[kind]) for name, kind in fields])


METADATA = "subscription_name string, message_id string, publish_time timestamp, attributes string"
TRADES = _struct("sequence bigint, product_id string, trade_id bigint, price string, size string, side string, maker_order_id string, taker_order_id string, event_time string, ingest_time string")
L2 = _struct("sequence bigint, product_id string, event_type string, payload string, event_time string, ingest_time string")
HEARTBEAT = _struct("sequence bigint, product_id string, last_trade_id bigint, event_time string, ingest_time string")
CHANNELS = {"trades": TRADES, "l2": L2, "heartbeat": HEARTBEAT}
RAW = {channel: T.StructType(schema.fields + _struct(METADATA).fields) for channel, schema in CHANNELS.items()}
ENVELOPE = _struct("subscription_name string, message_id string, publish_time timestamp, data binary, attributes string, dt date")
BARS_STREAM = _struct(
    "product_id string, bar_start timestamp, bar_end timestamp, open decimal(38,9), high decimal(38,9), low decimal(38,9), close decimal(38,9), volume decimal(38,9), "
    "trade_count bigint, vwap decimal(38,9), first_trade_id bigint, last_trade_id bigint, pane_index bigint, is_final_pane boolean, written_at timestamp"
)
DIM_PRODUCTS = _struct("product_id string, base_currency string, quote_currency string, quote_increment decimal(38,9), base_min_size decimal(38,9), display_name string")
#: One JSON message of a recorded session, whatever its type.
SESSION = _struct(
    "type string, product_id string, sequence bigint, trade_id bigint, last_trade_id bigint, price string, size string, side string, maker_order_id string, taker_order_id string, time string, "
    "changes array<array<string>>, bids array<array<string>>, asks array<array<string>>"
)
PAYLOAD = "changes array<array<string>>, bids array<array<string>>, asks array<array<string>>"

#: Columns that a mart must have, with their types; "!" marks those that are never null.
CONTRACTS = {
    "fct_trades": "trade_id bigint !, product_id string !, sequence bigint, price decimal(38,9) !, size decimal(38,9) !, side string !, taker_side string, notional decimal(38,9), is_backfilled boolean, "
    "maker_order_id string, taker_order_id string, event_time timestamp !, ingest_time timestamp, ingest_lag_ms bigint, event_date date !, event_minute timestamp",
    "fct_bars_1m": "product_id string !, bar_start timestamp !, bar_end timestamp, open decimal(38,9) !, high decimal(38,9) !, low decimal(38,9) !, close decimal(38,9) !, volume decimal(38,9) !, "
    "quote_volume decimal(38,9), trade_count bigint !, vwap decimal(38,9), buy_volume decimal(38,9), sell_volume decimal(38,9), volume_imbalance decimal(38,9), avg_ingest_lag_ms bigint, "
    "first_trade_id bigint, last_trade_id bigint, event_date date !",
}


def contract(name: str) -> tuple[T.StructType, list[str]]:
    """(schema, columns that must not be null) of a mart."""
    ddl = CONTRACTS[name]
    schema = _struct(ddl.replace(" !", ""))
    required = [part.split()[0] for part in ddl.replace("decimal(38,9)", "decimal").split(",") if "!" in part]
    return schema, required


def versioned_name(channel: str) -> str:
    """A name that changes with the channel's schema, which itself never changes: channel and the first
    eight signs of the schema's digest."""
    from hashlib import md5

    return f"{channel}-{md5(CHANNELS[channel].json().encode()).hexdigest()[:8]}"
