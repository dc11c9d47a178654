"""Named constants of the tick-data model. Fixed values."""

from __future__ import annotations

TRACKED_PRODUCTS = ("BTC-USD", "ETH-USD", "SOL-USD")
SYNTHETIC_TRADE_IDS = (1788112582, 999999)
LOOKBACK_DAYS = 3
MINUTES_PER_YEAR = 525600
PRUNE_BAND = "0.01"
DEPTH_BANDS_BPS = (5, 10, 25)
COMPLETENESS_SLA = 0.9999
LATENCY_SLA_MS = 5000
DAILY_LOSS_LIMIT = 0.0001
VOLUME_TOLERANCE = "0.00000001"
PRICE_RANGE = ("0.0001", "10000000")
WINDOW_SECONDS = 60
LATENESS_SECONDS = 30
HEARTBEAT_TIMEOUT_SECONDS = 10
METRIC_MIN_GAP_SECONDS = 10
LAG_RESERVOIR = 10_000
LAG_RESERVOIR_DROP = 5_000
FRESHNESS_MINUTES = 5
#: (warn, error) minutes after which a source is stale.
SOURCE_FRESHNESS = {"trades": (5, 60), "l2": (5, 60), "heartbeat": (2, 10)}
#: Tries of a message before it goes to the dead letters.
DELIVERY_ATTEMPTS = 5
#: A lake file is closed at this size or age.
LAKE_FILE_BYTES, LAKE_FILE_SECONDS = 64 * 1024 * 1024, 300
#: Waits between pages of the trades endpoint, and rows of a page at most.
PAGE_WAIT_SECONDS, PAGE_ROWS = 0.2, 1000
#: Days that raw tables and the locked lake are kept, by environment, and after which lake files go to a cheaper tier.
RAW_DAYS, LAKE_LOCK_DAYS = {"dev": 14, "prod": 90}, {"dev": 7, "prod": 90}
NEARLINE_DAYS, COLDLINE_DAYS = 30, 90
