"""What each mart is made of, as assets: keys, groups by layer, and what is upstream, found by watching the
models being built."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from tapeworks import config
from tapeworks.plans.marts import Stored, plan

#: Raw inputs by the name of their source table.
SOURCES = {"trades_raw": "trades_stream", "l2_raw": "l2_stream", "panes": "bars_1m_stream"}
LAYERS = {"int": "intermediate", "fct": "marts", "dim": "marts", "stg": "staging"}


@dataclass(frozen=True)
class Asset:
    key: tuple[str, ...]
    group: str
    upstream: tuple[tuple[str, ...], ...] = ()


def key_of(name: str) -> tuple[str, ...]:
    """Sources lie under ``raw``; models go by their own name."""
    return ("raw", SOURCES[name]) if name in SOURCES else (name,)


def group_of(name: str) -> str:
    return "raw" if name in SOURCES else LAYERS.get(name.partition("_")[0], "marts")


class _Watched(dict):
    """Notes which frames are asked for."""

    def __init__(self, frames: Stored) -> None:
        super().__init__(frames)
        self.asked: list[str] = []

    def __getitem__(self, name: str) -> DataFrame:
        self.asked.append(name)
        return super().__getitem__(name)


def lineage(inputs: Stored, products: tuple[str, ...] | None = config.TRACKED_PRODUCTS) -> dict[str, Asset]:
    """Assets of all inputs and models, by name; nothing is run."""
    known = _Watched({name: frame for name, frame in inputs.items() if frame is not None})
    found = {name: Asset(key_of(name), "raw") for name in known}
    for name, model in plan(inputs, products).items():
        known.asked.clear()
        known[name] = model(known)
        found[name] = Asset(key_of(name), group_of(name), tuple(key_of(n) for n in dict.fromkeys(known.asked)))
    return found
