"""Queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

from importlib import import_module

#: Query name -> module of this subpackage that holds it.
HOMES = {
    "op8_suffix_dedup": "suffixes",
    "op3_line_dedup": "lines",
    "op5_html": "html",
    "op2_ann": "ann",
    "op1_toxicity": "toxicity",
    "op4_secrets": "secrets",
    "op6_decontaminate": "decontaminate",
    "op7_bpe": "bpe",
    "op9_simhash": "simhash",
    "op10_sharding": "sharding",
}


def queries() -> dict:
    return {name: getattr(import_module(f"tapeworks.llm.{home}"), name) for name, home in HOMES.items()}


def oracle_sql() -> dict[str, str]:
    found = {}
    for name, home in HOMES.items():
        sql = getattr(import_module(f"tapeworks.llm.{home}"), "ORACLE_SQL", None)
        if sql:
            found[name] = sql
    return found
