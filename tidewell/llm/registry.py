"""The queries and oracle SQL of this subpackage."""

from __future__ import annotations

from importlib import import_module

#: Modules with QUERIES and ORACLES.
MODULES = ("queries_tokens", "queries_spans", "queries_decontamination", "queries_quality_rules", "queries_near_dedup", "queries_classifiers", "queries_chat_tools")


def queries() -> dict:
    return {name: f for m in MODULES for name, f in import_module(f"tidewell.llm.{m}").QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in import_module(f"tidewell.llm.{m}").ORACLES.items()}
