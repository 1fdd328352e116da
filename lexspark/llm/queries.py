"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap


def load() -> None:
    from lexspark.llm import (  # noqa: F401
        q_classifier, q_collocations, q_decontamination, q_jaccard, q_language, q_minhash, q_mixing, q_quality, q_spelling,
        q_suffix, q_tokens, q_urls,
    )
