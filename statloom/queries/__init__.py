"""Registered queries: each inventory id as a Spark callable and an independent SQL text."""

from __future__ import annotations

from .registry import REGISTRY, Query


def all_queries() -> dict[str, Query]:
    from . import aggs, domain, frames, joins, outputs, reshape, scalars, scans, windows  # noqa: F401

    return dict(REGISTRY)
