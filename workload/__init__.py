"""The registered queries: each operator applied to the test tables, with its SQL twin."""

from workload import (
    aggregates,
    cleaning,
    functions,
    joins,
    layout,
    logs,
    ordering,
    pipelines,
    projection,
    sets,
    sinks,
    sources,
    streams,
    windows,
)
from workload.registry import ORACLES, QUERIES

__all__ = [
    "ORACLES",
    "QUERIES",
    "aggregates",
    "cleaning",
    "functions",
    "joins",
    "layout",
    "logs",
    "ordering",
    "pipelines",
    "projection",
    "sets",
    "sinks",
    "sources",
    "streams",
    "windows",
]
