"""All queries of the subpackage."""

from __future__ import annotations

import importlib

from shelfwise.llm.common import CHECKS, QUERIES

MODULES = ["mixing", "tokens", "sharding", "simhash", "packing", "fertility", "warc", "suffix", "jaccard", "brown", "blocks", "periodic", "alignment"]


def load() -> tuple[dict, dict]:
    """Import the operators' modules; their queries and SQL texts, in the order of the operators."""
    for module in MODULES:
        importlib.import_module(f"shelfwise.llm.{module}")
    number = lambda name: int(name[2:].split("_")[0])
    return {n: QUERIES[n] for n in sorted(QUERIES, key=number)}, dict(CHECKS)
