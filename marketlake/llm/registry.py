"""All queries of this subpackage (importing a module registers its query)."""

from __future__ import annotations

from . import (  # noqa: F401
    block_names, chat, decontaminate, filter_audit, fingerprints, language_model, licenses, manifest, packing, quality, secrets,
    simhash, toxicity)
from .common import ORACLE, QUERIES


def all_queries() -> dict:
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    return dict(ORACLE)
