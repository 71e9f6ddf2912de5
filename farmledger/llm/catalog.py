"""Import every module that registers queries."""

from farmledger.llm import (  # noqa: F401
    decontamination, hard_negatives, jaccard_join, line_quality, packing, periodic_runs, pii, quality, secret_scan, sharding, suffix_dedup, toxicity, url_filter,
)
from farmledger.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
