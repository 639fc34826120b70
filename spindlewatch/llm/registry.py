"""All queries of this subpackage and their SQL twins."""

from __future__ import annotations

from spindlewatch.llm import decontamination, language, merkle, minhash_dedup, mixing, oracle, phrase_dedup, quality, spelling, suffix_dedup, token_counts, topk_search, toxicity, warc  # noqa: F401  importing a module registers its query
from spindlewatch.llm.common import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
