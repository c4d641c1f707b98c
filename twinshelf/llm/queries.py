"""All queries of this package and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from twinshelf.llm import (
    decontamination, exact_dedup, hard_negatives, importance, language_id, packing, simhash,
    substring_dedup, suffix_dedup, token_counts, token_files, toxicity, warc,
)

MODULES = [
    decontamination, exact_dedup, hard_negatives, importance, language_id, packing, simhash,
    substring_dedup, suffix_dedup, token_counts, token_files, toxicity, warc,
]

QUERIES: list[Callable] = [query for module in MODULES for query in module.QUERIES]
ORACLES: dict[str, str] = {
    name: sql for module in MODULES for name, sql in getattr(module, "ORACLES", {}).items()
}
