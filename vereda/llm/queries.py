"""All queries of this subpackage and their checking SQL."""

from __future__ import annotations

from vereda.llm import (
    alignment, chat, decontamination, language_model, mixing, near_duplicates, quality, repair, repeats, search, sharding, token_counts, toxicity,
)

MODULES = [chat, search, language_model, toxicity, token_counts, near_duplicates, sharding, decontamination, repeats, mixing, quality, alignment, repair]

queries = {name: fn for m in MODULES for name, fn in m.catalog.queries.items()}
sql = {name: text for m in MODULES for name, text in m.catalog.sql.items()}
