"""The registered queries of the subpackage."""

from __future__ import annotations

from collections.abc import Callable

# Importing the modules registers their queries. It is done here, so that a
# library that one of them lacks shows when this module is imported.
from haulage.llm import (op01_language_id, op02_secret_crf, op03_prefix_groups, op04_nra,  # noqa: F401
                         op05_token_counts, op06_byte_bpe, op07_training_order, op08_warc,
                         op09_decontaminate, op10_url_filter, op11_token_alignment, op12_substring_dedup, op13_shallot_clusters, registry)


def queries() -> dict[str, Callable]:
    return dict(registry.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(registry.ORACLE)
