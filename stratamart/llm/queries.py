"""Imports every operator module, so that its query is registered."""

from stratamart.llm import (  # noqa: F401
    byte_bpe,
    filter_audit,
    fingerprints,
    jaccard_join,
    language_id,
    license_scan,
    packing,
    quality,
    secret_scan,
    token_alignment,
    top_inner,
    toxicity,
    url_filters,
)
from stratamart.llm.registry import ORACLES, QUERIES  # noqa: F401
