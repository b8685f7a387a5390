"""Surrogate keys."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F


def surrogate_key(*natural: Column) -> Column:
    """Non-negative 63-bit hash of the natural key.

    Equal inputs give equal keys, so a retried task or a rerun repeats them.
    Null and the empty string differ because each part carries a null flag.
    """
    parts = []
    for part in natural:
        parts += [part.isNull(), part]
    return F.xxhash64(*parts).bitwiseAND(F.lit(2**63 - 1))


def run_id() -> str:
    """Random id that ties the audit rows of one run together."""
    return str(uuid.uuid4())
