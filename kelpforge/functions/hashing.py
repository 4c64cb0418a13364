"""Content hashes and identifiers, all as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def content_hash(c: Column | str) -> Column:
    """``sha256:`` and 64 hex digits of the UTF-8 bytes; null stays null."""
    return F.concat(F.lit("sha256:"), F.sha2(_col(c), 256))


def stable_episode_id(problem: Column | str, behavior: Column | str, payload: Column | str) -> Column:
    """``apps-<problem>-<behavior>-<12 hex>``, the hex from the payload's SHA-256."""
    return F.concat_ws("-", F.lit("apps"), _col(problem), _col(behavior), F.substring(F.sha2(_col(payload), 256), 1, 12))


def mutation_set_hash(keys: Column | str) -> Column:
    """Hash of an array of edit keys, in the order given (order counts)."""
    return content_hash(F.array_join(_col(keys), "|"))


def rank_key(salt: str, c: Column | str) -> Column:
    """``sha256(salt:id)`` as hex: a deterministic, distributed stand-in for a shuffle."""
    return F.sha2(F.concat(F.lit(f"{salt}:"), _col(c).cast("string")), 256)
