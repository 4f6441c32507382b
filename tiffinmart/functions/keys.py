"""Deterministic surrogate keys computed from attributes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def key_text(cols: Sequence[Column | str], mode: str = "safe") -> Column:
    """The text a key is hashed from.

    `safe` writes every value with its length, so neighbouring values cannot run into each
    other and NULL stays distinct. `reference` is plain concatenation: ('ab','c') equals
    ('a','bc') and one NULL makes the whole text NULL.
    """
    if mode not in ("safe", "reference"):
        raise ValueError(f"unknown key mode {mode!r}")
    if all(isinstance(c, str) for c in cols):
        texts = [f"CAST(`{c}` AS STRING)" for c in cols]
        if mode == "safe":
            texts = [f"coalesce(concat(CAST(length({t}) AS STRING), ':', {t}), '~')" for t in texts]
        return F.expr(f"concat({', '.join(texts)})")
    texts = [_as_column(c).cast("string") for c in cols]
    if mode == "reference":
        return F.concat(*texts)
    return F.concat(
        *[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("~")) for t in texts]
    )


def hash_key(cols: Sequence[Column | str], mode: str = "safe") -> Column:
    """60-bit key from SHA-1. Fine up to about 10^8 distinct values; use `hash_key_text` beyond."""
    digest = F.sha1(key_text(cols, mode))
    key = F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")
    # A safe key is never NULL; saying so spares joins a second hash for their NULL filter.
    return F.coalesce(key, F.lit(0).cast("bigint")) if mode == "safe" else key


def hash_key_text(cols: Sequence[Column | str], mode: str = "safe") -> Column:
    """256-bit key as hex text, for tables too large for `hash_key`."""
    return F.sha2(key_text(cols, mode), 256)
