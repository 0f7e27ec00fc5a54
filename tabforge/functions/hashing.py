"""Row hashes that do not depend on how the table is partitioned."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from ..schema import q_col

HASH_DIGITS = 13  # 52 bits: every hash is exact as a double
HASH_RANGE = float(16**HASH_DIGITS)


def key_hash(key: Sequence[str] | str, seed: int) -> Column:
    """A number in [0, 2^52) from the key columns and a seed; any MD5 implementation gives the same."""
    names = [key] if isinstance(key, str) else list(key)
    text = F.concat_ws(":", *[F.coalesce(q_col(c).cast("string"), F.lit("")) for c in names], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, HASH_DIGITS), 16, 10).cast("long")
