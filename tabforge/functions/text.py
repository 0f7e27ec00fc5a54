"""Text normalisation expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

# What surrounds a value and is stripped (all Unicode white space and the
# four ASCII separators), and the text a missing value turns into.
EDGE_SPACE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"
MISSING_LEVEL = "nan"


def unified(text: Column, missing_as_level: bool = True) -> Column:
    """Lower case without surrounding white space; a missing value is a level of its own or stays NULL."""
    clean = F.regexp_replace(F.lower(text.cast("string")), EDGE_SPACE, "")
    return F.coalesce(clean, F.lit(MISSING_LEVEL)) if missing_as_level else clean


def replaced(value: Column, mapping: Mapping) -> Column:
    """Values found in ``mapping`` are replaced, others kept."""
    if not mapping:
        return value
    return F.coalesce(lookup(value, mapping), value)


def lookup(value: Column, mapping: Mapping) -> Column:
    """``mapping[value]``, NULL where the value is not a key."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), value)
