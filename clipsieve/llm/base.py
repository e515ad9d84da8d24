"""What the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clipsieve.operators.tables import Sorted, free, join_counted, shared_dir, small, stored, table

__all__ = ["Sorted", "WS", "free", "join_counted", "key_of", "shared_dir", "small", "stored", "table"]

#: Unicode white space, as Java's regular expressions spell it.
WS = r"[\s\x1c-\x1f\x85\p{Z}]"


def key_of(name: Column) -> Column:
    """A speaker or source for comparison: without letter case and outer white space; null if nothing is left."""
    bare = F.lower(F.regexp_replace(name, f"^{WS}+|{WS}+$", ""))
    return F.nullif(bare, F.lit(""))
