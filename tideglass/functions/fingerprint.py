"""Row fingerprints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = "||"


def record_hash(columns: Sequence[str], null_safe: bool = False) -> Column:
    """SHA-256 over the values as text.

    The default skips nulls and adds no escaping, so that fingerprints equal those already stored.
    ``null_safe`` writes each value with its length and marks nulls, so no two different rows
    share the hashed text.
    """
    values = [F.col(name).cast("string") for name in columns]
    if null_safe:
        values = [
            F.coalesce(F.concat(F.length(v).cast("string"), F.lit(":"), v), F.lit("\0"))
            for v in values
        ]
    return F.sha2(F.concat_ws(SEPARATOR, *values), 256)
