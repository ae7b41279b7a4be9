"""Text forms of values for display."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fixed_percent(column: Column) -> Column:
    """Two decimals without thousands separators, then a percent sign."""
    return F.concat(two_decimals(column), F.lit("%"))


def two_decimals(column: Column) -> Column:
    # The pattern form rounds half to even on the binary value, as C-style formatting does.
    return F.call_function("format_number", column, F.lit("0.00"))


def thousands(column: Column) -> Column:
    """Cut to a whole number and group its digits by thousands."""
    return F.format_number(column.cast("bigint"), 0)


def title_case(column: Column) -> Column:
    """Each run of letters with a capital first letter and small ones after it."""
    parts = F.regexp_extract_all(column, F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    return F.array_join(
        F.transform(parts, lambda p: F.concat(F.upper(F.left(p, F.lit(1))), F.lower(F.substr(p, F.lit(2))))), ""
    )


def flag_url(name: Column, prefix: str) -> Column:
    """URL of the image kept for a name (P17): path-style percent encoding, so ``/`` stays."""
    encoded = F.url_encode(name)
    for form_encoded, path_encoded in (("+", "%20"), ("%7E", "~"), ("*", "%2A"), ("%2F", "/")):
        encoded = F.replace(encoded, F.lit(form_encoded), F.lit(path_encoded))
    return F.concat(F.lit(prefix), encoded, F.lit(".png"))
