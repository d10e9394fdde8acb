"""Half-even rounding with the scale-and-round rule of numerical libraries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_even(value: Column | str, decimals: int = 2) -> Column:
    """rint(value * 10^d) / 10^d: binary, unlike ``bround`` which rounds the
    printed decimal form (2.175 -> 2.17 here, 2.18 there)."""
    x = F.col(value) if isinstance(value, str) else value
    scale = float(10**decimals)
    return F.rint(x * scale) / scale


def fixed(value: Column, decimals: int) -> Column:
    """Text with so many decimals, rounded from the binary value as C's ``printf`` does;
    ``format_string`` would round its shortest decimal form (0.01005 held as 0.010049...)."""
    return F.call_function("format_number", value.cast("double"), F.lit("0." + "0" * decimals))
