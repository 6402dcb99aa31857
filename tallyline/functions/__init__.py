"""Scalar expressions, all evaluated inside the JVM."""

from tallyline.functions.numbers import (
    decimal_mean,
    growth,
    parse_number,
    percent_of,
    product,
    ratio,
    round_to,
)
from tallyline.functions.periods import is_trailing, period_end, period_order
from tallyline.functions.text import (
    decode_entities,
    normalise_name,
    strip_blank,
)

__all__ = [
    "decimal_mean",
    "decode_entities",
    "growth",
    "is_trailing",
    "normalise_name",
    "parse_number",
    "percent_of",
    "period_end",
    "period_order",
    "product",
    "ratio",
    "round_to",
    "strip_blank",
]
