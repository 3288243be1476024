"""Column -> Column expressions built only from ``pyspark.sql.functions``."""

from .geo import (
    in_range_or_null,
    inverted,
    repaired_lat,
    repaired_lon,
    swapped_lat,
    swapped_lon,
)
from .text import (
    NULL_LABEL,
    capitalize_words,
    clean_code,
    clean_label,
    empty_as,
    null_default,
    squash_spaces,
    strip_special,
)

__all__ = [
    "NULL_LABEL",
    "capitalize_words",
    "clean_code",
    "clean_label",
    "empty_as",
    "in_range_or_null",
    "inverted",
    "null_default",
    "repaired_lat",
    "repaired_lon",
    "squash_spaces",
    "strip_special",
    "swapped_lat",
    "swapped_lon",
]
