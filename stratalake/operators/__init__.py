"""DataFrame -> DataFrame operators."""

from .changes import changed_partitions, rollup_on_changes, row_changes
from .geo import inversion_counts, inversion_flags, repair_coordinates
from .guards import require_columns, require_rows
from .quality import (
    Check,
    Recent,
    VerificationError,
    at_least,
    at_most,
    between,
    gate,
    is_one,
    metrics,
    type_histogram,
    verify,
)
from .rollup import distinct_rollup

__all__ = [
    "Check",
    "Recent",
    "VerificationError",
    "at_least",
    "at_most",
    "between",
    "changed_partitions",
    "distinct_rollup",
    "gate",
    "inversion_counts",
    "inversion_flags",
    "is_one",
    "metrics",
    "repair_coordinates",
    "require_columns",
    "require_rows",
    "rollup_on_changes",
    "row_changes",
    "type_histogram",
    "verify",
]
