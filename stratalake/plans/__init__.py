"""User-level jobs composed from operators, sources and sinks."""

from .reports import kept_reports, recent_means
from .stages import (
    EntityColumns,
    clean_entities,
    entity_checks,
    publish,
    rollup_checks,
    run_stage,
    to_bronze,
    to_gold,
    to_silver,
)

__all__ = [
    "EntityColumns",
    "clean_entities",
    "entity_checks",
    "kept_reports",
    "publish",
    "recent_means",
    "rollup_checks",
    "run_stage",
    "to_bronze",
    "to_gold",
    "to_silver",
]
