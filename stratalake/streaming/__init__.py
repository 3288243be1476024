"""Structured Streaming jobs."""

from .gold import incremental_gold
from .incremental import incremental_silver, newest_label
from .pages import incremental_pages, read_pages

__all__ = ["incremental_gold", "incremental_pages", "incremental_silver", "newest_label", "read_pages"]
