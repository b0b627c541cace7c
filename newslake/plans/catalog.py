"""Import every query module so the registry is complete."""

from newslake.plans import q_events as _events  # noqa: F401
from newslake.plans import q_files as _files  # noqa: F401
from newslake.plans import q_sources as _sources  # noqa: F401
from newslake.plans import q_stats as _stats  # noqa: F401
from newslake.plans import q_stream as _stream  # noqa: F401
from newslake.plans import queries as _articles  # noqa: F401
from newslake.plans.registry import all_queries, all_sql

__all__ = ["all_queries", "all_sql"]
