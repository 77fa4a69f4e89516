"""Every query the engine answers, by subject."""

from __future__ import annotations

from . import q_io, q_stations, q_users  # noqa: F401  (registration)
from .registry import all_queries, all_sql  # noqa: F401
