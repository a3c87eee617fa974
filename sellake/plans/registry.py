"""Imports every query module so that the registry is complete."""

from . import q_core, q_history, q_kpis, q_land, q_masters, q_more, q_reports, q_silver, q_stream, q_views  # noqa: F401
from .queries import ORACLE, QUERIES  # noqa: F401
