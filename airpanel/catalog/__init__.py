"""Registered queries and their SQL twins."""

from airpanel.catalog import incremental, landing, modelling, scalars, tables, timeseries  # noqa: F401
from airpanel.catalog.base import ORACLES, QUERIES  # noqa: F401
