"""Registered queries over derived views of the base tables, each with its SQL twin."""

from gridprep.plans import queries_cells, queries_crops, queries_files, queries_graph, queries_grid, queries_series  # noqa: F401
from gridprep.plans.registry import ORACLE, QUERIES  # noqa: F401
