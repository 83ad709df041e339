"""Queries over the test tables, one module per area."""

from __future__ import annotations

import importlib

SECTIONS = ("scans", "selection", "joins", "aggregates", "sorts_and_sets", "subqueries", "windows", "scalars", "table_changes", "data_rules", "routines", "layouts", "log_reports", "streams")


def sections():
    return [importlib.import_module(f"tabloom.plans.{name}").section for name in SECTIONS]
