"""Whole jobs: from an export to the tables and reports."""
