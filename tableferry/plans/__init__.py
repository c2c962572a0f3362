"""Whole transfers: one table, a run over many, and the report."""
