"""Derived tables, metrics and reports built from the operators."""
