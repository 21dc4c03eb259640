"""Inputs made from the given tables for the streaming queries."""
