"""Equivalent SQL over the same files, used only to check results."""
