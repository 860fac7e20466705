"""Verdict operators: from observed columns to a status and its reason."""
