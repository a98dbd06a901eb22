"""Compositions of operators: loading, auditing, reporting, deleting."""
