"""Whole flows: fitted feature preparation, training runs, batch scoring."""
