"""Regressors, their search spaces, training runs and model files."""
