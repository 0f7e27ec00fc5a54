"""Tabular feature preparation and regression modelling as Spark jobs."""
