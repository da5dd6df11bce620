"""Whole plans built from the operators: training table, models, scores."""
