"""Composite pipelines, predictor plug-ins and the registered queries."""
