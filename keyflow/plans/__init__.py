"""Whole plans: outcomes, batch pipeline, test log."""
