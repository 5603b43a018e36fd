"""The composite models, reports and evaluation queries."""
