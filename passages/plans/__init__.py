"""Whole pipelines composed of the operators, and the catalogue of checked queries."""
