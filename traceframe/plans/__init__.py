"""Whole captures built from the operators."""
