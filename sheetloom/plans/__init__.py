"""Whole pipelines, from sheets to long tables to fact tables."""
