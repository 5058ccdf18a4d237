"""Whole pipelines as compositions of operators: one lineage each, no step writes what the next one reads."""
