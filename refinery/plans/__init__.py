"""Compositions of operators: entity pipelines and the registered queries."""
