"""Compositions of operators: the batch job and the registered queries."""
