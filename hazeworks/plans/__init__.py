"""Compositions of operators: the batch load and the monitoring refresh."""
