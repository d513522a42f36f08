"""Whole runs put together from the operators: a load, a check suite."""
