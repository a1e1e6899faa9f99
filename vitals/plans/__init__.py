"""Composed work: batch jobs over a lake, and the registered queries with their check SQL."""
