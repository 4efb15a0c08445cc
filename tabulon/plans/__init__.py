"""Whole jobs, the stand-in input tables, and the registered queries with their check SQL."""
