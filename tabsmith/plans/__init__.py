"""Assembled jobs and the catalogue of bound queries (operator x driver table)."""
