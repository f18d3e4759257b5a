"""Inputs and outputs: driver tables, lookup dictionaries, row source, sinks."""
