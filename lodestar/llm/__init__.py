"""Operators for preparing large text corpora (token counts, dedup, mixing, ...).

Nothing else in the library imports this subpackage; ``queries.py`` wires the
operators to the tables and ``__spark_entry__`` adds them when present.
"""
