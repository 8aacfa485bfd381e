"""Operators of the record-linkage engine."""
