"""Typed tables: schemas, keys, reading and writing."""
