"""Operators over dated, per-subject tables."""
