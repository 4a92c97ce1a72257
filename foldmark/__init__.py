"""Behaviour analytics on Spark: dated, per-subject data as DataFrame plans."""
