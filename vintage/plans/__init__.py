"""Compositions: the models built from raw tables, and the run of one feed."""
