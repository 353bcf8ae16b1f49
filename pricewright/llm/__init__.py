"""Operators of a training-data pipeline: archives, packing, duplicates, languages, mixtures, token files."""
