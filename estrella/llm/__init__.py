"""Operators of a training-data pipeline: near duplicates, language, packing,
decontamination, sharding, quality, token files, counts and line boilerplate."""
