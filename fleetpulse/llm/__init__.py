"""Operators of a training-data pipeline: packing, quality, de-duplication, decontamination, extraction."""
