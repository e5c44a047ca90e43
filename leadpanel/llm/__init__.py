"""Operators of a training-data pipeline: deduplication, archives, tokens, packing, quality, licences, chat text."""
