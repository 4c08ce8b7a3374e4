"""Operators of a training-data pipeline (licence scan, decontamination, chat
formatting, language ID, quality models, near-dedup, sharding, token counts,
packing).  Nothing else in the library imports this subpackage."""
