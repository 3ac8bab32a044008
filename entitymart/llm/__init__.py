"""Operators for large training corpora: media, text quality, near duplicates, archives, packing, storage."""
