"""Whole flows: from dump lines to published catalog tables."""
