"""Relational operators over pixels, scenes, masks, labels and maps."""
