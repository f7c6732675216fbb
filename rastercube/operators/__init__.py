"""Operators over pixels, tiles, months and masks."""
