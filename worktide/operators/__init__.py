"""Bulk operators over lifecycle tables."""
